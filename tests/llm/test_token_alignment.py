import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from atende.llm import token_alignment as t

from .conftest import make_docs

TEXTS = [
    "Hello there, world", "", None, "two  spaces and   three", " leading and trailing ", "naïve façade 漢字 🤦‍♂️ é ͸", "tab\there\n\nlines\r\n", "a▁b", "<s> </s> <0x41> <|endoftext|> <unk>",
    "7" * 1200, "word " * 1500, "Hello there, world", "\x00 nul", "x", "▁", "internationalization " + "abc" * 700, "ﬁ Å ẛ̣", "don't you've we'll I'm " * 30, " ", "\n", "​ zero width",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(t.vocabularies()[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=t.vocabularies()[1])


def byte_table():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


BYTES = byte_table()


def ranges(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def tokens(libraries, text):
    """((id, start, end) of A, of B) by the libraries themselves; None without tokens."""
    if not text:
        return None
    a, b = libraries
    enc = a.encode(" " + text, add_special_tokens=False)
    raw_a = [bytes(BYTES[c] for c in x) for x in enc.tokens]
    ids_b = b.encode(text)
    raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    data = (" " + text).encode()
    if b"".join(raw_a) != data or b"".join(raw_b) != data:
        return None
    return [(i, *r) for i, r in zip(enc.ids, ranges(raw_a))], [(i, *r) for i, r in zip(ids_b, ranges(raw_b))]


def brute(libraries, rows):
    """All pairs of tokens of every text, and groups between common ends."""
    done = []
    for key, text in rows:
        both = tokens(libraries, text)
        if both is None:
            done.append((key, 0, 0, 0, [], ""))
            continue
        a, b = both
        links, first = [], 0
        for x in a:
            while first < len(b) and b[first][2] <= x[1]:
                first += 1
            k = first
            while k < len(b) and b[k][1] < x[2]:
                links.append((x[0], b[k][0]))
                k += 1
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        parts, start = [], 0
        for e in ends:
            inside = lambda side: ",".join(str(x[0]) for x in side if start < x[2] <= e)  # noqa: E731, B023
            parts.append(inside(a) + "|" + inside(b))
            start = e
        done.append((key, len(a), len(b), len(ends), links, hashlib.sha256(";".join(parts).encode()).hexdigest()))
    counts = Counter(p for d in done for p in d[4])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [
        (key, na, nb, ng, len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), sha)
        for key, na, nb, ng, links, sha in done
    ]


def result(df):
    return sorted(((r.row.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("most_pairs, lane", [(t.MOST_PAIRS, t.LANE), (20, 3), (0, 64)])
def test_against_all_pairs(spark, libraries, monkeypatch, most_pairs, lane):
    rows = list(enumerate(TEXTS)) + [(None, "Hello again"), (0, "Hello there, world")]
    got = result(t.alignment_counts(make_docs(spark, rows), most_pairs=most_pairs))
    assert got == sorted(brute(libraries, rows), key=repr)


@pytest.mark.parametrize("lane", [1, 2, 7, 10_000])
def test_lanes_change_nothing(libraries, lane):
    own = t.tokenizers(*t.vocabularies())
    ids = [x for x in own.encode([x for x in TEXTS if x]) if x is not None]
    one, cut = t.Merged(own, ids), t.Merged(own, ids, lane)
    assert one.links.tolist() == cut.links.tolist() and one.groups() == cut.groups() and one.start_link.tolist() == cut.start_link.tolist()


def test_given_documents(spark, sf_dir, libraries, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert result(t.alignment_counts(docs)) == sorted(brute(libraries, documents), key=repr)


def test_alignment_itself(spark, libraries):
    rows = list(enumerate(TEXTS))
    got = {r.row.doc_id: r for r in t.align(make_docs(spark, rows)).collect()}
    for key, text in rows:
        both, r = tokens(libraries, text), got[key]
        if both is None:
            assert (r.a, r.b, r.links, r.cuts) == ([], [], [], [])
            continue
        a, b = both
        assert r.a == [x[0] for x in a] and r.b == [x[0] for x in b]
        assert [tuple(x) for x in r.links] == [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]]
        assert [x.bytes for x in r.cuts] == sorted({x[2] for x in a} & {x[2] for x in b})
        assert all(a[x.a - 1][2] == b[x.b - 1][2] == x.bytes for x in r.cuts)


def test_long_texts_and_empty_tables(spark, libraries):
    text = "some words of a long text, " * 100_000
    own = t.tokenizers(*t.vocabularies())
    assert own.encode([text])[0][1].tolist() == libraries[1].encode(text)
    docs = make_docs(spark, [(1, text), (2, "7" * 30_000)])
    got = result(t.alignment_counts(docs))
    assert [x[0] for x in got] == [1, 2] and got[0][1] > 500_000
    assert t.alignment_counts(docs.where("false")).count() == 0 and t.align(docs.where("false")).count() == 0
    assert t.alignment_counts(docs.select("text")).count() == 2
