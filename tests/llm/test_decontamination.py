import re

import pytest

from atende.llm import decontamination as d

from .conftest import make_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(d.UPPER, d.LOWER)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    """Every window of every item at every place of every document."""
    out = []
    for doc_id, text in docs:
        ws, hit, found = words(text), set(), set()
        for item_id, body in items:
            own = words(body)
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                for at in range(len(ws) - size + 1):
                    if ws[at: at + size] == own[i: i + size]:
                        hit |= set(range(at, at + size))
                        found |= {str(item_id)} if item_id is not None else set()
        out.append((doc_id, len(ws), len(hit), sorted(found)))
    return out


def result(df):
    return [(r.row.doc_id, r.d.n_words, r.d.n_hit, r.d["items"]) for r in df.collect()]


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "Só três palavras"), (2, "só, TRÊS; palavras!"), (10, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (None, "nobody's item here"), (4, None), (5, " .,; "), (6, "solo")]
DOCS = [
    (1, f"before {LONG} after"), (2, "x W5-w6_w7 w8,w9 w10 w11 w12 w13 w14 y"), (3, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (4, "SÓ três palavras"), (4, "Só TRÊS palavras"),
    (5, None), (6, ""), (7, "nobody s item here, nobody's item here"), (8, "solo " * 5), (9, f"{LONG} {LONG}"), (None, "w20 w21 w22 w23 w24 w25 w26 w27 w28 w29"),
    (11, "a" * 100_000), (12, ("w3 " * 40_000) + LONG), (9, f"{LONG} {LONG}"), (13, "\x00퟿ İ solo ſ"),
]


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("most_bytes", [d.MOST_BYTES, 300])
def test_against_brute_force(spark, most_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = result(d.decontaminate(make_docs(spark, DOCS), items, most_bytes=most_bytes))
    short = [x for x in DOCS if len(x[1] or "") < 50_000]
    expected = brute(short, ITEMS) + [(11, 1, 0, []), (12, 40_030, 30, ["1", "10"])]
    assert ordered(got) == ordered(expected)


@pytest.mark.parametrize("most_bytes", [d.MOST_BYTES, 4000])
def test_given_tables(spark, sf_dir, documents, most_bytes):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = result(d.decontaminate(docs, items, most_bytes=most_bytes))
    windows = {}
    for r in items.collect():
        own = words(r.text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[i: i + size]), set()).add(str(r.item_id))
    sizes = {len(w) for w in windows}
    expected = []
    for doc_id, text in documents:
        ws, hit, found = words(text), set(), set()
        for size in sizes:
            for at in range(len(ws) - size + 1):
                if (own := windows.get(tuple(ws[at: at + size]))) is not None:
                    hit |= set(range(at, at + size))
                    found |= own
        expected.append((doc_id, len(ws), len(hit), sorted(found)))
    assert sorted(got) == sorted(expected)
    assert any(x[2] for x in expected) and not all(x[2] for x in expected)


def test_removal(spark):
    items = spark.createDataFrame(ITEMS[:4], "item_id long, text string")
    docs = make_docs(spark, [(1, f"Before {LONG.upper()}! after"), (2, "clean text"), (3, None), (4, "so três palavras")])
    cut = {r.doc_id: r.text for r in d.remove_contamination(docs, items).collect()}
    assert cut == {1: "Before ! after", 2: "clean text", 3: None, 4: "so três palavras"}
    kept = d.remove_contamination(docs, items, remove="documents")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    with pytest.raises(ValueError):
        d.remove_contamination(docs, items, remove="all")


def test_empty_tables_and_names(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "one two", 3, "r", "d")], "n_words long, text string, items int, row string, d string")
    got = d.decontaminate(docs, none).collect()
    assert got[0].d.asDict(True) == {"n_words": 2, "n_hit": 0, "items": [], "spans": [], "kept_text": "one two"} and got[0].row.d == "d"
    assert d.decontaminate(docs.where("false"), none).count() == 0
    assert d.decontaminate(docs.select("text"), none).count() == 1
