import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.conftest import make_docs

from atende.llm import suffix_dedup as s


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    at = {}
    for i, b in enumerate(texts):
        for p in range(len(b) - length + 1):
            at.setdefault(b[p: p + length], []).append((i, p))
    gone = [np.zeros(len(b), bool) for b in texts]
    for places in at.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p: p + length] = True
    out = []
    for (d, _), b, g in zip(rows, texts, gone):
        left = np.frombuffer(b, np.uint8)[~g].tobytes()
        edges = np.count_nonzero(np.diff(np.concatenate([[0], g.view(np.int8)])) == 1)
        out.append((d, len(b), int(g.sum()), int(edges), hashlib.sha256(left).hexdigest()))
    return out


def texts_of(rnd, letters="abcé \n"):
    word = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    a, b, c = word(90), word(150), word(55)
    rows = [(None, a), (1, None), (2, ""), (3, "x" * 700), (4, "ab" * 300), (5, "x" * 39), (6, a + b), (6, a + b), (7, b + a + word(10) + b)]
    rows += [(10 + i, word(rnd.randint(0, 60)) + c + word(rnd.randint(0, 60))) for i in range(40)]  # one passage, many surroundings
    rows += [(None, word(30) + b + word(45) + a), (None, word(12) + b), (None, (word(23) + "#") * 3)]  # null ids are documents of their own
    near = [list(b * 2) for _ in range(25)]
    for i, x in enumerate(near):
        x[rnd.randrange(len(x))] = "Z"
        rows.append((100 + i, "".join(x)))
    rows += [(150 + d, word(20) + word(d) * (n // d) + word(20)) for d, n in ((1, 900), (1, 45), (7, 900), (7, 43), (3, 400), (9, 60))]
    unit = word(9)
    rows += [(170 + n, word(5) + (unit * 30)[k: k + n] + word(5)) for k, n in ((0, 200), (4, 43), (2, 39), (7, 48))]
    return rows + [(200, word(3000)), (201, c[:39] + word(50)), (202, c[:40] + word(50)), (203, "é" * 120)]


@pytest.mark.parametrize("most,chunk", [(2000, 1 << 20), (6, 64)])
def test_against_brute_force(spark, monkeypatch, most, chunk):
    monkeypatch.setattr(s, "MOST_FRAGMENTS", most)
    rows = texts_of(random.Random(most))
    docs = make_docs(spark, rows)
    got = [(r["row"]["doc_id"], *list(r["r"])[:4]) for r in s.suffix_dedup(docs, length=40, seed=20).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows, 40)))


def test_documents_at_full_length(spark, documents):
    rows = [r for r in documents if len(r[1]) < 8000]
    got = [(r["row"]["doc_id"], *list(r["r"])[:4]) for r in s.suffix_dedup(make_docs(spark, rows)).collect()]
    expected = brute(rows, 400)
    assert sum(e[2] for e in expected) > 0
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_empty_table(spark):
    assert s.suffix_dedup(make_docs(spark, [(1, "a")]).where("false")).count() == 0


def test_transform_of_a_collection():
    rnd = random.Random(2)
    strings = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 30))).encode() for _ in range(20)] + [b"", b"abababab" * 4] * 2
    suffixes = sorted((x[p:] + b"\0", i, p) if False else (bytes(v + 1 for v in x[p:]), i, p) for i, x in enumerate(strings) for p in range(len(x) + 1))
    bwt, lcp = s.collection_bwt(strings, 12)
    assert bwt.tolist() == [strings[i][p - 1] + 1 if p else 0 for _, i, p in suffixes]
    common = [0] + [next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y))) for (x, _, _), (y, _, _) in zip(suffixes, suffixes[1:])]
    assert lcp.tolist() == [min(12, c) for c in common]


def test_every_window_has_an_anchor_by_content():
    rnd = np.random.default_rng(4)
    for b in (rnd.integers(97, 99, 3000), np.full(2000, 97), np.tile(rnd.integers(97, 122, 7), 300), rnd.integers(0, 250, 40)):
        a, v, lo, last, spans = s.anchors(b.astype(np.uint8), 40, 20)
        covered = lambda p: any(x <= p and p + 40 <= y for x, y, *_ in spans)
        assert all(np.any((lo <= p) & (p <= last) & (p <= a) & (a <= p + 20)) or covered(p) for p in range(len(b) - 39))
        assert len(v) == len(a)


def test_no_shared_string_is_left_out_before_sorting():
    rnd = random.Random(5)
    for shared in (400, 401, 402, 403):
        for at in range(shared - 200 + 1):
            both = rnd.randbytes(shared)
            ends = [(rnd.randbytes(200 - at) if at < 200 else b"", rnd.randbytes(max(400 - shared + at, 0))) for _ in range(2)]
            texts = [x + both + y for x, y in ends]
            parts = s.promising(texts, [len(x) + at for x, _ in ends], 200, 200)
            first, last = max(at - 200, 0), min(at, shared - 400)  # starts of the 400-byte strings around the common key
            for (x, _), part in zip(ends, parts):
                assert part and part[0] <= len(x) + first and len(x) + last + 400 <= part[1], (shared, at)


def test_short_stretches_with_few_anchors_find_a_long_one(spark):
    rnd, rows = random.Random(6), []
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    for d in (66, 67, 68, 75, 100, 101, 133, 150, 199, 200):
        unit = word(d)
        rows.append((1000 * d, word(30) + unit * 10 + word(30)))
        rows += [(1000 * d + k, word(50) + (unit * 9)[k: k + n] + word(50)) for k in range(1, d, 29) for n in (400, 200 + 2 * d)]
    got = [(r["row"]["doc_id"], *list(r["r"])[:4]) for r in s.suffix_dedup(make_docs(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows, 400)))


@pytest.mark.parametrize("d", [67, 100, 150, 200])
def test_a_long_stretch_keeps_an_anchor_for_every_rotation(d):
    rnd = np.random.default_rng(d)
    unit = rnd.integers(97, 122, d).astype(np.uint8)
    long = np.concatenate([rnd.integers(97, 122, 30), np.tile(unit, 10), rnd.integers(97, 122, 30)]).astype(np.uint8)
    _, v, lo, last, _ = s.anchors(long, 400, 200)
    held = {(int(x), long[p: p + 400].tobytes()) for x, y, z in zip(v, lo, last) for p in range(y, z + 1)}
    for k in range(d):
        b = np.tile(unit, 10)[k: k + 400]
        _, w, _, _, _ = s.anchors(b, 400, 200)
        assert any((int(x), b.tobytes()) in held for x in w), k


def test_anchors_of_many_documents_are_handed_on_together(monkeypatch):
    rnd = random.Random(12)
    texts = ["".join(rnd.choice("abcé ") for _ in range(300)) for _ in range(30)] + ["x" * 500, "ab" * 300, "short"]
    ids = [None, *range(1, len(texts))]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "h": pa.array([7 * i for i in range(len(texts))], pa.int64()), "text": texts})
    whole = list(s.anchor_batches(iter([batch]), 40, 20))
    assert len(whole) == 1 and not list(s.anchor_batches(iter([batch.slice(0, 0), batch.slice(len(texts) - 1)]), 40, 20))
    monkeypatch.setattr(s, "OUT_ROWS", 1)
    parts = list(s.anchor_batches(iter([batch]), 40, 20))
    assert len(parts) == len(texts) - 1 and pa.Table.from_batches(parts).to_pylist() == whole[0].to_pylist()
    rows = [r for r in whole[0].to_pylist() if r["doc_id"] == ids[3]]
    a, v, lo, last, _ = s.anchors(np.frombuffer(texts[3].encode(), np.uint8), 40, 20)
    assert [(r["h"], r["a"], r["lo"], r["hi"], r["fp"]) for r in rows] == list(zip([21] * len(a), a.tolist(), lo.tolist(), (last + 40).tolist(), v.view(np.int64).tolist()))
    assert any(r["a"] is None for r in whole[0].to_pylist())  # periodic stretches
