import random

import numpy as np
import pytest
import xxhash
from tests.llm.conftest import make_docs

from atende.llm import common
from atende.llm.simhash_dedup import fingerprint, keep_one, simhash_components


def brute_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i: i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    codes = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{codes[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)]


def near_rows():
    rnd = random.Random(5)
    base = [rnd.choice("abcdefghij") * rnd.randint(1, 3) + str(rnd.randint(0, 40)) for _ in range(300)]
    rows = [(None, "lone text of a null id"), (900, None), (901, ""), (902, " \n"), (903, "one"), (903, "one"), (904, "ONE"), (905, "é É x y z")]
    for i in range(120):  # a large group of near copies
        words = list(base)
        words[rnd.randrange(300)] = f"new{i}"
        rows.append((1000 + i, " ".join(words)))
    return rows + [(2000 + i, " ".join(base)) for i in range(10)]


def test_fingerprint():
    for text in [None, "", "a", "a b c", "A b c d", "x " * 100_000, "é ü\x0bq\xa0r s t u", " ".join(map(str, range(3000)))]:
        assert fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("block", [4000, 8])
def test_components_against_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(common, "MOST_HOT_KEYS", 1 << 40)
    monkeypatch.setattr(common, "HOT_SAMPLE", 1 if block == 8 else 16)
    monkeypatch.setattr(common.dealt_buckets, "__defaults__", (block,))
    rows = near_rows() + documents
    got = [tuple(r)[:3] for r in simhash_components(make_docs(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_components(rows)))


def test_keep_one_leaves_one_row_per_component(spark, documents):
    rows = near_rows() + documents
    docs = make_docs(spark, rows)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None))
    assert got == sorted({c for _, _, c in brute_components(rows) if c is not None})
    assert kept.where("doc_id is null").count() == 1
    assert keep_one(docs.where("false")).count() == 0


def test_links_are_all_found_between_random_codes(spark):
    rnd = np.random.default_rng(3)
    codes = rnd.integers(-(1 << 62), 1 << 62, 300)
    flips = [int(c) ^ sum(1 << int(b) for b in rnd.choice(62, 4, replace=False)) for c in codes]
    from atende.llm.simhash_dedup import variants

    df = spark.createDataFrame([(int(c),) for c in [*codes, *flips]], "code long")
    links = {(r.u, r.v) for r in common.code_links(variants(df), 600 * 64, 4).collect()}
    assert {(min(a, b), max(a, b)) for a, b in zip(map(int, codes), flips)} <= links


def test_long_chains_meet_in_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "u long, v long")
    got = {r.node: r.root for r in common.components(links, common.Stage(links)).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def test_few_links_are_joined_by_one_task_and_many_in_rounds(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rnd.integers(-150, 150, (130, 2))]
    links = spark.createDataFrame(pairs, "u long, v long")
    root = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in range(len(root)):
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    written = []
    monkeypatch.setattr(common.Stage, "__call__", lambda self, df, f=common.Stage.__call__: written.append(1) or f(self, df))
    for few in (len(pairs), 0):
        monkeypatch.setattr(common, "FEW_LINKS", few)
        assert {r.node: r.root for r in common.components(links, common.Stage(links)).collect()} == root
        assert (len(written) == 1) == (few > 0)
    assert common.components(links.where("false"), common.Stage(links)).count() == 0
