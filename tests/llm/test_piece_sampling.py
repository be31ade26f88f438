import itertools
import math
from collections import Counter

import pytest

from atende.llm import piece_sampling as s


@pytest.fixture(scope="module")
def own():
    return s.Sampler(s.vocabulary())


def all_paths(own, text):
    """Probability of every segmentation of a short text, by plain enumeration."""
    full = s.SPACE + text.replace(" ", s.SPACE)
    paths = [((), 0.0, 0)]
    done = []
    while paths:
        ids, score, at = paths.pop()
        if at == len(full):
            done.append((ids, score))
        for j in range(at + 1, len(full) + 1):
            if full[at:j] in own.pieces:
                i, w = own.pieces[full[at:j]]
                paths.append((ids + (i,), score + w, j))
    top = sum(math.exp(x) for _, x in done)
    return {ids: math.exp(x) / top for ids, x in done}


def test_samples_are_drawn_without_replacement(own):
    exact, pairs = all_paths(own, "at on"), Counter()
    runs = 4000
    for seed in range(runs):
        got = own.sample("at on", 2, seed)
        assert len({tuple(x[0]) for x in got}) == 2
        for ids, p, _ in got:
            assert math.isclose(math.exp(p), exact[tuple(ids)], rel_tol=1e-9)
        pairs[tuple(tuple(x[0]) for x in got)] += 1
    for a, b in itertools.permutations(exact, 2):
        expected = exact[a] * exact[b] / (1 - exact[a])
        assert abs(pairs[a, b] / runs - expected) < 5 * math.sqrt(expected / runs) + 0.002


def test_inclusion_scores_are_unbiased(own):
    exact, total = all_paths(own, "the"), 0.0
    for seed in range(3000):
        total += sum(math.exp(p - q) for _, p, q in own.sample("the", 2, seed))
    assert abs(total / 3000 - sum(exact.values())) < 0.1


def test_third_draw_and_a_small_cache(own, monkeypatch):
    """Three of the segmentations of one word in order, also where no lattice is kept."""
    monkeypatch.setattr(s, "CACHE_BYTES", 0)
    exact, triples, runs = all_paths(own, "one"), Counter(), 6000
    for seed in range(runs):
        triples[tuple(tuple(x[0]) for x in own.sample("one", 3, seed))] += 1
    for a, b, c in itertools.permutations(exact, 3):
        expected = exact[a] * exact[b] / (1 - exact[a]) * exact[c] / (1 - exact[a] - exact[b])
        assert abs(triples[a, b, c] / runs - expected) < 5 * math.sqrt(expected / runs) + 0.002


@pytest.mark.parametrize("text", ["7" * 100_000, "漢字語" * 30_000, "1234567890" * 10_000, "🤦" * 20_000, "http://example.org/" + "aB3-" * 20_000, "x" * 100_000])
def test_long_texts_without_spaces(own, text):
    got = own.sample(text, 4, 3)
    ways = own.word(s.SPACE + text).ways[0]
    assert len({x[0].tobytes() for x in got}) == min(4, ways) and all(own.decode(x[0]) == text for x in got)
    assert not own.words.get(s.SPACE + text)


def test_few_segmentations_are_all_given(own):
    exact = all_paths(own, "a b")
    got = own.sample("a b", 100, 1)
    assert {tuple(x[0]) for x in got} == set(exact) and all(q == 0.0 for _, _, q in got)


@pytest.mark.parametrize("text", ["", " ", "a", "  two  spaces ", "tab\there\n\nlines", "é漢字🤦 ͸", "x" * 3000, "word " * 3000, "Internationalization of antidisestablishmentarianism"])
def test_round_trip_and_seed(own, text):
    got = own.sample(text, 3, 7)
    assert [(x[0].tolist(), *x[1:]) for x in got] == [(x[0].tolist(), *x[1:]) for x in own.sample(text, 3, 7)]
    assert len({tuple(x[0]) for x in got}) == len(got) >= 1
    assert all(own.decode(ids) == text for ids, _, _ in got)


def test_table(spark):
    rows = [(1, 0, "hello there", "x"), (1, 0, "hello there", "x"), (1, 1, None, "x"), (None, 2, "", "x"), (3, None, "other words", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, ids string")
    out = s.sample_pieces(df, ["conv_id", "turn"]).collect()
    assert Counter((r.conv_id, r.turn) for r in out) == {(1, 0): 8, (1, 1): 1, (None, 2): 1, (3, None): 4}
    assert all(r.decoded and r.n_pieces == len(r.ids) for r in out)
    assert sorted(r.ids_crc32 for r in out if r.turn == 0)[::2] == sorted(r.ids_crc32 for r in out if r.turn == 0)[1::2]
    assert s.sample_pieces(df.where("false"), ["conv_id"]).count() == 0
