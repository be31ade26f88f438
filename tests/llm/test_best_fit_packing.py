import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm.conftest import make_docs
from tokenizers import Tokenizer

from atende.llm import best_fit_packing as p
from atende.llm.tokens import encoder


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(p.vocabulary())


CASES = [
    None, "", " ", "  ", "a", "a  b", " a", "a ", "a\n b\t c", "a \n\n b", "x y z", "é漢字🤦 🤦", "it's  we'll", "1 23 456,7 !!?  ...", "\r\n \r\n",
    "q" * 5000, "word " * 4000, "don't stop now then\x0b go", " leading and trailing ", "tab\tseparated words here are\there",
]


def test_ids_are_those_of_the_library(reference, documents):
    encode = encoder(p.vocabulary())
    for text in [t or "" for t in CASES] + [t for _, t in documents]:
        assert np.frombuffer(encode(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


def test_every_piece_once_and_no_gaps(spark, reference, documents):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(3, "  "), (None, "a b c")] + [(i + 100, t) for i, t in documents]
    got = p.best_fit_packing(make_docs(spark, rows), size=256).collect()
    expected = Counter()
    for d, t in rows:
        ids = reference.encode(t or "", add_special_tokens=False).ids + [0]
        edges = [0, *range(len(ids) % 256 or 256, len(ids) + 1, 256)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            expected[d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        ends = [o + n for o, n in parts]
        assert [o for o, _ in parts] == [0, *ends[:-1]] and ends[-1] <= 256
    total = sum(r.length for r in got)
    assert len(sequences) <= 1.01 * total / 256 + 1


def test_empty_table(spark):
    assert p.best_fit_packing(make_docs(spark, [(1, "a")]).where("false")).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_plan_uses_all_pieces(seed):
    rnd = random.Random(seed)
    size = rnd.choice([10, 50, 300])
    lengths = {n: rnd.choice([1, 2, 3, 50, 10**9]) for n in rnd.sample(range(1, size + 1), rnd.randint(1, min(size, 60)))}
    used = Counter()
    for parts, times in p.plan(lengths, size):
        assert sum(parts) <= size and times > 0
        for n in parts:
            used[n] += times
    assert used == lengths
    assert len(p.plan(lengths, size)) < 40 * size


def test_exact_complements_beat_plain_best_fit():
    # Longest-first alone opens three sequences here; 6+4, 5+3+2 fill two exactly.
    assert sum(t for _, t in p.plan({6: 1, 5: 1, 4: 1, 3: 1, 2: 1}, 10)) == 2
