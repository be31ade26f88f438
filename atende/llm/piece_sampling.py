"""SentencePiece segmentations sampled without replacement, and decoding.

Pieces of the vocabulary are edges of a lattice over the text; a segmentation is a path, with a
probability proportional to the product of its piece weights. The Gumbel top-k trick gives k distinct
paths as if drawn one after the other without replacement: each path has a perturbed log-probability,
and the k largest are found by A* search. An agenda holds sets of paths that agree up to some word; the
log-mass of a set, exact by the lattice sums of its words, and the perturbed maximum drawn for it bound
all its paths. The best set gives its best path, and is split into the sets that leave this path at each
word, whose maxima are drawn as Gumbels truncated at the parent's.

No piece of the vocabulary goes over the start of a word (a run of spaces and what follows), so the
lattice of a text is a chain of word lattices and a set is known by its prefix and the word it leaves at.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
# Weight of a piece by its rank in the vocabulary (its merge order, at most the size): 1 / (rank + SHIFT) ** alpha.
SHIFT = 2.7
ALPHA = 1.0
# Log-weight of each byte of a character that the vocabulary lacks.
BYTE_SCORE = -20.0
# Segmentations of a word are counted up to this number; a word is asked for fewer than that.
MOST_WAYS = 1 << 24
# Bytes of lattices that a worker keeps, and characters of the longest word it keeps. A cache only: it changes no result.
CACHE_BYTES = 64 << 20
CACHE_CHARS = 64
# Ids of the rows that are handed on at a time.
BATCH_IDS = 1 << 18
SAMPLES = 4
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Word:
    """Lattice of one word, edges of each place one after the other, with the probability of each among those of its place.

    Edge probabilities count all that may follow, so a path drawn edge by edge is a draw of a segmentation.
    """

    def __init__(self, text: str, pieces: dict[str, tuple[int, float]], longest: int):
        n = len(text)
        self.first, ends, ids, scores = array("i", [0]), array("i"), array("i"), array("d")
        for i in range(n):
            for j in range(i + 1, min(n, i + longest) + 1):
                if (piece := pieces.get(text[i:j])) is not None:
                    ends.append(j)
                    ids.append(piece[0])
                    scores.append(piece[1])
                elif j == i + 1:  # a character without a piece goes as its bytes
                    ends.append(j)
                    ids.append(-ord(text[i]) - 1)
                    scores.append(BYTE_SCORE * len(text[i].encode()))
            self.first.append(len(ends))
        rest, self.ways = array("d", bytes(8 * n)) + array("d", [0.0]), array("i", bytes(4 * n)) + array("i", [1])
        self.cumulated = array("d", bytes(8 * len(ends)))
        first, ways, cumulated = self.first, self.ways, self.cumulated
        for i in range(n - 1, -1, -1):
            own = range(first[i], first[i + 1])
            ways[i] = min(MOST_WAYS, sum(ways[ends[e]] for e in own))
            logs = [scores[e] + rest[ends[e]] for e in own]
            top = max(logs)
            total = math.fsum(math.exp(x - top) for x in logs)
            rest[i] = top + math.log(total)
            so_far = 0.0
            for e, x in zip(own, logs):
                scores[e] = x - rest[i]  # the logarithm of the edge's probability from here on
                so_far += math.exp(scores[e])
                cumulated[e] = so_far
        self.ends, self.ids, self.logs = ends, ids, scores

    def bytes(self) -> int:
        return 400 + 8 * len(self.first) + 24 * len(self.ends)

    def draw(self, draws: list[float], at: int) -> tuple[tuple[int, ...], float]:
        """(edges, log-probability) of a segmentation by the uniform draws from ``at`` on."""
        first, ends, logs, cumulated = self.first, self.ends, self.logs, self.cumulated
        i, last, path, log = 0, len(first) - 1, [], 0.0
        while i < last:
            e = bisect_left(cumulated, draws[at + i], first[i], first[i + 1] - 1)
            path.append(e)
            log += logs[e]
            i = ends[e]
        return tuple(path), log

    def draw_without(self, draws: list[float], at: int, without: dict[tuple[int, ...], float]) -> tuple[tuple[int, ...], float]:
        """A segmentation that is not among ``without``, in proportion to the probabilities of all others."""
        i, path, log, live = 0, [], 0.0, list(without)
        while i < len(self.first) - 1:
            if not live:
                more, further = self._tail(i, draws, at)
                return tuple(path) + more, log + further
            own = range(self.first[i], self.first[i + 1])
            masses = [self._left(e, [p for p in live if p[len(path)] == e], len(path)) for e in own]
            u, k = draws[at + i] * math.fsum(masses), 0
            while k < len(masses) - 1 and (u >= masses[k] or masses[k] == 0.0):
                u -= masses[k]
                k += 1
            while masses[k] == 0.0:  # rounding went past the last edge with mass
                k -= 1
            e = own[k]
            live = [p for p in live if p[len(path)] == e]
            path.append(e)
            log += self.logs[e]
            i = self.ends[e]
        return tuple(path), log

    def _tail(self, i: int, draws: list[float], at: int) -> tuple[tuple[int, ...], float]:
        path, log = [], 0.0
        while i < len(self.first) - 1:
            e = bisect_left(self.cumulated, draws[at + i], self.first[i], self.first[i + 1] - 1)
            path.append(e)
            log += self.logs[e]
            i = self.ends[e]
        return tuple(path), log

    def _left(self, edge: int, without: list[tuple[int, ...]], depth: int) -> float:
        """Probability of the edge and all that may follow, less the paths ``without`` that take it."""
        p = math.exp(self.logs[edge])
        return p if not without else p * self.open_mass([x[depth + 1:] for x in without], self.ends[edge])

    def open_mass(self, without: list[tuple[int, ...]], i: int = 0) -> float:
        """Probability, from place i on, of all paths but those given; summed over the edges that leave them, so nothing cancels."""
        total: list[float] = []
        work = [(i, 0.0, 0, without)]
        while work:
            i, log, depth, own = work.pop()
            if len(own) >= self.ways[i]:  # at its cap a place has more ways than any list of paths
                continue
            taken: dict[int, list[tuple[int, ...]]] = {}
            for p in own:
                taken.setdefault(p[depth], []).append(p)
            for e in range(self.first[i], self.first[i + 1]):
                if e in taken:
                    work.append((self.ends[e], log + self.logs[e], depth + 1, taken[e]))
                else:
                    total.append(math.exp(log + self.logs[e]))
        return math.fsum(total)


class Sampler:
    """Segmentations of texts under one vocabulary file."""

    def __init__(self, path: str, alpha: float = ALPHA):
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.pieces = {sp.id_to_piece(i): (i, -alpha * math.log(SHIFT + min(-sp.get_score(i), sp.get_piece_size()))) for i in normal}
        self.longest = max(map(len, self.pieces))
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.words: dict[str, Word] = {}
        self.held = 0
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece goes over the start of a word")

    def word(self, text: str) -> Word:
        found = self.words.get(text)
        if found is None:
            found = Word(text, self.pieces, self.longest)
            if self.held > CACHE_BYTES:
                self.words.clear()
                self.held = 0
            if len(text) <= CACHE_CHARS:
                self.words[text] = found
                self.held += found.bytes()
        return found

    def ids(self, words: list[Word], path: list[tuple[tuple[int, ...], float]]) -> np.ndarray:
        found = [w.ids[e] for w, (edges, _) in zip(words, path) for e in edges]
        if found and min(found) < 0:
            found = [y for x in found for y in ([x] if x >= 0 else [self.byte_ids[b] for b in chr(-x - 1).encode()])]
        return np.array(found, np.int32)

    def sample(self, text: str, k: int, seed: int) -> list[tuple[np.ndarray, float, float]]:
        """Up to k distinct (ids, log-probability, log inclusion probability), best perturbed value first.

        The text is taken as it is, after a dummy space; an empty one has the empty segmentation only. The
        inclusion probability is that of the threshold, the perturbed value of the (k + 1)-th.
        """
        texts = _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []
        words = [self.word(w) for w in texts]
        starts = [0, *itertools.accumulate(map(len, texts))]
        rng, n = np.random.default_rng(seed), len(words)
        several = np.array([w.ways[0] > 1 for w in words], bool)
        # A set: (-perturbed maximum, number, path whose first ``at`` words are fixed, at, left-out segmentations of word ``at``).
        agenda: list[tuple] = [(-rng.gumbel(), 0, [], 0, {})]
        number, out = 1, []
        while agenda and len(out) <= k:
            value, _, path, at, without = heapq.heappop(agenda)
            if len(out) == k:
                out.append((None, 0.0, -value))
                break
            draws = rng.random(starts[-1]).tolist()
            new = [w.draw(draws, s) for w, s in zip(words[at:], starts[at:])]
            if without:
                new[0] = words[at].draw_without(draws, starts[at], without)
            path = path[:at] + new
            logs = np.array([p for _, p in path])
            out.append((self.ids(words, path), float(logs.sum()), -value))
            # Sets that leave the path at word t; only as many as may still be needed go on the agenda.
            before = np.concatenate([[0.0], np.cumsum(logs)])[at:n]
            own = logs[at:]
            with np.errstate(divide="ignore"):
                masses = np.where(several[at:], np.log1p(-np.exp(np.minimum(own, -1e-9))), -np.inf)
            for t in np.flatnonzero(several[at:] & (own > -1e-6)).tolist():  # where the difference to one would lose digits
                masses[t] = _log(words[at + t].open_mass([path[at + t][0]]))
            if n > at:
                first = without | {path[at][0]: path[at][1]}
                masses[0] = _log(words[at].open_mass(list(first)))
            masses += before
            with np.errstate(divide="ignore", over="ignore"):
                values = -np.logaddexp(value, -masses + np.log(rng.exponential(size=len(masses))))
            ready = np.flatnonzero(masses > -np.inf)
            for t in ready[np.argsort(-values[ready], kind="stable")][: k + 1 - len(out)].tolist():
                excluded = first if t == 0 else {path[at + t][0]: path[at + t][1]}
                heapq.heappush(agenda, (-float(values[t]), number, path, at + t, excluded))
                number += 1
        threshold = out.pop()[2] if len(out) > k else -math.inf
        score = lambda p: 0.0 if threshold == -math.inf else _log1mexp(p - threshold)
        return [(ids, p, score(p)) for ids, p, _ in out]

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist()) if len(ids) else ""


def _log(x: float) -> float:
    return math.log(x) if x > 0 else -math.inf


def _log1mexp(x: float) -> float:
    """log(1 - exp(-exp(x)))"""
    return x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 700.0))))


@lru_cache(2)
def sampler(path: str, alpha: float) -> Sampler:
    return Sampler(path, alpha)


def sample_pieces(
    docs: DataFrame, keys: list[str], text: str = "text", samples: int = SAMPLES, alpha: float = ALPHA, path: str | None = None
) -> DataFrame:
    """(keys, sample, ids, n_pieces, log_prob, log_inclusion, decoded) of every row and sample.

    The draw is seeded by the keys and the text of the row, so repeated rows and later runs get the same
    segmentations. Texts with fewer segmentations give all they have; null and empty texts give the empty one.
    ``decoded`` tells whether the ids decode to the text. Other columns are not read; an empty table gives
    an empty result. A text is normalised by nothing but the dummy space that the vocabulary adds.
    """
    rows = docs.select(F.struct(*keys).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    result = T.StructType([
        rows.schema["key"], T.StructField("sample", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ids_crc32", T.LongType()),
        T.StructField("n_pieces", T.LongType()), T.StructField("log_prob", T.DoubleType()), T.StructField("log_inclusion", T.DoubleType()), T.StructField("decoded", T.BooleanType()),
    ])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(path or vocabulary(), alpha)
        for batch in batches:
            at, out, size = [], [], 0
            for i, (key, body) in enumerate(zip(batch.column("key").to_pylist(), batch.column("text"))):
                body = body.as_py()
                seed = xxhash.xxh3_64_intdigest(repr((list(key.values()), body)).encode("utf-8", "surrogatepass"))
                for rank, (ids, p, q) in enumerate(own.sample(body, samples, seed)):
                    at.append(i)
                    out.append((rank, ids, zlib.crc32(ids.astype("<u4").tobytes()), len(ids), p, q, own.decode(ids) == body))
                    size += len(ids)
                    if size >= BATCH_IDS:
                        yield packed(batch, at, out)
                        at, out, size = [], [], 0
            if out:
                yield packed(batch, at, out)

    def packed(batch: pa.RecordBatch, at: list[int], out: list[tuple]) -> pa.RecordBatch:
        rank, ids, *others = zip(*out)
        lists = pa.ListArray.from_arrays(pa.array([0, *itertools.accumulate(map(len, ids))], pa.int32()), pa.array(np.concatenate(ids)))
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
        columns = [pa.array(rank, pa.int32()), lists, *(pa.array(c, k) for c, k in zip(others, kinds))]
        return pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(at, pa.int64())), *columns], names=result.names)

    return rows.mapInArrow(draw, result).select("key.*", *result.names[1:])
