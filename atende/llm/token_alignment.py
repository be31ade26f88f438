"""Alignment of two tokenizers by lockstep vectorised merging.

Both tokenizers cut the same bytes. One NumPy state vector holds a pointer into the A tokens and one into
the B tokens of every document of a batch; each step emits the link of the two tokens pointed at, for all
documents at once, marks a cut where both tokens end at the same byte, advances the pointer whose token ends first
(both at a cut) and drops the documents that are done. Long documents take several lanes of the vector,
which start at places where tokens of both end, so that a batch takes about as many steps as a lane has tokens.

How often a pair of ids is linked in the whole corpus is a distributed sum over the links of documents. The
documents then look their pairs up: the most frequent ones in a broadcast table of a bounded size, all others
by a join on the pair, so rare pairs alone are shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atende.llm.common import Stage
from atende.llm.tokens import Encoder

# Bytes of text whose documents are merged together, and the tokens of a lane.
CHUNK_BYTES = 1 << 21
LANE = 512
# How many A tokens on from its target a lane may start.
LANE_SEARCH = 64
# Most pairs in the broadcast table of counts, about 17 bytes each.
MOST_PAIRS = 2_000_000
# Pairs that a task adds up before it hands them on.
PAIR_BUFFER = 1 << 21
# Ids that are written out at a time for a digest.
_BLOCK = 1 << 16
_PART = 1 << 20


def vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Tokenizers:
    """Both tokenizers: ids of a text, and the bytes of each id."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Encoder(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        enc, sp = self.a.enc, self.b
        self.bytes_a = [_token_or_none(enc, i) for i in range(enc.n_vocab)]
        self.bytes_b = [_piece_bytes(sp, i) for i in range(sp.get_piece_size())]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.size_b = len(self.bytes_b)
        self.pair_type = np.dtype("<u4" if len(self.bytes_a) * self.size_b < 1 << 32 else "<u8")
        # Where no piece goes over the start of a word, long texts are encoded in parts between single spaces.
        self.parts = not any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(self.size_b))
        most = max(len(self.bytes_a), self.size_b)
        # Decimal ids followed by each separator, and by none.
        self.width = most
        self.decimal = [b"%d%b" % (i, sep) for sep in (b",", b"|", b";", b"") for i in range(most)]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """(A ids of space + text, B ids) of each text, None where there are no tokens."""
        short = [t for t in texts if 0 < len(t) <= _PART]
        ids_b = iter(self.b.encode(short, num_threads=1)) if short else iter(())
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text in texts:
            if not text:
                out.append(None)
                continue
            b = np.array(next(ids_b) if len(text) <= _PART else self._long(text), np.int32)
            a = np.frombuffer(self.a(" " + text), "<u4").astype(np.int32)
            data = b" " + text.encode()
            same = b"".join(map(self.bytes_a.__getitem__, a.tolist())) == data == b"".join(map(self.bytes_b.__getitem__, b.tolist()))
            out.append((a, b) if same else None)
        return out

    def _long(self, text: str) -> np.ndarray:
        cuts, at = [0], _PART
        while self.parts and at < len(text):
            m = _SINGLE_SPACE.search(text, at)
            if not m:
                break
            cuts.append(m.start() + 2)
            at = cuts[-1] + _PART
        ends = [c - 1 for c in cuts[1:]] + [len(text)]
        return np.concatenate([np.array(self.b.encode(text[s:e]), np.int32) for s, e in zip(cuts, ends)])


_SINGLE_SPACE = re.compile(r"[^ ▁] (?=[^ ▁])")


def _token_or_none(enc, i: int) -> bytes:
    try:
        return enc.decode_single_token_bytes(i)
    except KeyError:
        return b""


def _piece_bytes(sp, i: int) -> bytes:
    piece = sp.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()


@lru_cache(2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


class Merged:
    """Documents of a chunk, one after the other: links, cuts and where each document starts."""

    def __init__(self, own: Tokenizers, docs: list[tuple[np.ndarray, np.ndarray]], lane: int = LANE):
        self.own = own
        self.start_a, self.start_b = (np.concatenate([[0], np.cumsum([len(d[k]) for d in docs])]).astype(np.int64) for k in (0, 1))
        self.a, self.b = (np.concatenate([d[k] for d in docs]) if docs else np.zeros(0, np.int32) for k in (0, 1))
        end_a, end_b = np.cumsum(own.length_a[self.a]), np.cumsum(own.length_b[self.b])
        self.end_a = end_a
        links = np.zeros(len(self.a) + len(self.b), np.int64)
        self.last_a, self.last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        used = np.zeros(len(links), bool)
        i, j, stop = self._lanes(end_a, end_b, lane)
        while len(i):
            ends_a, ends_b, at = end_a[i], end_b[j], i + j
            links[at] = self.a[i].astype(np.int64) * own.size_b + self.b[j]
            used[at] = True
            cut = ends_a == ends_b
            self.last_a[i[cut]] = True
            self.last_b[j[cut]] = True
            i, j = i + (ends_a <= ends_b), j + (ends_b <= ends_a)
            going = i < stop
            if not going.all():
                i, j, stop = i[going], j[going], stop[going]
        # i + j grows with every step, so that the links of a document lie between its first sums, in order.
        self.links = links[used]
        before = np.concatenate([[0], np.cumsum(used)])
        self.start_link = before[self.start_a + self.start_b]
        groups_before = np.concatenate([[0], np.cumsum(self.last_a)])
        self.start_group = groups_before[self.start_a]

    def _lanes(self, end_a: np.ndarray, end_b: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First A and B token of each lane, and the A token it ends before."""
        full = np.diff(self.start_a) > 0
        first_a, first_b = self.start_a[:-1][full], self.start_b[:-1][full]
        target = np.arange(lane, len(self.a), lane)
        for _ in range(LANE_SEARCH):
            if not len(target):
                break
            j = np.minimum(np.searchsorted(end_b, end_a[target]), len(end_b) - 1)
            here = (end_b[j] == end_a[target]) & (target + 1 < len(self.a))
            first_a, first_b = np.append(first_a, target[here] + 1), np.append(first_b, j[here] + 1)
            target = target[~here] + 1
            target = target[target < len(self.a)]
        first_a, at = np.unique(first_a, return_index=True)
        return first_a, first_b[at], np.append(first_a[1:], len(self.a))

    def groups(self) -> list[str]:
        """Digest of the groups of each document: a1,a2|b1;a3|b2."""
        group_a, group_b = (np.cumsum(x) - x for x in (self.last_a, self.last_b))
        ends_a, ends_b = np.flatnonzero(self.last_a) + 1, np.flatnonzero(self.last_b) + 1
        starts_b = np.concatenate([[0], ends_b])
        mixed = np.zeros(len(self.a) + len(self.b), np.int64)
        width = self.own.width
        mixed[np.arange(len(self.a)) + starts_b[group_a]] = self.a + width * self.last_a
        mixed[np.arange(len(self.b)) + ends_a[group_b]] = self.b + 2 * width * self.last_b
        bounds, get, out = self.start_a + self.start_b, self.own.decimal.__getitem__, []
        mixed[bounds[1:][np.diff(bounds) > 0] - 1] += width  # no separator after the last group
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if s == e:
                out.append("")
                continue
            digest = hashlib.sha256()
            for at in range(s, e, _BLOCK):
                digest.update(b"".join(map(get, mixed[at: min(at + _BLOCK, e)].tolist())))
            out.append(digest.hexdigest())
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of each document in order, how often it links each, and where each document starts."""
        doc = np.repeat(np.arange(len(self.start_link) - 1, dtype=np.uint64), np.diff(self.start_link))
        size = np.uint64(len(self.own.bytes_a) * self.own.size_b)
        keys, n = np.unique(doc * size + self.links.astype(np.uint64), return_counts=True)
        starts = np.searchsorted(keys, np.arange(len(self.start_link), dtype=np.uint64) * size)
        return keys % size, n, starts


def _chunks(batches: Iterator[pa.RecordBatch], own: Tokenizers) -> Iterator[tuple[pa.RecordBatch, list[bool], Merged]]:
    """Slices of the batches of about CHUNK_BYTES of text (column text), whether each row has tokens, and their alignment."""
    for batch in batches:
        texts, first, size = [], 0, 0
        for k, body in enumerate(batch.column("text")):
            texts.append(body.as_py() or "")
            size += len(texts[-1])
            if size >= CHUNK_BYTES or k + 1 == len(batch):
                ids = own.encode(texts)
                none = (np.zeros(0, np.int32), np.zeros(0, np.int32))
                yield batch.slice(first, len(texts)), [x is not None for x in ids], Merged(own, [x or none for x in ids])
                texts, first, size = [], k + 1, 0


def _rows(docs: DataFrame, text: str) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("int").alias("none")]
    return docs.select(F.struct(*rest).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))


def align(docs: DataFrame, text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """(row, a, b, links, cuts) of every row: its other columns, the ids of both tokenizers and their alignment.

    links are the (position in a, position in b) of tokens whose bytes overlap, in order; cuts the
    (a, b, bytes) before which a group ends. A null or empty text, and one whose bytes the ids do not give
    back, has empty arrays. Repeated rows give equal results; an empty table gives an empty result. The
    other columns are carried as a struct and may have any name.
    """
    rows = _rows(docs, text)
    place = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    cut = T.StructType([*place.fields, T.StructField("bytes", T.LongType())])
    schema = T.StructType([
        rows.schema["row"], T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("b", T.ArrayType(T.IntegerType())),
        T.StructField("links", T.ArrayType(place)), T.StructField("cuts", T.ArrayType(cut)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(*(paths or vocabularies()))
        for batch, _, m in _chunks(batches, own):
            # Positions of the links: the group of each token, and overlaps of byte ranges inside it.
            group_starts = [np.concatenate([[0], np.flatnonzero(x) + 1]) for x in (m.last_a, m.last_b)]
            i, j = _positions(m)
            doc_of_link = np.repeat(np.arange(len(batch)), np.diff(m.start_link))
            links = pa.StructArray.from_arrays([pa.array((i - m.start_a[doc_of_link]).astype(np.int32)), pa.array((j - m.start_b[doc_of_link]).astype(np.int32))], ["a", "b"])
            doc_of_group = np.repeat(np.arange(len(batch)), np.diff(m.start_group))
            ends_a, ends_b = group_starts[0][1:], group_starts[1][1:]
            at_byte = m.end_a[ends_a - 1] - np.concatenate([[0], m.end_a])[m.start_a[doc_of_group]]
            cuts = pa.StructArray.from_arrays([
                pa.array((ends_a - m.start_a[doc_of_group]).astype(np.int32)), pa.array((ends_b - m.start_b[doc_of_group]).astype(np.int32)), pa.array(at_byte),
            ], ["a", "b", "bytes"])
            lists = [
                pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values)
                for starts, values in ((m.start_a, pa.array(m.a)), (m.start_b, pa.array(m.b)), (m.start_link, links), (m.start_group, cuts))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *lists], names=schema.names)

    return rows.mapInArrow(run, schema)


def _positions(m: Merged) -> tuple[np.ndarray, np.ndarray]:
    """A and B position of every link, by the order of the steps: each ends the A token, the B token or both."""
    starts_a = np.concatenate([[0], m.end_a[:-1]]) if len(m.a) else m.end_a
    end_b = np.cumsum(m.own.length_b[m.b])
    starts_b = np.concatenate([[0], end_b[:-1]]) if len(m.b) else end_b
    begin = np.union1d(starts_a, starts_b)  # a link begins where one of its tokens does
    return np.searchsorted(starts_a, begin, "right") - 1, np.searchsorted(starts_b, begin, "right") - 1


# --- Counts over the corpus -----------------------------------------------------------------


def _aligned(rows: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times): one pass over the texts.

    pairs holds the distinct linked pairs of a row, sorted and as differences, times how often each is linked.
    """
    names = ("n_a", "n_b", "n_groups", "n_links")
    schema = T.StructType([
        rows.schema["row"], *(T.StructField(n, T.LongType()) for n in names), T.StructField("groups_sha256", T.StringType()),
        T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(*paths)
        for batch, _, m in _chunks(batches, own):
            pairs, n, starts = m.pairs()
            steps = np.diff(pairs, prepend=np.uint64(0))
            first = starts[:-1][np.diff(starts) > 0]
            steps[first] = pairs[first]
            steps, n = steps.astype(own.pair_type), n.astype("<u4")
            cut = lambda x: pa.array([x[s:e].tobytes() for s, e in zip(starts[:-1].tolist(), starts[1:].tolist())], pa.binary())
            counts = [pa.array(np.diff(x).astype(np.int64)) for x in (m.start_a, m.start_b, m.start_group, m.start_link)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *counts, pa.array(m.groups(), pa.string()), cut(steps), cut(n)], names=schema.names)

    return rows.mapInArrow(run, schema)


def _pairs_of(batch: pa.RecordBatch, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and times of all rows of a batch, and the number of pairs of each row."""
    pairs = [np.cumsum(np.frombuffer(x.as_py(), kind), dtype=np.int64) for x in batch.column("pairs")]
    times = [np.frombuffer(x.as_py(), "<u4") for x in batch.column("times")]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *pairs]), np.concatenate([none, *times]), np.array([len(p) for p in pairs], np.int64)


def _added(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, times = pairs[order], times[order]
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[first], np.add.reduceat(times, first) if len(first) else times


def pair_counts(aligned: DataFrame, kind: np.dtype) -> DataFrame:
    """(pair, n): how often each pair is linked in all rows; tasks add up what they hold before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            pairs, times, _ = _pairs_of(batch, kind)
            held.append(_added(pairs, times))
            size += len(held[-1][0])
            if size >= PAIR_BUFFER:
                held = [_added(*map(np.concatenate, zip(*held)))]
                size = len(held[0][0])
                if size >= PAIR_BUFFER // 2:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch([_added(*map(np.concatenate, zip(*held)))])

    def _batch(held) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1].astype(np.int64))], names=["pair", "n"])

    return aligned.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _looked_up(aligned: DataFrame, hot: DataFrame, kind: np.dtype) -> DataFrame:
    """The rows with the sums over their frequent pairs (n_best, count_sum), and their other pairs (rare)."""
    table = hot.select("pair", "n", "best").toPandas().sort_values("pair")  # at most MOST_PAIRS rows
    shared = aligned.sparkSession.sparkContext.broadcast((table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64), table["best"].to_numpy(bool)))
    kept = [f for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    rare = T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("times", T.LongType())]))
    schema = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), T.StructField("rare", rare)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = shared.value
        for batch in batches:
            pairs, times, sizes = _pairs_of(batch, kind)
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            at[~hit] = 0
            ends = np.cumsum(sizes)
            per_row = lambda x: pa.array(np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[np.concatenate([[0], ends])]))
            n_best = per_row(np.where(hit & best[at], times, 0)) if len(known) else per_row(times * 0)
            total = per_row(np.where(hit, times * counts[at], 0)) if len(known) else per_row(times * 0)
            missing = np.concatenate([[0], np.cumsum(~hit)])[np.concatenate([[0], ends])].astype(np.int32)
            others = pa.StructArray.from_arrays([pa.array(pairs[~hit]), pa.array(times[~hit].astype(np.int64))], ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), n_best, total, pa.ListArray.from_arrays(pa.array(missing), others)], names=schema.names
            )

    return aligned.mapInArrow(run, schema)


def alignment_counts(docs: DataFrame, text: str = "text", paths: tuple[str, str] | None = None, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row: its other columns and figures.

    The count of an id pair is how many links of the whole table link it; n_best are the links of a row
    whose count is the highest of their B id (ties included), count_sum the sum of the counts of its
    links. A null or empty text, and one whose bytes the ids do not give back, has zeros and an empty
    groups_sha256. Repeated rows count each time; an empty table gives an empty result. The other columns are
    carried as a struct and may have any name.
    """
    stage = Stage(docs)
    own = tokenizers(*(paths or vocabularies()))
    kind, size_b = own.pair_type, own.size_b
    rows = _aligned(_rows(docs, text), paths or vocabularies())
    aligned = stage(rows.withColumn("key", F.monotonically_increasing_id()))
    counts = stage(pair_counts(aligned, kind))
    tops = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("top"))
    scores = stage(counts.join(tops, F.col("pair") % size_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best")))
    # The least power of two such that the pairs counted as often fit into the broadcast table.
    by_size = scores.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count("*").alias("k")).orderBy(F.desc("power")).collect()  # 63 rows at most
    least, total = 64, 0
    for r in by_size:
        total += r["k"]
        if total > most_pairs:
            break
        least = r["power"]
    often = F.floor(F.log2("n")) >= least
    found = stage(_looked_up(aligned, scores.where(often), kind))
    rare = found.select("key", F.explode("rare").alias("p")).select("key", "p.*")
    others = scores.where(~often).select(F.col("pair").alias("q"), "n", "best")
    sums = (
        rare.join(others, F.col("pair") == F.col("q")).groupBy(F.col("key").alias("k"))
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_more"), F.sum(F.col("times") * F.col("n")).alias("sum_more"))
    )
    zero = F.lit(0).cast("long")
    return found.drop("rare").join(sums, F.col("key") == F.col("k"), "left").select(
        "row", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("best_more", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("sum_more", zero)).alias("count_sum"), "groups_sha256",
    )
