"""Best-fit packing of token sequences by exact-complement hashing.

Documents are tokenized, ended with id 0 and cut into pieces of at most ``size`` tokens. How to pack
depends only on how many pieces of each length there are, at most ``size`` numbers however large the
corpus. On these counts, sums of one, two and three lengths are indexed; combinations that fill a
sequence exactly are consumed as often as the counts allow, and what is left goes best-fit, longest
first, into the tightest gap. The plan is a bounded table of slots: for each length, ranges of piece
ranks and where they go. Every piece then gets a rank among those of its length by distributed
counting, and its slot by an equality join on small rank ranges.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atende.llm.common import Stage
from atende.llm.tokens import encoder

SIZE = 2048
END_ID = 0


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# --- The plan, on counts --------------------------------------------------------------------


class _Sums:
    """Which one, two or three lengths in stock add up to a number."""

    def __init__(self, count: dict[int, int]):
        self.count = count
        self.pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        lengths = sorted(count)
        for i, a in enumerate(lengths):
            for b in lengths[i:]:
                self.pairs[a + b].append((a, b))

    def _enough(self, *parts: int) -> bool:
        return all(self.count.get(p, 0) >= parts.count(p) for p in parts)

    def fill(self, gap: int, used: tuple[int, ...]) -> tuple[int, ...] | None:
        """Lengths for the gap next to the used ones, fewest and longest first."""
        if self._enough(*used, gap):
            return (gap,)
        for part in self._pair(gap, used):
            return part
        for a in sorted((x for x, n in self.count.items() if n and x <= gap - 2), reverse=True):
            if a * 3 < gap:
                break
            if self._enough(*used, a):
                for part in self._pair(gap - a, (*used, a)):
                    return (a, *part)
        return None

    def _pair(self, gap: int, used: tuple[int, ...]) -> Iterator[tuple[int, int]]:
        pairs = self.pairs.get(gap, [])
        pairs[:] = [p for p in pairs if self.count[p[0]] and self.count[p[1]]]  # what is used up never returns
        return (p for p in reversed(pairs) if self._enough(*used, *p))


def plan(lengths: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences): uses every piece of the counts once."""
    count = {n: k for n, k in lengths.items() if k}
    out: list[tuple[tuple[int, ...], int]] = []
    if full := count.pop(size, 0):
        out.append(((size,), full))
    sums = _Sums(count)
    # Exact fills, longest piece first; a fill is used as often as all its lengths are there.
    for n in sorted(count, reverse=True):
        while count[n] and (rest := sums.fill(size - n, (n,))):
            parts = (n, *rest)
            times = min(count[p] // parts.count(p) for p in set(parts))
            for p in parts:
                count[p] -= times
            out.append((parts, times))
    # Best fit for the rest: open sequences by gap, those alike together.
    gaps: list[int] = []
    alike: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)

    def open_with(parts: tuple[int, ...], times: int) -> None:
        gap = size - sum(parts)
        if gap and not alike[gap]:
            insort(gaps, gap)
        (alike[gap] if gap else out).append((parts, times))

    for n in sorted(count, reverse=True):
        left = count[n]
        while left:
            at = bisect_left(gaps, n)
            if at < len(gaps):
                gap = gaps[at]
                parts, times = alike[gap].pop()
                if not alike[gap]:
                    gaps.pop(at)
                now = min(times, left)
                if times > now:
                    open_with(parts, times - now)
                open_with((*parts, n), now)
            else:  # nothing open has room: sequences of this length alone, as full as it gets
                per = min(size // n, left)
                now = left // per
                open_with((n,) * per, now)
                now *= per
            left -= now
    for groups in alike.values():
        out += groups
    return out


def slots(plan_: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): where the pieces of each length go, by rank."""
    rank: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for parts, times in plan_:
        offset = 0
        for n in parts:
            out.append((n, rank[n], rank[n] + times, sequence, offset))
            rank[n] += times
            offset += n
        sequence += times
    return out


# --- Pieces and their places ------------------------------------------------------------------


def pieces(docs: DataFrame, size: int, path: str, id_col: str, text: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, row): the pieces of every document, in order.

    Only documents of more than ``size`` ids are cut; their first piece takes what is over.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), END_ID.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, body, row in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                ids = encode(body.as_py() or "") + end
                n = len(ids) // 4
                start, to = 0, n % size or size
                for piece in range(-(-n // size)):
                    rows.append((doc_id.as_py(), piece, start, to - start, zlib.crc32(memoryview(ids)[4 * start: 4 * to]), row))
                    start, to = to, to + size
            cols = list(zip(*rows)) or [[]] * 6
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=list(schema.names))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("piece", T.IntegerType())] + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "row")])
    return rows.mapInArrow(cut, schema)


def best_fit_packing(docs: DataFrame, size: int = SIZE, path: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    ``path`` is a byte-level BPE file of the tokenizers library. A null or empty text is one piece of
    the end id alone. Repeated rows are packed one by one; null ids are kept. Columns other than id and text are not read, so
    their names cannot clash. An empty table gives an empty result.
    """
    stage, spark = Stage(docs), docs.sparkSession
    cut = stage(pieces(docs, size, path or vocabulary(), id_col, text))
    # Ranks by counting: shares of each length by a hash of the row, offsets of the shares, ranks within.
    shares = int(spark.conf.get("spark.sql.shuffle.partitions")) * 4
    shared = cut.withColumn("share", F.pmod(F.xxhash64("row", "piece", F.lit(3)), F.lit(shares)))
    counts = stage(shared.groupBy("length", "share").agg(F.count("*").alias("n")))
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    before = F.sum("n").over(_by("length", "share")) - F.col("n")
    firsts = counts.select(F.col("length").alias("l"), F.col("share").alias("s"), before.alias("first"))
    within = F.row_number().over(_by(["length", "share"], ["row", "piece"])) - 1
    ranked = (
        shared.withColumn("within", within).join(firsts, (F.col("length") == F.col("l")) & (F.col("share") == F.col("s")))
        .withColumn("rank", F.col("first") + F.col("within"))
    )
    # A few slots for each length: a plan has at most some thousand rows, whatever the corpus.
    table = spark.createDataFrame(slots(plan(lengths, size)), "l2 long, low long, high long, sequence long, offset long")
    fits = (F.col("length") == F.col("l2")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    return ranked.join(F.broadcast(table), fits).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset"
    )


def _by(keys, order):
    from pyspark.sql import Window

    return Window.partitionBy(keys).orderBy(order)
