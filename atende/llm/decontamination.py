"""Benchmark decontamination by a broadcast hash set of word windows.

Every window of ten words of a benchmark item (the whole item where it has fewer) is a gram. The distinct
grams of the benchmark are a table; their words get codes, each gram a hash of its codes, and this hash
set goes to every task. Documents are scanned once: words to codes, hashes of all windows that hold known
words only, a look into the set, and a comparison of the codes, which are the words themselves. Documents
are never shuffled.

The set that is broadcast is bounded. A benchmark with more text than ``MOST_BYTES`` of grams is dealt by
the hash of gram and item into slabs of about that size, and the documents are scanned once for each; what
a scan found is merged into what the earlier ones found, so the result is the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atende.llm.common import Stage

WINDOW = 10
# Bytes of grams and item ids that one broadcast hash set holds.
MOST_BYTES = 32 << 20
# What a word is, after A-Z became a-z, and the same before.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_CASE = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Texts from this many bytes on are read word by word, so that no list of all their words is made.
_LONG = 1 << 22


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def grams(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, gram): the windows of every item, words joined by a space."""
    n = F.size("w")
    starts = F.sequence(F.lit(1), F.greatest(n - (window - 1), F.lit(1)))
    windows = F.transform(starts, lambda i: F.array_join(F.slice("w", i, window), " "))
    return (
        benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text)).alias("w")).where(n > 0)
        .select("item", F.explode(windows).alias("gram")).distinct()
    )


class _Table:
    """Grams of one length: sorted hashes, codes, and the items of each."""

    def __init__(self, codes: np.ndarray, owners: list[list[int]]):
        self.factor = 0x9E3779B97F4A7C15
        while True:  # a factor under which no two grams have the same hash
            h = self.hashes(codes.ravel(), np.arange(0, codes.size, codes.shape[1]), codes.shape[1])
            order = np.argsort(h, kind="stable")
            if (h[order][1:] != h[order][:-1]).all():
                break
            self.factor += 2
        self.hash, self.codes = h[order], codes[order]
        self.owners = [owners[i] for i in order.tolist()]

    def hashes(self, codes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        factor, h = np.uint64(self.factor & (1 << 64) - 1), np.zeros(len(starts), np.uint64)
        for k in range(length):
            h = h * factor + codes[starts + k].astype(np.uint64) + np.uint64(1)
            h ^= h >> np.uint64(29)
        return h

    def find(self, codes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows that are grams, and which grams they are."""
        length = self.codes.shape[1]
        so_far = np.concatenate([[0], np.cumsum(known)])
        starts = np.flatnonzero(so_far[length:] - so_far[:-length] == length)
        h = self.hashes(codes, starts, length)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        hit = self.hash[at] == h
        starts, at = starts[hit], at[hit]
        same = np.ones(len(starts), bool)
        for k in range(length):
            same &= codes[starts + k] == self.codes[at, k]
        return starts[same], at[same]


class HashSet:
    """Grams of a slab of the benchmark."""

    def __init__(self, pairs: list[tuple[str | None, str]]):
        owners: dict[str, list[int]] = {}
        ids: dict[str, int] = {}
        for item, gram in pairs:
            own = owners.setdefault(gram, [])
            if item is not None:
                own.append(ids.setdefault(item, len(ids)))
        self.items = list(ids)
        self.code: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[list[int], list[int]]]] = {}
        for gram, own in owners.items():
            codes = [self.code.setdefault(w, len(self.code)) for w in gram.encode("utf-8", "surrogatepass").split(b" ")]
            by_length.setdefault(len(codes), []).append((codes, own))
        self.tables = [_Table(np.array([c for c, _ in rows], np.int32), [o for _, o in rows]) for _, rows in sorted(by_length.items())]

    def scan(self, text: str) -> tuple[int, list[int], set[str]]:
        """(number of words, bounds of the maximal runs of hit words, items) of a text."""
        data, get = text.encode("utf-8", "surrogatepass").lower(), self.code.get
        if len(data) < _LONG:
            found = _WORD_BYTES.findall(data)
            codes = np.array([get(w, -1) for w in found], np.int32)
        else:
            codes = np.fromiter((get(m[0], -1) for m in _WORD_BYTES.finditer(data)), np.int32)
        known = codes >= 0
        if not known.any():
            return len(codes), [], set()
        edge, items = np.zeros(len(codes) + 1, np.int64), set()
        for table in self.tables:
            length = table.codes.shape[1]
            if len(codes) < length:
                break
            starts, which = table.find(codes, known)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + length, -1)
            items.update(self.items[i] for g in np.unique(which).tolist() for i in table.owners[g])
        return len(codes), _bounds(np.cumsum(edge[:-1]) > 0), items


def _bounds(hit: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0)).tolist()


def _merged(a: list[int], b: list[int]) -> list[int]:
    """Bounds of the union of two sets of runs."""
    if not a or not b:
        return a or b
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def _spans(text: str, runs: list[int]) -> list[tuple[int, int]]:
    """Characters from the first to the last word of each run."""
    out, at, places = [], 0, _ANY_CASE.finditer(text)
    for s, e in zip(runs[::2], runs[1::2]):
        first = last = None
        while at < e:
            place = next(places)
            first = place if at == s else first
            last, at = place, at + 1
        out.append((first.start(), last.end()))
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    cuts = [0, *(x for span in spans for x in span), len(text)]
    return "".join(text[s:e] for s, e in zip(cuts[::2], cuts[1::2]))


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("kept_text", T.StringType()),
])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """(row, d): every row without its text, and what of the benchmark its text holds.

    d has n_words, n_hit (words inside any occurrence of a window), items (ids of items with an occurring
    window, as strings in their order), spans (characters of the maximal runs of hit words) and kept_text
    (the text without them). A null text has no words and a null kept_text. Items without words have no
    window; an item whose id is null marks words and is named nowhere; repeated items count once. Repeated
    rows give equal results; an empty benchmark hits nothing; an empty table gives an empty result. The
    other columns are carried as a struct and may have any name.
    """
    stage, spark = Stage(docs), docs.sparkSession
    pairs = stage(grams(benchmark, window, item_id, item_text))
    size = F.octet_length("gram") + F.coalesce(F.octet_length("item"), F.lit(0)) + 16
    slabs = -(-(pairs.agg(F.sum(size)).first()[0] or 1) // most_bytes)
    slab = F.pmod(F.xxhash64("gram", "item", F.lit(17)), F.lit(slabs))

    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("int").alias("none")]
    rows = docs.select(F.struct(*rest).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    if slabs > 1:
        rows = rows.select("*", F.array().cast("array<long>").alias("runs"), F.array().cast("array<string>").alias("items"))
    for k in range(slabs):
        own = [tuple(r) for r in pairs.where(slab == k).select("item", "gram").toLocalIterator()]  # about most_bytes
        shared = spark.sparkContext.broadcast(HashSet(own))
        last = k == slabs - 1
        found = T.StructType([T.StructField("d", _RESULT)] if last else list(rows.schema.fields[1:]))
        rows = rows.mapInArrow(_scanner(shared, last), T.StructType([rows.schema["row"], *found.fields]))
        rows = rows if last else stage(rows)
    return rows


def _scanner(shared, last: bool):
    """A pass over documents: adds what the slab hits, and in the last pass cuts it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: HashSet = shared.value
        kinds = T.StructType([T.StructField("d", _RESULT)])
        for batch in batches:
            out = []
            earlier = zip(batch.column("runs").to_pylist(), batch.column("items").to_pylist()) if "runs" in batch.schema.names else iter(lambda: ([], []), None)
            for body, (runs, items) in zip(batch.column("text"), earlier):
                body = body.as_py()
                n, new, more = own.scan(body or "")
                runs, items = _merged(runs, new), sorted(more.union(items))
                if not last:
                    out.append((runs, items))
                    continue
                spans = _spans(body, runs) if runs else []
                n_hit = sum(runs[1::2]) - sum(runs[::2])
                kept = _without(body, spans) if spans else body
                out.append({"n_words": n, "n_hit": n_hit, "items": items, "spans": [{"start": s, "end": e} for s, e in spans], "kept_text": kept})
            if last:
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, _arrow(kinds["d"].dataType))], names=["row", "d"])
            else:
                runs, items = zip(*out) if out else ((), ())
                arrays = [pa.array(runs, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), *arrays], names=["row", "text", "runs", "items"])

    return scan


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text: str = "text", **options) -> DataFrame:
    """The columns of ``docs``: without the hit passages (``spans``), or without the rows that have any (``documents``)."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    found = decontaminate(docs, benchmark, text=text, **options)
    found = found.where("d.n_hit = 0") if remove == "documents" else found
    return found.select(*(F.col("d.kept_text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
