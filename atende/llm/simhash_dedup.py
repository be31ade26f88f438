"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into 3 segments. Two fingerprints that differ in at most 4 bits differ
in at most one bit in some segment, so there is a position in it whose removal makes the segments
equal. Each fingerprint is indexed under all its one-wildcard segment variants (64 of them), equal
variants meet in an equality grouping, and the distance is then verified on whole fingerprints.

Exact copies collapse into one fingerprint first. Within a variant the links are found as a
spanning forest, so a large group of near copies gives one link a member instead of all pairs;
components are the same. Over-full variants are dealt out in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atende.llm.common import Stage, code_links, components

SEED = 42
# First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned SimHash of the word shingles of a text; 0 for none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined, lens = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    first, last, view = (ends - lens)[: len(words) - size + 1], ends[size - 1:], memoryview(joined)
    ones, hash_of = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), _CHUNK):
        h = np.array([hash_of(view[s:e], SEED) for s, e in zip(first[at: at + _CHUNK].tolist(), last[at: at + _CHUNK].tolist())], np.uint64)
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view(np.uint64)[0])


def fingerprints(rows: DataFrame, text: str = "text", shingle: int = 4) -> DataFrame:
    """The rows with ``code``, the signed fingerprint, in place of the text column."""
    schema = T.StructType([f for f in rows.schema.fields if f.name != text] + [T.StructField("code", T.LongType())])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text)
            code = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts)).view(np.int64)
            kept = [n for n in batch.schema.names if n != text]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(code)], names=[*kept, "code"])

    return rows.mapInArrow(signed, schema)


def variants(codes: DataFrame) -> DataFrame:
    """(key, code): each code under its 64 one-wildcard segment variants."""
    code = F.col("code")
    keys = []
    for s, (first, width) in enumerate(SEGMENTS):
        part = F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1))
        keys += [part.bitwiseAND(F.lit(~(1 << bit))) + F.lit(s << 40 | bit << 32) for bit in range(width)]
    return codes.select(F.explode(F.array(*keys)).alias("key"), "code")


def _labels(codes: DataFrame, stage: Stage, most_bits: int) -> DataFrame:
    """(c, component_id, kept_id, kept_code) of every code, from rows (code, least id)."""
    if most_bits > 4:
        raise ValueError("three segments with one wildcard find at most 4 differing bits")
    links = stage(code_links(variants(codes), codes.count() * 64, most_bits))
    roots = stage(components(links, stage))
    rooted = stage(
        codes.join(roots, F.col("code") == F.col("node"), "left").select("code", "least", F.coalesce("root", "code").alias("root"))
    )
    first = F.min(F.struct(F.col("least").isNull().alias("n"), "least", "code"))
    least = stage(rooted.groupBy("root").agg(first.alias("k")).select(F.col("root").alias("r"), "k.least", "k.code"))
    return stage(
        rooted.select(F.col("code").alias("c"), "root").join(least, F.col("root") == F.col("r"))
        .select("c", F.col("least").alias("component_id"), F.col("code").alias("kept_code"))
    )


def _least_ids(rows: DataFrame) -> DataFrame:
    return rows.groupBy("code").agg(F.min("doc_id").alias("least"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4, most_bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id, kept) of every row.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows and equal ids
    each give a row. component_id is the smallest id reachable; null ids are passed over, and a
    component of null ids only has a null component_id. ``kept`` is true for rows with that id and the
    kept fingerprint. Columns other than the id and the text are not read, so their names cannot
    clash. An empty table gives an empty result.
    """
    stage = Stage(docs)
    rows = stage(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), shingle=shingle))
    labels = _labels(stage(_least_ids(rows)), stage, most_bits)
    return rows.join(labels, F.col("code") == F.col("c")).select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("code") == F.col("kept_code"))).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4, most_bits: int = 4) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each component of near-duplicates.

    The row with the smallest id stays. Rows that agree in id and fingerprint are one document, of
    which one row stays; ids that are null come last. Any further columns are carried along.
    """
    stage = Stage(docs)
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    rows = stage(fingerprints(packed, shingle=shingle))
    labels = _labels(stage(_least_ids(rows)), stage, most_bits)
    kept = stage(labels.where("c = kept_code").select(F.col("component_id").alias("i"), F.col("c")))
    out = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("code") == F.col("c")), "left_semi")
    return out.dropDuplicates(["doc_id", "code"]).select("row.*")
