"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation is learned on a bounded sample so that the signs of the rotated, centred unit vectors make
balanced codes of few wrong bits. The code of every vector is cut into segments; vectors meet under
equal one-wildcard variants of a segment (at most one differing bit), pass a bound on the whole code's
distance, and are then compared by the cosine of the original vectors in double precision. Equal
vectors are one node with a weight. Pairs that share no segment variant are missed: the search is
approximate, its links are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.llm.common import Stage, components, dealt_buckets, popcount, runs

LEAST_COSINE = 0.95
# Vectors that the rotation is fitted on: those with the least hashes. Only the fit is sampled; with
# fewer than BITS vectors of a length the rotation is random.
FIT_ROWS = 20_000
FIT_ROUNDS = 50
BITS = 64
SEGMENT = 16
# Most differing bits of codes that are compared as vectors; pairs at the least cosine differ in about 7 of 64.
MOST_BITS = 18


def fit_rotation(x: np.ndarray, bits: int, rounds: int = FIT_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimension x bits) of iterative quantisation of unit vectors."""
    mean = x.mean(0) if len(x) else np.zeros(x.shape[1])
    rng, dim = np.random.default_rng(0), x.shape[1]
    _, axes = np.linalg.eigh((x - mean).T @ (x - mean) + 1e-9 * np.eye(dim))
    axes = axes[:, ::-1]
    # Beyond the dimension, further bits come from random mixes of all axes.
    extra = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    base = np.concatenate([axes, *[axes @ extra] * (-(-bits // dim) - 1)], 1)[:, :bits]
    v = (x - mean) @ base
    r = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(rounds if len(x) else 0):
        u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (u @ w).T
    return mean, base @ r


def _unit(frame: np.ndarray) -> np.ndarray:
    peak = np.abs(frame).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    frame = frame / peak
    return frame / np.linalg.norm(frame, axis=1, keepdims=True)


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def coded(nodes: DataFrame, rotations: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(node, code, dim) of rows (node, v)."""

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, own in frame.groupby(frame["v"].map(len)):
                mean, projection = rotations.get(dim) or fit_rotation(np.zeros((0, dim)), BITS)
                bits = (_unit(_matrix(own["v"])) - mean) @ projection >= 0
                packed = np.packbits(bits, axis=1, bitorder="little").view(np.int64)[:, 0]
                yield pd.DataFrame({"node": own["node"].to_numpy(), "code": packed, "dim": dim})

    return nodes.select("node", "v").mapInPandas(code, "node long, code long, dim int")


def variants(codes: DataFrame) -> DataFrame:
    keys = []
    for s in range(0, BITS, SEGMENT):
        part = F.shiftrightunsigned("code", s).bitwiseAND(F.lit((1 << SEGMENT) - 1))
        for bit in range(SEGMENT):
            keys.append(part.bitwiseAND(F.lit(~(1 << bit))) + F.lit((s + bit) << SEGMENT) + F.shiftleft(F.col("dim").cast("long"), 24))
    return codes.select(F.explode(F.array(*keys)).alias("key"), "node", "code")


def candidates(codes: DataFrame, total: int) -> DataFrame:
    """(u, v), u < v: nodes that share a segment variant and whose codes are close."""

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in runs(frames, ["key", "part"]):
            node, code = frame["node"].to_numpy(), frame["code"].to_numpy()
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(frame))))
            size = int(np.diff(np.append(starts, len(frame))).max())
            for d in range(1, size):  # each row with the d-th after it in its run
                at = np.flatnonzero(run[d:] == run[:-d])
                at = at[popcount(code[at] ^ code[at + d]) <= MOST_BITS]
                if len(at):
                    yield pd.DataFrame({"u": np.minimum(node[at], node[at + d]), "v": np.maximum(node[at], node[at + d])})

    return (
        dealt_buckets(variants(codes), "key", "node", total).repartition("key", "part").sortWithinPartitions("key", "part")
        .mapInPandas(pairs, "u long, v long").where("u != v").distinct()
    )


def _close(frames: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for _, own in frame.groupby(frame["x"].map(len)):  # both of a pair have the same length
            cosine = np.einsum("ij,ij->i", _unit(_matrix(own["x"])), _unit(_matrix(own["y"])))
            yield own.loc[cosine >= least, ["u", "v"]]


def embedding_dedup(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
    different lengths never link. Repeated rows are rows of their own, so equal vectors link with each
    other. component_id is the smallest id that links lead to (ids that are null are passed over); kept
    is vec_id = component_id. Other columns are not read; an empty table gives an empty result.
    """
    stage = Stage(table)
    v = F.col(vector).cast("array<double>")
    rows = table.select(F.col(id_col).alias("vec_id"), v.alias("v"))
    sound = (
        F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0)
    )
    rows = stage(rows.withColumn("v", F.when(sound, F.transform("v", lambda x: x + F.lit(0.0)))).withColumn("digest", F.xxhash64("v")))
    nodes = stage(
        rows.where("v is not null").groupBy("v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.first("digest").alias("digest"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    sample = nodes.orderBy(F.xxhash64("digest", F.lit(5)), "node").select("v").limit(FIT_ROWS).toPandas()["v"]
    rotations = {dim: fit_rotation(_unit(_matrix(own)), BITS) for dim, own in sample.groupby(sample.map(len)) if len(own) >= BITS} if len(sample) else {}
    codes = stage(coded(nodes, rotations))
    found = stage(candidates(codes, codes.count() * BITS))
    x, y = nodes.select(F.col("node").alias("nx"), F.col("v").alias("x")), nodes.select(F.col("node").alias("ny"), F.col("v").alias("y"))
    paired = found.join(x, F.col("u") == F.col("nx")).join(y, F.col("v") == F.col("ny")).select("u", "v", "x", "y")
    links = stage(paired.mapInPandas(lambda frames: _close(frames, least), "u long, v long"))
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    weights = nodes.select(F.col("node").alias("n"), "weight")
    near = stage(both.join(weights, F.col("v") == F.col("n")).groupBy("u").agg(F.sum("weight").alias("others")))
    roots = stage(components(links, stage).withColumnRenamed("node", "g"))
    rooted = stage(
        nodes.join(near, F.col("node") == F.col("u"), "left").join(roots, F.col("node") == F.col("g"), "left")
        .select("v", "weight", "least", "digest", "others", F.coalesce("root", "node").alias("root"))
    )
    firsts = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "r"))
    known = stage(
        rooted.join(firsts, F.col("root") == F.col("r"))
        .select(F.col("v").alias("w"), F.col("digest").alias("dg"), (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    )
    joined = rows.join(known, (F.col("digest") == F.col("dg")) & (F.col("v") == F.col("w")), "left")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
