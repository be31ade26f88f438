"""Helpers that the operators share: staged tables, salted buckets, connected components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atende.sources.stage import work_dir

# Most rows of a bucket that one task compares; larger buckets are dealt out in pairs of blocks.
BLOCK_ROWS = 4000
# A key is hot from this share of all rows on, so there are at most so many hot keys.
MOST_HOT_KEYS = 4096
# So many links fit in the memory of one task, some 200 MB.
FEW_LINKS = 1 << 22
# One row in so many is read to find the hot keys. This only balances load, no result depends on it.
HOT_SAMPLE = 16


class Stage:
    """Tables of one operator call in the shared folder; ``drop`` removes those no longer needed."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.root = os.path.join(work_dir(self.spark), "llm", uuid.uuid4().hex)
        self.paths: dict[int, str] = {}

    def __call__(self, df: DataFrame) -> DataFrame:
        path = os.path.join(self.root, uuid.uuid4().hex)
        df.write.parquet(path)
        self.spark.sparkContext._jvm.System.gc()  # lets Spark remove the shuffle files that the table replaces
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._stage = self  # keeps the id unique while the frame lives
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(frame)))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also where lambdas use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64, copy=False))


# --- Buckets ---------------------------------------------------------------------------


def dealt_buckets(rows: DataFrame, key: str, item: str, total: int, block: int = BLOCK_ROWS) -> DataFrame:
    """Rows with a column ``part``: rows of a key meet in the same (key, part).

    A key over ``block`` rows is cut into b blocks by the hash of the item, and each pair of blocks
    gets a part of its own, so every pair of rows still meets and no task holds the whole key.
    The hot keys are at most MOST_HOT_KEYS by construction, which bounds the broadcast.
    """
    least = max(block, total // MOST_HOT_KEYS) / HOT_SAMPLE
    hot = (
        rows.where(F.pmod(F.xxhash64(item, F.lit(7)), F.lit(HOT_SAMPLE)) == 0)
        .groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
        .select(F.col(key).alias("_hot"), F.ceil(F.col("_n") * HOT_SAMPLE / block).cast("long").alias("_blocks"))
    )
    salted = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    blocks, own = F.col("_blocks"), F.pmod(F.xxhash64(item, F.lit(11)), F.col("_blocks"))
    parts = F.transform(
        F.sequence(F.lit(0).cast("long"), blocks - 1),
        lambda j: F.least(own, j) * blocks + F.greatest(own, j),
    )
    return salted.withColumn(
        "part", F.explode(F.when(blocks.isNull(), F.array(F.lit(0).cast("long"))).otherwise(parts))
    ).drop("_hot", "_blocks")


def runs(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames cut at key borders, with the start of each run; the input is sorted by the keys."""
    carry: list[pd.DataFrame] = []

    def starts_of(frame: pd.DataFrame) -> np.ndarray:
        new = np.zeros(len(frame), bool)
        new[:1] = True
        for k in keys:
            v = frame[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    for frame in frames:
        if not len(frame):
            continue
        if carry and all(carry[-1][k].iloc[-1] == frame[k].iloc[-1] for k in keys):
            carry.append(frame)
            continue
        frame = pd.concat([*carry, frame], ignore_index=True)
        starts = starts_of(frame)
        cut = starts[-1]
        if cut:
            yield frame.iloc[:cut], starts[:-1]
        carry = [frame.iloc[cut:].reset_index(drop=True)]
    if carry:
        frame = pd.concat(carry, ignore_index=True)
        yield frame, starts_of(frame)


def spanning_edges(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest over 0..n-1: ``near(i, others)`` gives those of the others linked to i.

    Each item is compared only with items not reached yet, so that a dense group costs about one
    comparison per member and gives one edge per member, never all pairs.
    """
    left = np.arange(n)
    while len(left):
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            found = near(at, left)
            if len(found):
                left = left[~np.isin(left, found, assume_unique=True)]
                frontier += found.tolist()
                yield from ((at, int(x)) for x in found)


SMALL_RUN = 16


def hamming_edges(codes: np.ndarray, starts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of codes: all of a small run, a spanning forest of a larger one."""
    ends = np.append(starts[1:], len(codes))
    size, run = ends - starts, np.repeat(np.arange(len(starts)), ends - starts)
    small = (size <= SMALL_RUN)[run]
    a, b = [], []
    for d in range(1, int(min(SMALL_RUN, size.max(initial=1)))):
        at = np.flatnonzero((run[d:] == run[:-d]) & small[d:])
        at = at[popcount(codes[at] ^ codes[at + d]) <= most]
        a.append(codes[at])
        b.append(codes[at + d])
    for r in np.flatnonzero(size > SMALL_RUN):
        own = np.unique(codes[starts[r]: ends[r]])
        pairs = np.array(list(spanning_edges(len(own), lambda i, o: o[popcount(own[o] ^ own[i]) <= most])), np.int64).reshape(-1, 2)
        a.append(own[pairs[:, 0]])
        b.append(own[pairs[:, 1]])
    a, b = (np.concatenate(x) if x else codes[:0] for x in (a, b))
    return a[a != b], b[a != b]


def code_links(rows: DataFrame, total: int, most: int) -> DataFrame:
    """Distinct links (u, v), u < v, at Hamming distance ``most`` or less, of rows (key, code) that share a key."""

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in runs(frames, ["key", "part"]):
            a, b = hamming_edges(frame["code"].to_numpy(), starts, most)
            yield pd.DataFrame({"u": np.minimum(a, b), "v": np.maximum(a, b)}).drop_duplicates()

    return (
        dealt_buckets(rows, "key", "code", total).repartition("key", "part").sortWithinPartitions("key", "part")
        .mapInPandas(link, "u long, v long").distinct()
    )


# --- Connected components ----------------------------------------------------------------


def least_members(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes of the links u, v and the smallest node that links lead to from each."""
    node, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root, u, v = np.arange(len(node)), at[: len(u)], at[len(u) :]
    while len(u):
        x, y = root[u], root[v]
        apart = x != y
        u, v, x, y = u[apart], v[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != (up := root[root])).any():
            root = up
    return node, node[root]


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node that links lead to.

    Up to FEW_LINKS links are joined by one task. More take alternating large-star and small-star rounds over the links (u, v); each round is a staged table.
    The smallest neighbour of each node is staged on its own, so that its join with the links is a
    plain join whose hot side adaptive execution may split.
    """
    cur = stage(links.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).where("a != b").distinct())
    mark = _mark(cur)
    if mark[0] <= FEW_LINKS:

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ends = [[batch.column(c).to_numpy() for c in ("a", "b")] for batch in batches]
            if ends:
                node, root = least_members(*map(np.concatenate, zip(*ends)))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["node", "root"])

        return cur.coalesce(1).mapInArrow(join, "node long, root long")
    while True:
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")))
        large = stage(
            both.where("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct()
        )
        # A link whose lower end is the node itself falls out above; its other end keeps it below.
        low2 = stage(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n"))
        pulled = large.join(low2, F.col("a") == F.col("n")).select("a", "b", "m")
        new = stage(
            pulled.select("a", F.col("m").alias("b")).union(pulled.select(F.col("b").alias("a"), F.col("m").alias("b")))
            .where("a != b").distinct()
        )
        stage.drop(cur, low, large, low2)
        cur, last, mark = new, mark, _mark(new)
        if mark == last:
            roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)
