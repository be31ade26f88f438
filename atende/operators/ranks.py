"""Ranks that do not depend on one task holding the whole input or a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atende.operators.keys import running_total
from atende.sources.stage import staged


def order_by(column: str, descending: bool) -> Column:
    """NULLs go last in both directions."""
    c = F.col(column)
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def rank_within(
    df: DataFrame, *, partition: Sequence[str], by: str, name: str, descending: bool = True
) -> DataFrame:
    """``RANK()`` inside groups of any size, NULL groups included.

    Runs over the distinct values of ``by`` per group with their row counts: totals over all groups,
    less the total before the group. No task holds a group. The rank is joined back, null-safe.
    ``df`` is read several times: pass a stored or :func:`staged` table.
    """
    counts = df.groupBy(*partition, by).agg(F.count(F.lit(1)).alias("_n"))
    order = [*[F.col(p).asc() for p in partition], order_by(by, descending)]
    placed = staged(running_total(counts, order, F.col("_n"), "_before"))
    firsts = placed.groupBy(*partition).agg(F.min("_before").alias("_first"))
    firsts = firsts.select(*[F.col(p).alias(f"_g_{p}") for p in partition], "_first")
    groups = placed.join(firsts, [F.col(p).eqNullSafe(F.col(f"_g_{p}")) for p in partition])
    ranks = groups.select(
        *[F.col(p).alias(f"_p_{p}") for p in partition], F.col(by).alias("_v"),
        (F.col("_before") - F.col("_first") + 1).alias(name),
    )
    on = [*[F.col(p).eqNullSafe(F.col(f"_p_{p}")) for p in partition], F.col(by).eqNullSafe(F.col("_v"))]
    return df.join(ranks, on).drop("_v", *[f"_p_{p}" for p in partition])


def rank_over_all(df: DataFrame, *, by: str, name: str, descending: bool = True) -> DataFrame:
    """``RANK()`` over a whole column of any ordered type, without a single-task window.

    ``df`` is read several times: pass a stored or :func:`staged` table.
    """
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(counts, [order_by(by, descending)], F.col("_n"), "_before")
    ranks = placed.select(F.col(by).alias("_v"), (F.col("_before") + 1).alias(name))
    return df.join(ranks, F.col(by).eqNullSafe(F.col("_v"))).drop("_v")


def _ranks_over_all(df: DataFrame, ranks: dict[str, tuple[str, bool]]) -> DataFrame:
    """Several ranks over all rows from one range sort.

    The values of all ranked columns are set under each other with their counts, each in a column of its own type,
    and sorted once by (rank, value in its direction). Every rank counts all rows, so the rows before a
    value, less those of the earlier ranks, give its place.
    """
    types, k = dict(df.dtypes), len(ranks)
    values = [f"_v{j}" for j in range(k)]

    def row(i: int) -> Column:
        own = [(F.col(c) if j == i else F.lit(None).cast(types[c])).alias(values[j]) for j, (c, _) in enumerate(ranks.values())]
        return F.struct(F.lit(i).alias("_r"), *own)

    counts = df.select(F.inline(F.array(*map(row, range(k))))).groupBy("_r", *values).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col("_r").asc(), *[order_by(v, descending) for v, (_, descending) in zip(values, ranks.values())]]
    placed = staged(running_total(counts, order, F.col("_n"), "_before"))
    rows = df.agg(F.count(F.lit(1))).scalar()
    for j, (name, (column, _)) in enumerate(ranks.items()):
        own = placed.filter(F.col("_r") == j).select(F.col(values[j]).alias("_v"), (F.col("_before") - j * rows + 1).alias(name))
        df = df.join(own, F.col(column).eqNullSafe(F.col("_v"))).drop("_v")
    return df


def ranked(
    df: DataFrame, ranks: dict[str, tuple[str, bool]], *, partition: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """Add several ``name -> (column, descending)`` ranks, over all rows or per partition.

    ``stored`` tells that ``df`` reads a stored table, so that it need not be staged.
    """
    df = df if stored else staged(df)
    if not partition:
        return _ranks_over_all(df, ranks)
    for name, (column, descending) in ranks.items():
        df = rank_within(df, partition=partition, by=column, name=name, descending=descending)
    return df


def row_number_over_all(
    df: DataFrame, *, by: str, tie: str, name: str, descending: bool = True
) -> DataFrame:
    """``ROW_NUMBER`` over the whole input; ``tie`` is unique and makes the order repeatable."""
    placed = running_total(df, [order_by(by, descending), F.col(tie)], F.lit(1), "_before")
    return placed.withColumn(name, F.col("_before") + 1).select(*df.columns, name)


def ntile_over_all(
    df: DataFrame, *, by: str, tie: str, name: str, tiles: int = 4, descending: bool = True
) -> DataFrame:
    """``NTILE`` over the whole input; ``tie`` is unique and makes the cut repeatable."""
    columns = df.columns
    placed = row_number_over_all(df, by=by, tie=tie, name="_pos", descending=descending)
    rows = placed.agg(F.count(F.lit(1)).alias("_rows")).scalar()  # of the table that the numbering has staged
    small, longer = F.floor(rows / tiles), rows % tiles
    cut = longer * (small + 1)  # rows in the tiles that hold one row more
    tile = F.when(F.col("_pos") <= cut, F.ceil(F.col("_pos") / (small + 1))).otherwise(
        longer + F.ceil((F.col("_pos") - cut) / F.nullif(small, F.lit(0)))
    )
    return placed.withColumn(name, tile.cast("int")).select(*columns, name)
