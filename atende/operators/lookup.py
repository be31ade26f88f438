"""Key resolution of facts against dimensions, and joins of facts to dimension attributes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_of(date_key: str) -> str:
    """Name of the month column (yyyyMM of the date key) that a stored fact is partitioned by."""
    return f"particao_{date_key}"


@dataclass(frozen=True)
class Lookup:
    """``on`` is computed on the fact and matched with ``natural`` of the dimension.

    ``take`` maps dimension columns to output names; a missing match gives -1 in each.
    """

    dim: str
    on: Column
    natural: str
    take: dict[str, str]
    nullable: tuple[str, ...] = field(default=())


def resolve_keys(fact: DataFrame, dims, lookups: Sequence[Lookup]) -> DataFrame:
    """Left join each dimension once per role and fill missing keys with -1.

    No join is hinted: a stored dimension below the broadcast threshold is broadcast by its
    file size, a larger one is joined by shuffle and skewed keys are split at run time. Keys that are
    unknown by their value (NULL, or the unknown member's number) may be a large share of all rows; they join on a
    second column that spreads them over the tasks and matches nothing, so no task gets them all.
    """
    out = fact
    for i, look in enumerate(lookups):
        key = f"_nk{i}"
        side = dims[look.dim].select(
            F.col(look.natural).alias(key),
            *[F.col(c).alias(f"_d{i}_{alias}") for c, alias in look.take.items()],
        )
        out = out.withColumn(f"_on{i}", look.on)
        out = _left_join(out, side, f"_on{i}", key)
        types = dict(side.dtypes)
        out = out.withColumns(
            {
                alias: F.col(f"_d{i}_{alias}")
                if alias in look.nullable
                else F.coalesce(
                    F.col(f"_d{i}_{alias}"), F.lit(-1).cast(types[f"_d{i}_{alias}"])
                )
                for alias in look.take.values()
            }
        ).drop(key, f"_on{i}", *[f"_d{i}_{a}" for a in look.take.values()])
    return out


# Unknown keys are dealt to so many join values.
SPREAD = 4096


def _left_join(out: DataFrame, side: DataFrame, on: str, key: str) -> DataFrame:
    """Left join whose NULL and -1 keys are spread, unless the dimension has a member of that number (-1 then matches it)."""
    kind = dict(side.dtypes)[key]
    unknown = F.col(on).isNull()
    if kind in ("int", "bigint", "smallint"):
        # The unknown member itself holds -1 and gives -1, as does a missing match.
        unknown = unknown | (F.col(on) == -1)
        side = side.filter(F.col(key) != -1)
    # The first column of a current-state table is its key, which tells the rows apart.
    spread = F.when(unknown, F.pmod(F.xxhash64(*out.columns[:2]), F.lit(SPREAD)).cast("int") + 1).otherwise(F.lit(0))
    # Always zero, but not to the optimizer, which would fold a literal out of the join keys.
    none = F.pmod(F.hash(F.col(key)), F.lit(1))
    match = (F.col(on) == F.col(key)) & (F.col("_share") == F.col("_none"))
    return out.withColumn("_share", spread).join(side.withColumn("_none", none), match, "left").drop("_share", "_none")


def with_dim(
    fact: DataFrame,
    dim: DataFrame,
    *,
    fk: str,
    sk: str,
    take: dict[str, str] | Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Attach attributes of one dimension to a fact through its surrogate key."""
    take = take if isinstance(take, dict) else {c: c for c in take}
    side = dim.select(F.col(sk).alias("_sk"), *[F.col(c).alias(a) for c, a in take.items()])
    on = F.col(fk) == F.col("_sk")
    if (part := partition_of(fk)) in fact.columns:
        # Also by month, so that a filter on the calendar prunes the partitions of the fact.
        side = side.withColumn("_mes", F.floor(F.col("_sk") / 100).cast("int"))
        on = on & (F.col(part) == F.col("_mes"))
    return fact.join(side, on, how).drop("_sk", "_mes", part)
