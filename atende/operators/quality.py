"""Checks over finished tables: orphans, row counts, completeness, band distribution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import half_up


def orphan_check(fact: DataFrame, dim: DataFrame, *, fk: str, sk: str) -> DataFrame:
    """Number of fact rows whose key is missing in the dimension (one row)."""
    lost = fact.join(dim.select(F.col(sk).alias("_sk")), F.col(fk) == F.col("_sk"), "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("nr_orfaos"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("nr_linhas")).select(F.lit(n).alias("nm_tabela"), "nr_linhas")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def score_distribution(df: DataFrame, *, band: str, score: str) -> DataFrame:
    return df.groupBy(band).agg(
        F.count(F.lit(1)).alias("nr_avaliacoes"), half_up(F.avg(score)).alias("nr_nota_media")
    )


def null_pct_by_column(df: DataFrame) -> DataFrame:
    """Share of NULLs and completeness per column, from one pass over the table."""
    n = F.count(F.lit(1))
    one = df.agg(
        *[
            F.round(F.lit(100.0) * (n - F.count(F.col(c))) / F.nullif(n, F.lit(0)), 2).alias(c)
            for c in df.columns
        ]
    )
    return one.unpivot([], list(df.columns), "nm_coluna", "pct_nulos").withColumn(
        "pct_completude", F.round(F.lit(100.0) - F.col("pct_nulos"), 2)
    )


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, NULL cells and repeated rows of one table.

    Repeated rows are counted from the 128-bit digests of the rows and how often each occurs, so
    that the shuffle carries digests and counts, never whole rows.
    """
    missing = [F.col(c).isNull() for c in df.columns]
    nulls = reduce(lambda a, b: a + b, [m.cast("bigint") for m in missing])
    # The hash passes over NULLs, so where they stand goes into the digest on its own.
    digest = [F.xxhash64(F.lit(seed), *df.columns, *missing).alias(f"_h{seed}") for seed in (1, 2)]
    return (
        df.select(*digest, nulls.alias("_z"))
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_z").alias("_z"))
        .agg(
            F.sum("_n").alias("nr_linhas"),
            F.sum("_z").alias("nr_nulos"),
            F.sum(F.col("_n") - 1).alias("nr_duplicadas"),
        )
        .select(
            F.lit(name).alias("nm_tabela"),
            "nr_linhas",
            F.lit(len(df.columns)).alias("nr_colunas"),
            "nr_nulos",
            "nr_duplicadas",
        )
    )
