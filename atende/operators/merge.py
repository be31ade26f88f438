"""Upserts on plain Parquet tables, written as joins (no row-level-operation catalog needed)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atende.sources.stage import staged
from atende.sources.tables import write_table_partitioned


def _merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], take_source: Column
) -> DataFrame:
    """Full outer join on the keys; each output row is the source or the target row whole."""
    columns = target.columns
    old = target.select(F.struct(*columns).alias("_old"), *[F.col(k).alias(f"_o_{k}") for k in keys])
    new = source.select(F.struct(*columns).alias("_new"), *[F.col(k).alias(f"_n_{k}") for k in keys])
    on = [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in keys]
    row = F.when(F.col("_old").isNull() | (F.col("_new").isNotNull() & take_source), F.col("_new"))
    return old.join(new, on, "full_outer").select(row.otherwise(F.col("_old")).alias("_r")).select("_r.*")


def merge_upsert_if_changed(
    target: DataFrame,
    source: DataFrame,
    *,
    keys: Sequence[str],
    hash_col: str = "hash_registro",
    newer_only: str | None = None,
    deletes: str = "ignore",
    op_col: str = "op_cdc",
) -> DataFrame:
    """Matched and hash differs -> source row; not matched -> insert; equal hash -> keep target.

    ``newer_only`` names an event-time column: a late, older event no longer overwrites.
    ``deletes='apply'`` also lets a change of the operation through, so that a DELETE with
    unchanged data reaches the table as a tombstone (the default keeps it out).
    """
    changed = ~F.col(f"_new.{hash_col}").eqNullSafe(F.col(f"_old.{hash_col}"))
    if deletes == "apply":
        changed = changed | ~F.col(f"_new.{op_col}").eqNullSafe(F.col(f"_old.{op_col}"))
    if newer_only:
        changed = changed & F.coalesce(
            F.col(f"_new.{newer_only}") >= F.col(f"_old.{newer_only}"), F.lit(True)
        )
    return _merge(target, source, keys, changed)


def merge_upsert_all(target: DataFrame, source: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Type-1 upsert: every matched row is replaced, the others are inserted."""
    return _merge(target, source, keys, F.lit(True))


def merge_into_partitions(
    path: str,
    source: DataFrame,
    *,
    keys: Sequence[str],
    by: Sequence[str],
    merge: Callable[..., DataFrame] = merge_upsert_if_changed,
    replaced: DataFrame | None = None,
    **options: object,
) -> None:
    """Merge a batch into a partitioned Parquet table, rewriting only the partitions it touches.

    Touched are the partitions of the batch's rows and those where its keys lie now, so a
    row whose date changed leaves its old partition. To find the latter only the key columns
    of the table are read. The merged rows are staged before anything is replaced, and the
    same batch can be merged again after a failure. ``replaced`` are keys whose rows leave the table first,
    also where the batch has no row for them.
    """
    spark = source.sparkSession
    source = staged(source)
    target = spark.read.schema(source.schema).parquet(path)
    renamed = [F.col(k).alias(f"_m_{k}") for k in keys]
    same = [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys]
    new_keys = source.select(*renamed)
    if replaced is not None:
        gone_keys = staged(replaced.select(*renamed).distinct())
        new_keys = new_keys.unionByName(gone_keys)
    moved = target.join(new_keys, same, "left_semi").select(*by)
    touched = staged(moved.unionByName(source.select(*by)).distinct())
    affected = _of_partitions(target, touched, by).select(*source.columns)
    if replaced is not None:
        affected = affected.join(gone_keys, same, "left_anti")
    merged = staged(merge(affected, source, keys=keys, **options))
    # Partitions that lose all their rows are removed; the others are replaced in one write.
    emptied = _of_partitions(touched, merged.select(*by).distinct(), by, "left_anti")
    gone = [_folder(spark, path, [(c, row[c]) for c in by]) for row in emptied.collect()]  # one row per emptied partition
    write_table_partitioned(merged, path, by=by)
    for folder in gone:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _packed(df: DataFrame, by: Sequence[str]) -> Column | None:
    """One number of all date parts, in their order (year * 10000 + month * 100 + day); None unless all are numbers."""
    kinds = dict(df.dtypes)
    if not all(kinds[c] in ("int", "bigint", "smallint", "tinyint") for c in by):
        return None
    out = F.lit(0).cast("bigint")
    for c in by:
        out = out * 100 + F.col(c).cast("bigint")
    return out


def _of_partitions(df: DataFrame, wanted: DataFrame, by: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of the wanted partitions, NULL partitions included.

    The whole date, packed into one number, is bounded by the least and greatest wanted one, which are one-row
    values that the scan prunes by; a NULL partition is read only if one is wanted. Parts that are no
    numbers bound their first one.
    """
    other = wanted.select(*[F.col(c).alias(f"_w_{c}") for c in by])
    same = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in by]
    if how == "left_semi":
        place, of_wanted = _packed(df, by), _packed(wanted, by)
        if place is None or of_wanted is None:
            place = of_wanted = F.col(by[0])
        low, high = (wanted.agg(f(of_wanted).alias("_b")).scalar() for f in (F.min, F.max))
        open_ = wanted.agg(F.count(F.when(of_wanted.isNull(), 1)).alias("_b")).scalar()
        df = df.filter((place.isNull() & (open_ > 0)) | ((place >= low) & (place <= high)))
    return df.join(other, same, how)


def _folder(spark: SparkSession, path: str, values: list[tuple[str, object]]) -> str:
    """Folder of a partition as Spark names it."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([path, *(names.getPartitionPathString(c, None if v is None else str(v)) for c, v in values)])
