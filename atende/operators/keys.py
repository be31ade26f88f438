"""Dense surrogate keys and the unknown member of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atende.sources.stage import staged

UNKNOWN_KEY = -1


def running_total(df: DataFrame, order: Sequence[Column], weight: Column, name: str) -> DataFrame:
    """Add the total ``weight`` of all rows before each row in ``order``.

    Rows are range-partitioned by the whole order, so a value that many rows share is cut where later
    order columns differ, and text counts in full length. The totals are one row per range, which
    bounds the broadcast; each range then sums up its own rows.
    """
    columns = df.columns
    # A written table fixes which row lies in which range.
    ranged = staged(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range").agg(F.sum(weight).alias("_n"))
    earlier = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col("_range").alias("_at"), "_n").select("_at", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("_inside", F.coalesce(F.sum(weight).over(within), F.lit(0)))
    total = (F.col("_before") + F.col("_inside")).cast("bigint").alias(name)
    return inside.join(F.broadcast(before), F.col("_range") == F.col("_at")).select(*columns, total)


def surrogate_key_seq(
    df: DataFrame,
    *,
    order: Sequence[str],
    name: str,
    existing: DataFrame | None = None,
    kind: str = "int",
) -> DataFrame:
    """Dense 1..n key by the natural key ``order``; NULLs come first. ``kind`` is bigint for over 2**31 members.

    With ``existing`` (natural key + key of the stored dimension) known members keep their key
    and new ones continue after the greatest.
    """
    if existing is not None:
        kept = existing.select(*[F.col(c).alias(f"_k_{c}") for c in order], name)
        same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in order]
        top = kept.agg(F.coalesce(F.max(F.greatest(F.col(name), F.lit(0))), F.lit(0)).alias("_top")).scalar()
        known = df.join(kept, same, "inner")
        fresh = surrogate_key_seq(df.join(kept, same, "left_anti"), order=order, name=name, kind="bigint")
        fresh = fresh.withColumn(name, (F.col(name) + top).cast(kind))
        return known.select(*df.columns, name).unionByName(fresh.select(*df.columns, name))
    placed = running_total(df, [F.col(c).asc() for c in order], F.lit(1), "_key")
    return placed.withColumn(name, (F.col("_key") + 1).cast(kind)).select(*df.columns, name)


class KeyRegistry:
    """Append-only table of natural keys and the surrogate keys they got, with a high-water mark.

    Known members keep their key for ever; new ones continue after the mark, in the order of their natural key. An
    assignment writes only the new members, in a folder of its own, and is finished by one line of the log, which
    holds the mark; readers pass over folders the log does not name, so an assignment that failed half-way is
    repeated without a gap or a double key. One writer at a time. ``natural`` is the DDL of the natural key.
    """

    log_schema = "nr_versao int, nr_topo bigint"

    def __init__(self, spark: SparkSession, path: str, natural: str):
        self.spark, self.path = spark, path
        self.natural = T.StructType.fromDDL(natural)
        spark.createDataFrame([(0, 0)], self.log_schema).coalesce(1).write.mode("append").json(f"{path}/log")  # so that the log exists
        spark.createDataFrame([], T.StructType([*self.natural.fields, T.StructField("nr_chave", T.LongType())])).write.mode("append").parquet(
            f"{path}/membros/nr_versao=0"
        )

    def state(self) -> tuple[int, int]:
        """Finished assignments and the greatest key."""
        return tuple(self.spark.read.schema(self.log_schema).json(f"{self.path}/log").agg(F.max("nr_versao"), F.max("nr_topo")).first())

    def read(self) -> DataFrame:
        """Natural key and ``nr_chave`` of every member."""
        schema = T.StructType([*self.natural.fields, T.StructField("nr_chave", T.LongType()), T.StructField("nr_versao", T.IntegerType())])
        members = self.spark.read.schema(schema).parquet(f"{self.path}/membros")
        return members.filter(F.col("nr_versao") <= self.state()[0]).drop("nr_versao")

    def assign(self, df: DataFrame, name: str) -> DataFrame:
        """The rows of ``df`` with their key as ``name``; members not seen before are added."""
        names = self.natural.names
        version, top = self.state()
        fresh = df.select(*names).distinct().join(self._known(), self._same(), "left_anti")
        keyed = surrogate_key_seq(fresh, order=names, name="nr_chave", kind="bigint")
        folder = f"{self.path}/membros/nr_versao={version + 1}"
        keyed.select(*names, (F.col("nr_chave") + top).alias("nr_chave")).write.mode("overwrite").parquet(folder)
        added = self.spark.read.parquet(folder).agg(F.max("nr_chave")).first()[0]
        if added is not None:
            self.spark.createDataFrame([(version + 1, added)], self.log_schema).coalesce(1).write.mode("append").json(f"{self.path}/log")
        return df.join(self._known(), self._same(), "inner").select(*df.columns, F.col("_key").alias(name))

    def _known(self) -> DataFrame:
        return self.read().select(*[F.col(c).alias(f"_k_{c}") for c in self.natural.names], F.col("nr_chave").alias("_key"))

    def _same(self) -> list[Column]:
        return [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in self.natural.names]


def keyed(df: DataFrame, t, dim: str, *, order: Sequence[str], name: str) -> DataFrame:
    """Keys of a dimension: from the registry of the tables ``t`` where they have one, else dense."""
    registry = getattr(t, "registry", None)
    if registry is None or not t.stable_keys:
        return surrogate_key_seq(df, order=order, name=name)
    natural = ", ".join(f"{c} {kind}" for c, kind in df.select(*order).dtypes)
    return registry(dim, natural).assign(df, name)


def unknown_member(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Append one typed row; columns that ``values`` leaves out are NULL."""
    row = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.unionByName(df.sparkSession.range(1).select(*row))


def distinct_value_dim(
    df: DataFrame,
    *,
    column: str,
    label: str,
    key: str,
    flags: dict[str, Column] | None = None,
    unknown: dict[str, object] | None = None,
    unknown_label: str = "DESCONHECIDO",
    tables=None,
    dim: str = "",
) -> DataFrame:
    """Dimension ``dim`` of the distinct values of one column; keys come from the registry of ``tables``, if any.

    Values are normalised before the distinct, and the label of the unknown member is left
    to that member alone, so that no label occurs twice.
    """
    labels = (
        df.select(F.upper(F.trim(F.col(column))).alias(label))
        .filter(F.col(label).isNotNull() & (F.col(label) != unknown_label))
        .distinct()
    )
    members = keyed(labels, tables, dim, order=[label], name=key)
    rows = members.withColumns(flags or {}).select(key, label, *(flags or {}))
    return unknown_member(rows, {key: UNKNOWN_KEY, label: unknown_label, **(unknown or {})})


def fact_key(natural_key: str) -> Column:
    """Unique BIGINT of a fact row: its natural key, hence equal in every run."""
    return F.col(natural_key).cast("bigint")
