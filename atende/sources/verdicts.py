"""Checked rows of change batches, written once: valid rows, quarantine and run figures are views of one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atende.operators.cdc import REASON

BATCH, REJECTED, DEALT = "_lote", "_rejeitado", "_parte"
INGESTED = ("ano_ingestao", "mes_ingestao", "dia_ingestao")


class MarkedTable:
    """Rows with their rejection reason, partitioned by batch, verdict and date parts.

    One write stores a batch. A batch that is written again replaces what its first try left, so a retry
    neither loses nor repeats a rejected row; batches never touch each other's folders. ``schema`` is that
    of the checked rows, the reason included; ``by`` names the date parts among their columns.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ()):
        self.spark, self.path, self.columns, self.by = spark, path, schema.names, list(by)
        extra = [T.StructField(BATCH, T.StringType()), T.StructField(REJECTED, T.BooleanType())]
        days = [T.StructField(n, T.IntegerType()) for n in INGESTED]
        self.schema = T.StructType([*schema.fields, *days, *extra])

    def _dealt(self, marked: DataFrame, ingested: Column, late: Sequence[dict[str, Column]]) -> DataFrame:
        """The rows to store, brought together by verdict and date parts; only what is not ``late`` is shuffled."""
        day = ingested.cast("date")
        parts = dict(zip(INGESTED, (F.year(day), F.month(day), F.dayofmonth(day))))
        rejected = F.col(REASON).isNotNull()
        rows = marked.withColumn(DEALT, F.hash(rejected, *map(F.col, self.by))).drop(*[n for step in late for n in step])
        # Small dates share a task, a large one is cut over several by its size.
        out = rows.hint("rebalance", F.col(DEALT)).drop(DEALT)
        for step in late:
            out = out.withColumns(step)
        return out.withColumns({**parts, REJECTED: rejected}).select(*self.columns, *INGESTED, REJECTED)

    def write(self, marked: DataFrame, batch: str, *, ingested: Column, late: Sequence[dict[str, Column]] = ()) -> None:
        """Store a batch. ``late`` columns, in steps, are computed where the files are written."""
        self._dealt(marked, ingested, late).write.mode("overwrite").option("compression", "zstd").partitionBy(
            REJECTED, *self.by
        ).parquet(f"{self.path}/{BATCH}={batch}")

    def read(self, batch: str | None = None) -> DataFrame:
        df = self.spark.read.schema(self.schema).parquet(self.path)
        return df if batch is None else df.filter(F.col(BATCH) == batch)

    def valid(self, batch: str | None = None) -> DataFrame:
        """Rows that passed, without the reason. The filter is on a partition, so no rejected row is read."""
        return self.read(batch).filter(~F.col(REJECTED)).select(*[c for c in self.columns if c != REASON])

    def rejected(self, batch: str | None = None) -> DataFrame:
        """The quarantine: rejected rows with their reason and day of ingestion."""
        return self.read(batch).filter(REJECTED).select(*self.columns, *INGESTED)

    def metrics(self, batch: str | None = None) -> DataFrame:
        """Rows after dedup, valid and rejected, of one batch or all."""
        bad = F.count(F.when(F.col(REJECTED), 1))
        return self.read(batch).agg(
            F.count(F.lit(1)).alias("nr_dedup"), (F.count(F.lit(1)) - bad).alias("nr_validos"), bad.alias("nr_quarentena")
        )
