"""Facts kept up to date by the rows of their current-state table that a batch changed.

A full build renumbers nothing but rewrites everything. The feed takes the natural keys of a finished batch, reads their
current state, resolves the keys of these rows alone, and replaces them in the stored fact: partitions
where the rows lie or lay before are rewritten, all others keep their files. A log of finished batches makes it
safe to run a batch again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atende.operators.merge import merge_into_partitions, merge_upsert_all
from atende.plans.facts import FACTS, build_fact
from atende.sources.tables import write_table_partitioned


class _Changed:
    """The tables of ``t`` with one of them limited to changed rows."""

    def __init__(self, t, name: str, rows: DataFrame):
        self.t, self.name, self.rows = t, name, rows

    def __getitem__(self, name: str) -> DataFrame:
        return self.rows if name == self.name else self.t[name]


class GoldFeed:
    """One fact under ``path``, partitioned by its date key, and the log of the batches it holds.

    ``t`` gives the dimensions and parent facts; their keys must be stable (see ``KeyRegistry``).
    """

    def __init__(self, spark: SparkSession, path: str, fact: str, t, *, extended: bool = False):
        self.spark, self.path, self.fact, self.t, self.extended = spark, path, fact, t, extended
        self.spec = FACTS[fact]
        spark.createDataFrame([], "nr_lote string").write.mode("append").json(f"{path}/log")  # so that the log exists

    def done(self, batch: str) -> bool:
        log = self.spark.read.schema("nr_lote string").json(f"{self.path}/log")
        return not log.filter(F.col("nr_lote") == batch).isEmpty()

    def read(self) -> DataFrame:
        empty = build_fact(self.fact, self.t, extended=self.extended)
        return self.spark.read.schema(empty.schema).parquet(f"{self.path}/data").select(*empty.columns)

    def refresh(self, current: DataFrame, changed_keys: DataFrame, batch: str) -> bool:
        """Bring the fact up to the ``current`` state of the changed keys (rows of the natural key); False if the batch was done."""
        if self.done(batch):
            return False
        natural, nk, _ = self.spec.key
        keys = changed_keys.select(F.col(natural).alias("_chave")).distinct()
        rows = current.join(keys, F.col(natural) == F.col("_chave"), "left_semi")
        fresh = build_fact(self.fact, _Changed(self.t, self.spec.source, rows), extended=self.extended)
        by, data = [self.spec.date_key], f"{self.path}/data"
        if self._empty():
            write_table_partitioned(fresh, data, by=by)
        else:
            # Keys that are gone (deleted, or no longer valid) leave the fact as well.
            merge_into_partitions(data, fresh, keys=[nk], by=by, merge=merge_upsert_all, replaced=keys.select(F.col("_chave").alias(nk)))
        self.spark.createDataFrame([(batch,)], "nr_lote string").coalesce(1).write.mode("append").json(f"{self.path}/log")
        return True

    def _empty(self) -> bool:
        """Whether no batch is finished; a first batch that failed half-way is written anew."""
        return self.spark.read.schema("nr_lote string").json(f"{self.path}/log").isEmpty()
