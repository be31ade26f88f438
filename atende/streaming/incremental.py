"""Incremental change-event processing: event-time watermarks and file bookmarks.

Two ways to read only what is new: a stored event-time watermark (``WatermarkStore``) or the
checkpoint of a file stream (``run_incremental``). Both end in the same step, which stores the checked
rows of the batch once and merges the valid ones into the current-state table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atende.functions.casts import event_time
from atende.operators.cdc import REASON, observe_batch
from atende.operators.merge import merge_into_partitions, merge_upsert_if_changed
from atende.plans.silver import mark_silver, silver_spec
from atende.sources.tables import write_table_partitioned
from atende.sources.verdicts import BATCH, MarkedTable

EPOCH = "1970-01-01T00:00:00Z"


UNREADABLE = "_timestamp_ilegivel"


def watermark_filter(df: DataFrame, last: str, *, time: str = "_timestamp") -> DataFrame:
    """Rows with an event time after the last watermark, compared as timestamps."""
    return df.filter(event_time(time) > F.lit(last).cast("timestamp"))


def unreadable_events(df: DataFrame, *, time: str = "_timestamp") -> DataFrame:
    """Rows whose event time is missing or no time: no watermark can tell whether they are new."""
    return df.filter(event_time(time).isNull())


class UnreadableEvents:
    """Quarantine of events without a readable time: each raw row once, whatever batch it is met in.

    A row is known by the digest of its columns. A batch adds the rows that no other batch holds, in a folder of
    its own; the same batch again replaces it. So nothing is lost and nothing is stored twice.
    """

    schema = f"ds_digest string, ds_linha string, {REASON} string, dt_ingestao date, {BATCH} string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], "ds_digest string").write.mode("append").parquet(f"{path}/{BATCH}=0")  # so that the folder exists

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def add(self, events: DataFrame, batch: str, *, ingested: Column) -> None:
        line = F.to_json(F.struct(*sorted(events.columns)), {"ignoreNullFields": "false"})
        rows = events.select(line.alias("ds_linha")).withColumn("ds_digest", F.sha2("ds_linha", 256)).dropDuplicates(["ds_digest"])
        known = self.read().filter(F.col(BATCH) != batch).select(F.col("ds_digest").alias("_known"))
        fresh = rows.join(known, F.col("ds_digest") == F.col("_known"), "left_anti")
        fresh.select("ds_digest", "ds_linha", F.lit(UNREADABLE).alias(REASON), ingested.cast("date").alias("dt_ingestao")).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/{BATCH}={batch}")


def watermark_advance(df: DataFrame, last: str, *, time: str = "_timestamp") -> DataFrame:
    """The next watermark: the newest event time read (rejected rows included), never going back."""
    newest = F.max(event_time(time))
    return df.agg(F.coalesce(F.greatest(newest, F.lit(last).cast("timestamp")), newest).alias("last_watermark"))


class WatermarkStore:
    """Append-only log of ``table_name, last_watermark, updated_at, job_name``; the newest counts."""

    log_schema = "table_name string, last_watermark string, updated_at string, job_name string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.put("", EPOCH, "", "")  # so that the log exists

    def get(self, table: str) -> str:
        """Last watermark of a table, the epoch when it never ran."""
        log = self.spark.read.schema(self.log_schema).json(self.path)
        return log.filter(F.col("table_name") == table).agg(F.max("last_watermark")).first()[0] or EPOCH

    def runs(self, table: str) -> int:
        """Finished runs of a table."""
        log = self.spark.read.schema(self.log_schema).json(self.path)
        return log.filter(F.col("table_name") == table).count()

    def put(self, table: str, watermark: str, job: str, now: str) -> None:
        row = zip(("table_name", "last_watermark", "updated_at", "job_name"), (table, watermark, now, job))
        self.spark.range(1).select(*[F.lit(v).alias(n) for n, v in row]).coalesce(1).write.mode("append").json(
            self.path
        )


class _LoggedTable:
    """A stored table with a log that gets a line after each finished write."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._log(0)  # so that the log exists

    def _log(self, version: int) -> None:
        self.spark.range(1).select(F.lit(version).alias("version")).coalesce(1).write.mode("append").json(
            f"{self.path}/log"
        )

    def version(self) -> int:
        return self.spark.read.schema("version int").json(f"{self.path}/log").agg(F.max("version")).first()[0]


class VersionedTable(_LoggedTable):
    """A Parquet table that is replaced as a whole: each version is a new folder.

    For small tables. A merge never overwrites files that it still reads, and a lost job
    leaves the previous version in place.
    """

    def read(self) -> DataFrame | None:
        current = self.version()
        return self.spark.read.parquet(f"{self.path}/data/v{current}") if current else None

    def merge(self, rows: DataFrame, *, keys: Sequence[str], **options: object) -> None:
        current, following = self.read(), self.version() + 1
        if current is not None:
            rows = merge_upsert_if_changed(current, rows, keys=keys, **options)
        rows.write.mode("overwrite").parquet(f"{self.path}/data/v{following}")
        self._log(following)


class PartitionedTable(_LoggedTable):
    """A Parquet table partitioned by date parts; a merge rewrites only the dates it touches."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str]):
        super().__init__(spark, path)
        self.by = list(by)

    def read(self) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/data") if self.version() else None

    def merge(self, rows: DataFrame, *, keys: Sequence[str], **options: object) -> None:
        following = self.version() + 1
        if following == 1:
            write_table_partitioned(rows, f"{self.path}/data", by=self.by)
        else:
            merge_into_partitions(f"{self.path}/data", rows, keys=keys, by=self.by, **options)
        self._log(following)


def merge_batch(
    entity: str,
    batch: DataFrame,
    table: VersionedTable | PartitionedTable,
    *,
    checked: str,
    batch_id: str | int,
    as_of: str,
    tie_break: str | None = None,
    newer_only: bool = False,
    deletes: str = "ignore",
    extended: bool = False,
) -> dict[str, object]:
    """Merge one batch of change events; an empty batch changes neither the table nor the quarantine.

    The batch is read once: its typed and checked rows are written to the folder of the batch in ``checked``, while
    the rows read are counted and the newest event time is found. Merge, quarantine and figures read that folder. The same
    batch again replaces its folder and merges the same rows, so a retry after any failure repeats nothing.
    """
    counted, seen = observe_batch(
        batch.withColumn("_event", event_time("_timestamp")), f"batch_{entity}", "_event"
    )
    marked = mark_silver(entity, counted, as_of=as_of, tie_break=tie_break, extended=extended)
    store = MarkedTable(batch.sparkSession, checked, marked.schema)
    store.write(marked, str(batch_id), ingested=F.lit(as_of))
    # An empty plan observes nothing, so whether there are rows is asked of the folder (its footers tell).
    if not store.metrics(str(batch_id)).first()["nr_dedup"]:
        return {"rows": 0, "max_time": None}
    result = dict(seen.get)
    table.merge(
        store.valid(str(batch_id)), keys=silver_spec(entity, as_of).key,
        newer_only="dt_cdc_evento" if newer_only else None, deletes=deletes,
    )
    return result


def run_with_watermark(
    entity: str, bronze: DataFrame, table: VersionedTable | PartitionedTable, store: WatermarkStore, *,
    checked: str, as_of: str, now: str, tie_break: str | None = None, unreadable: UnreadableEvents | None = None,
) -> dict[str, object]:
    """One incremental run; the watermark is saved last, after the merge succeeded.

    The number of finished runs names the batch, so a run that failed half-way is repeated under its number. Events
    without a readable time go to ``unreadable``, each once.
    """
    name = f"tb_{entity}"
    batch, last = store.runs(name) + 1, store.get(name)
    result = merge_batch(entity, watermark_filter(bronze, last), table, checked=checked, batch_id=batch, as_of=as_of, tie_break=tie_break)
    if unreadable is not None:
        unreadable.add(unreadable_events(bronze), str(batch), ingested=F.lit(as_of))
    store.put(name, result["max_time"] or last, f"silver_{entity}", now)
    return result


def run_incremental(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    checkpoint: str,
    step: Callable[[DataFrame, int], None],
    *,
    files_per_batch: int | None = None,
) -> None:
    """Process the files that arrived since the last finished run, then stop.

    The bookmark is the stream's checkpoint folder. A batch whose step fails is handed out
    again by the next run, so the step must be repeatable (the merge is).
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
