"""Change events: decode, latest event per key, row hash, tombstones, quarantine split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from atende.functions.casts import event_time

OPERATIONS = {"I": "INSERT", "U": "UPDATE", "D": "DELETE"}
REASON = "_motivo_quarentena"


def cdc_decode_op(df: DataFrame, *, op: str = "Op", time: str = "_timestamp") -> DataFrame:
    """Add ``op_cdc`` (INSERT/UPDATE/DELETE/UNKNOWN) and ``dt_cdc_evento``."""
    name = F.lit("UNKNOWN")
    for code, label in OPERATIONS.items():
        name = F.when(F.col(op) == code, label).otherwise(name)
    return df.withColumns({"op_cdc": name, "dt_cdc_evento": event_time(time)})


def cdc_dedup_latest(df: DataFrame, *, keys: Sequence[str], order: Sequence[str], tasks: int | None = None) -> DataFrame:
    """One row per key: the greatest by ``order`` (first column is the event time, the
    rest break ties).

    ``row_number() = 1`` is planned as a per-task group limit below the shuffle, so a key
    that holds a large share of all events sends one row per input task, not all its rows. That limit
    sorts whole input splits, which spills when they hold millions of rows. ``tasks``, from
    :func:`dedup_tasks`, deals the events by key first, so that only small parts are sorted.
    """
    df = df if tasks is None else df.repartition(tasks, *keys)
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


# Events that one task sorts without spilling, and the parts in which the events of the keys are counted.
TASK_ROWS = 500_000
KEY_PARTS = 4096


def dedup_tasks(df: DataFrame, keys: Sequence[str]) -> int | None:
    """Tasks for :func:`cdc_dedup_latest`; None where a hot key needs the limit below the shuffle.

    Counts the events by parts of the key hash. A key is hot if its part holds more than two tasks' worth of events and over
    four times the mean.
    """
    parts = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(KEY_PARTS)).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    rows, most = parts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    if most > 2 * TASK_ROWS and most * KEY_PARTS > 4 * rows:
        return None
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def row_hash(columns: Sequence[Column | str], sep: str = "|") -> Column:
    """md5 over the text of the columns; NULL counts as ''."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def first_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """Name of the first rule that fails; NULL when none does."""
    reason = F.lit(None).cast("string")
    for failed, label in reversed(list(rules)):
        reason = F.when(failed, label).otherwise(reason)
    return reason


def quarantine_split(
    df: DataFrame, rules: Sequence[tuple[Column, str]]
) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejected). Rejected rows keep the reason in ``_motivo_quarentena``."""
    return split_marked(df.withColumn(REASON, first_reason(rules)))


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of rows that carry their rejection reason."""
    return marked.filter(F.col(REASON).isNull()).drop(REASON), marked.filter(
        F.col(REASON).isNotNull()
    )


def drop_tombstones(df: DataFrame, *, op: str = "op_cdc") -> DataFrame:
    return df.filter(F.col(op) != "DELETE")


def add_audit_columns(df: DataFrame, *, name: str, run_ts: str) -> DataFrame:
    """Constant run time, passed in so that a re-run writes the same bytes."""
    return df.withColumn(name, F.lit(run_ts).cast("timestamp"))


def partition_columns(c: Column | str, names: Sequence[str] = ("ano", "mes", "dia")) -> dict[str, Column]:
    """Year/month/day as plain integers (no zero padding)."""
    c = F.col(c) if isinstance(c, str) else c
    return dict(zip(names, (F.year(c), F.month(c), F.dayofmonth(c))))


def schema_project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly the target's columns, in its order."""
    return df.select(*columns)


def run_metrics(read: DataFrame, marked: DataFrame) -> DataFrame:
    """Rows read / after dedup / valid / quarantined as one row.

    ``marked`` holds the checked rows with their reason, so three of the counts come from one
    aggregation; the rows read are a plain count of the scan.
    """
    checked = marked.agg(
        F.count(F.lit(1)).alias("nr_dedup"),
        F.count(F.when(F.col(REASON).isNull(), 1)).alias("nr_validos"),
        F.count(REASON).alias("nr_quarentena"),
    )
    rows = read.agg(F.count(F.lit(1))).scalar()
    return checked.withColumn("nr_lidos", rows)


def observe_batch(df: DataFrame, name: str, time: str) -> tuple[DataFrame, Observation]:
    """Count rows and the newest event time while the batch is written, without another job."""
    seen = Observation(name)
    newest = F.date_format(F.max(time), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return (
        df.observe(seen, F.count(F.lit(1)).alias("rows"), newest.alias("max_time")),
        seen,
    )
