"""Scans and sinks: CSV and Parquet in, partitioned tables, quarantine, snapshots and exports out."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atende.functions.rules import half_up

LANDING = ("ano", "mes", "dia")


def scan_csv_strings(spark: SparkSession, path: str, columns: Sequence[str], *, sep: str = ",") -> DataFrame:
    """CSV with a header, every column a string; the schema is given, so nothing is inferred."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).options(sep=sep, header=True, enforceSchema=False, escape='"').csv(path)


def scan_parquet(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """Parquet scan; the filter is pushed to the files."""
    df = spark.read.parquet(path)
    return df if since is None else df.filter(since)


def scan_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def derive_date_partitions(
    df: DataFrame, *, date: str | None, now: Column | None = None, fmt: str | None = None
) -> DataFrame:
    """Zero-padded text ``ano/mes/dia`` of a date column; bad or missing dates get today's."""
    now = F.current_timestamp() if now is None else now
    if date is None or date not in df.columns:
        day = now
    else:
        parsed = F.try_to_timestamp(F.col(date)) if fmt is None else F.try_to_timestamp(F.col(date), F.lit(fmt))
        day = F.coalesce(parsed, now)
    return df.withColumns(
        {name: F.date_format(day, p) for name, p in zip(LANDING, ("yyyy", "MM", "dd"))}
    )


def _by_partition(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition value together before a partitioned write.

    Without it every task would write a file per date. The rebalance is adaptive: small
    partitions share a task and a hot date is split over several tasks by its size.
    """
    return df.hint("rebalance", *[F.col(c) for c in by])


def partition_counts(df: DataFrame, by: Sequence[str] = LANDING) -> DataFrame:
    """Rows per landing partition (the dry run of a write)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("nr_linhas"))


def write_bronze_partitioned(
    df: DataFrame, path: str, *, date: str | None, now: Column | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Land a table as Snappy Parquet by ``ano/mes/dia``.

    Returns the rows per partition that the landing folder holds after the write; a dry run
    writes nothing and counts the batch.
    """
    landed = derive_date_partitions(df, date=date, now=now)
    if not dry_run:
        _by_partition(landed, LANDING).write.mode("append").partitionBy(*LANDING).option(
            "compression", "snappy"
        ).parquet(path)
        # With the schema given, the partition values stay zero-padded text.
        landed = df.sparkSession.read.schema(landed.schema).parquet(path)
    return partition_counts(landed)


LOADS_AT_ONCE = 4
LOAD_SCHEMA = "nm_tabela string, ds_status string, nr_linhas bigint, nr_arquivos bigint, ds_erro string"


class LoadError(Exception):
    """Tables of a load that failed; ``report`` holds the outcome of all of them."""

    def __init__(self, report: DataFrame, failed: Sequence[str]):
        super().__init__(f"not loaded: {', '.join(failed)}")
        self.report = report


def _files(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Data files of a landing folder, 0 where there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return 0
    return spark.read.schema(schema).parquet(path).select("_metadata.file_path").distinct().count()


def _load_one(name: str, df: DataFrame, path: str, date: str | None, now: Column | None, dry_run: bool) -> tuple:
    """(table, status, rows, new files, error): one pass over the rows, which are counted while they are written."""
    try:
        landed = derive_date_partitions(df, date=date, now=now)
        if dry_run:
            rows = landed.count()
            return name, "OK" if rows else "SKIP", rows, 0, None
        before = _files(df.sparkSession, path, landed.schema)
        seen = Observation(f"carga_{name}")
        _by_partition(landed.observe(seen, F.count(F.lit(1)).alias("n")), LANDING).write.mode("append").partitionBy(*LANDING).option(
            "compression", "snappy"
        ).parquet(path)
        new = _files(df.sparkSession, path, landed.schema) - before
        # A plan without rows observes nothing and writes no file.
        return (name, "OK", seen.get["n"], new, None) if new else (name, "SKIP", 0, 0, None)
    except (PySparkException, Py4JError, OSError) as error:
        return name, "ERRO", None, None, f"{error}".splitlines()[0]


def load_tables(
    spark: SparkSession, tables: dict[str, tuple[DataFrame, str, str | None]], *, now: Column | None = None, dry_run: bool = False,
    at_once: int = LOADS_AT_ONCE,
) -> DataFrame:
    """Land several ``name -> (rows, path, date column)`` side by side; one failing table does not stop the rest.

    Gives a row for each table: OK, or SKIP where it has no rows, its rows and its new files. Where any failed, a
    ``LoadError`` with all rows is raised after every table was tried.
    """
    run = inheritable_thread_target(spark)(lambda item: _load_one(item[0], *item[1], now, dry_run))
    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(run, tables.items()))
    report = spark.createDataFrame(rows, LOAD_SCHEMA)
    if failed := [r[0] for r in rows if r[1] == "ERRO"]:
        raise LoadError(report, failed)
    return report


def write_table_partitioned(
    df: DataFrame, path: str, *, by: Sequence[str], mode: str = "overwrite"
) -> None:
    """Partitioned table; only the partitions that occur in ``df`` are replaced."""
    _by_partition(df, by).write.mode(mode).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*by).parquet(path)


def reprocess_partition(
    rebuilt: DataFrame, path: str, *, by: Sequence[str], day: dict[str, object]
) -> None:
    """Replace one date's partition by the rebuilt rows of that date; the others stay as they are."""
    only = rebuilt
    for name, value in day.items():
        only = only.filter(F.col(name) == F.lit(value))
    write_table_partitioned(only, path, by=by)


class Published:
    """A set of published tables that readers always see as one consistent whole.

    Each publication is a new folder with all its tables; the last step appends one line to the log, and the
    greatest finished number is the current one. A reader that opened an earlier publication keeps its files,
    and a publication that fails half-way is never seen.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _log(self) -> DataFrame:
        return self.spark.read.schema("nr_publicacao int, nm_tabela string").json(f"{self.path}/log")

    def current(self) -> int:
        """Number of the current publication, 0 before the first."""
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        if not root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
            return 0
        return self._log().agg(F.max("nr_publicacao")).first()[0] or 0

    def publish(self, tables: dict[str, DataFrame]) -> int:
        number = self.current() + 1
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.path}/v{number}/{name}")
        names = self.spark.createDataFrame([(number, name) for name in tables], "nr_publicacao int, nm_tabela string")
        names.coalesce(1).write.mode("append").json(f"{self.path}/log")
        return number

    def tables(self) -> list[str]:
        """Tables of the current publication."""
        current = self.current()
        return sorted(r["nm_tabela"] for r in self._log().filter(F.col("nr_publicacao") == current).collect())  # one row a table

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v{self.current()}/{name}")


def publish_snapshot(df: DataFrame, path: str) -> None:
    """Full refresh of a published table; running it again gives the same table."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, *, sep: str = ",", empty: str = '""') -> None:
    """CSV with a header; NULL is an empty field and text keeps its outer blanks."""
    df.write.mode("overwrite").options(
        sep=sep, header=True, nullValue="", emptyValue=empty,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"',
    ).csv(path)


def export_csv_for_load(df: DataFrame, path: str, *, sep: str = ",") -> None:
    """Delimited export: timestamps as ``yyyy-MM-dd HH:mm:ss``, NULL as an empty field."""
    stamps = {
        f.name: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    write_csv(df.withColumns(stamps), path, sep=sep, empty="")


def load_exported_csv(spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ",") -> DataFrame:
    """Load an export: blank and empty fields become NULL, text is cast to the schema."""
    raw = scan_csv_strings(spark, path, schema.names, sep=sep)
    return raw.select(
        *[
            F.nullif(F.trim(F.col(f.name)), F.lit("")).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def monthly_report(
    df: DataFrame, *, time: str, seconds: str, resolved: Column, last_days: int | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Rows, mean duration and resolved rows per month; optionally only the last days."""
    if last_days is not None:
        as_of = F.current_date() if as_of is None else as_of
        df = df.filter(F.col(time) >= F.date_sub(as_of, last_days))
    month = F.date_trunc("month", time).alias("mes")
    return df.groupBy(month).agg(
        F.count(F.lit(1)).alias("total_chamadas"),
        half_up(F.avg(seconds)).alias("duracao_media"),
        F.count(F.when(resolved, 1)).alias("resolvidas"),
    )
