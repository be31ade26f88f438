"""Sinks and scans."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from atende.sources import tables
from atende.sources.stage import staged, work_dir

def now():
    return F.lit("2024-02-03").cast("timestamp")


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_landing_partitions_are_zero_padded_with_a_fallback(spark):
    df = spark.createDataFrame([("2024-03-05 10:00:00",), ("ontem",), (None,)], "d string")
    out = tables.derive_date_partitions(df, date="d", now=now()).select(*tables.LANDING)
    assert plain(out) == [("2024", "02", "03"), ("2024", "02", "03"), ("2024", "03", "05")]
    missing = tables.derive_date_partitions(df, date="nada", now=now()).select("mes").distinct()
    assert plain(missing) == [("02",)]


def test_dry_run_writes_nothing(spark, tmp_path):
    df = spark.createDataFrame([("2024-03-05",), ("2024-03-05",)], "d string")
    out = tables.write_bronze_partitioned(df, str(tmp_path / "x"), date="d", now=now(), dry_run=True)
    assert plain(out) == [("2024", "03", "05", 2)] and not (tmp_path / "x").exists()
    wet = tables.write_bronze_partitioned(df, str(tmp_path / "x"), date="d", now=now())
    assert plain(wet) == plain(out) and (tmp_path / "x" / "ano=2024" / "mes=03" / "dia=05").exists()


def test_load_status_per_table(spark, tmp_path):
    df = spark.createDataFrame([("2024-03-05",)], "d string")
    bad = df.select(F.raise_error(F.lit("quebrado")).cast("string").alias("d"))
    given = {n: (x, str(tmp_path / n), "d") for n, x in (("a", df), ("b", df.filter("false")), ("c", bad), ("e", df.filter("d = ''")))}
    with pytest.raises(tables.LoadError) as failure:
        tables.load_tables(spark, given)
    got = {r.nm_tabela: r for r in failure.value.report.collect()}
    assert {n: r.ds_status for n, r in got.items()} == {"a": "OK", "b": "SKIP", "c": "ERRO", "e": "SKIP"} and got["c"].ds_erro
    again = tables.load_tables(spark, {"a": (df.union(df), str(tmp_path / "a"), "d")}).first()
    assert (again.nr_linhas, again.nr_arquivos) == (2, 1) and (got["a"].nr_linhas, got["a"].nr_arquivos) == (1, 1)
    dry = tables.load_tables(spark, {"a": (df, str(tmp_path / "x"), "d")}, dry_run=True).first()
    assert (dry.ds_status, dry.nr_linhas, dry.nr_arquivos) == ("OK", 1, 0) and not (tmp_path / "x").exists()


def test_a_hot_partition_is_split_and_small_ones_share_tasks(spark, tmp_path):
    df = spark.range(40000).selectExpr("id", "if(id < 30000, 1, id % 300) as p", "uuid() as u").repartition(3)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        tables.write_table_partitioned(df, str(tmp_path / "t"), by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "p=1").glob("*.parquet"))) > 1
    assert len(list((tmp_path / "t" / "p=7").glob("*.parquet"))) <= 2
    assert plain(spark.read.parquet(str(tmp_path / "t")).select("id", "p")) == plain(df.select("id", "p"))


def test_reprocessing_touches_one_day_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 2, "c")], "id int, dia int, v string")
    tables.write_table_partitioned(df, path, by=["dia"])
    rebuilt = df.withColumn("v", F.upper("v")).filter("id <> 3")
    tables.reprocess_partition(rebuilt, path, by=["dia"], day={"dia": 2})
    assert plain(spark.read.parquet(path).select("id", "dia", "v")) == [(1, 1, "a"), (2, 2, "B")]


def test_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a,b \"c\"", datetime(2024, 1, 2, 3, 4, 5), None), (2, None, None, 2.5)], "id int, t string, d timestamp, x double"
    )
    tables.export_csv_for_load(df, str(tmp_path / "x"), sep=";")
    assert plain(tables.load_exported_csv(spark, str(tmp_path / "x"), df.schema, sep=";")) == plain(df)
    text = "".join(p.read_text() for p in (tmp_path / "x").glob("*.csv"))
    assert "2024-01-02 03:04:05" in text


def test_csv_scan_is_all_text(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,v\n007,\n8, z \n")
    df = tables.scan_csv_strings(spark, str(tmp_path / "x.csv"), ["id", "v"])
    assert {t for _, t in df.dtypes} == {"string"} and plain(df) == [("007", None), ("8", " z ")]


def test_parquet_filter_reaches_the_scan(spark, sf_dir):
    df = tables.scan_parquet(spark, f"{sf_dir}/orders.parquet", F.col("o_orderkey") > 1000).select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,1000)" in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan


class _Session:
    """Stands in for a session with given settings (the real one cannot change them)."""

    def __init__(self, master, folder):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder)})()
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})()


def test_work_folder_follows_the_session_and_is_never_local_on_a_cluster():
    assert work_dir(_Session("yarn", "/shared")) == "/shared/atende-app-yarn"
    with pytest.raises(ValueError):
        work_dir(_Session("yarn", None))
    local = _Session("local[2]", None)
    assert work_dir(local) == work_dir(local)


def test_staged_rows_equal_the_input(spark):
    df = spark.range(10).selectExpr("id", "cast(null as date) d", "id % 2 = 0 as b")
    assert plain(staged(df)) == plain(df) and staged(df).dtypes == df.dtypes


def test_profile_tells_nulls_of_different_columns_apart(spark):
    from atende.operators.quality import profile_table

    rows = [(None, "a"), ("a", None), ("a", None), (None, None), (None, None), (None, None), ("a", "")]
    got = profile_table(spark.createDataFrame(rows, "x string, y string"), "t").first()
    assert (got["nr_linhas"], got["nr_colunas"], got["nr_nulos"], got["nr_duplicadas"]) == (7, 2, 9, 3)
