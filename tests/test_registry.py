"""Every registered query against its DuckDB answer, plus checks on names and plans."""

import datetime
import math
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from atende.operators import lookup
from atende.plans.kpi import kpi04
from atende.plans.layers import GOLD, SILVER_WAVE, Lakehouse, lake_for
from atende.plans.period import Period
from atende.plans.silver import mark_silver
from atende.sources.bindings import SOURCES
from atende.sources.tables import Published

OPTIONAL = set(entry_point.LLM_QUERIES)
QUERIES = {k: v for k, v in entry_point.queries().items() if k not in OPTIONAL}
ANSWERS = {k: v for k, v in entry_point.oracle_sql().items() if k not in OPTIONAL}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in SOURCES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return v.isoformat() if isinstance(v, (datetime.datetime, datetime.date)) else str(v)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    answer = duck.sql(ANSWERS[name])
    assert sorted(df.columns) == sorted(answer.columns)
    at = [answer.columns.index(c) for c in df.columns]
    got = sorted(tuple(map(norm, r)) for r in df.collect())
    expected = sorted(tuple(norm(r[i]) for i in at) for r in answer.fetchall())
    assert got == expected


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ANSWERS)


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_twelve_kpi_families_are_complete():
    families = {re.match(r"g(\d+)_", n).group(1) for n in QUERIES if n.startswith("g")}
    assert families == {str(i) for i in range(1, 13)}


def test_no_python_functions_in_the_package():
    source = "".join(p.read_text() for p in Path(__file__).parent.parent.glob("atende/**/*.py") if p.parent.name != "llm")
    for word in ("udf(", "applyInPandas", "mapInPandas", ".rdd.map", "toPandas", "localCheckpoint"):
        assert word not in source


def test_year_floor_reaches_the_fact_scan(spark, sf_dir):
    plan = QUERIES["g1_2_kpi01_by_channel"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(sk_data_inicio,20240000)" in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_floor_prunes_partitions(spark, sf_dir):
    plan = plan_of(QUERIES["g1_2_kpi01_by_channel"](spark, sf_dir))
    filters = next(x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:] if "particao_sk_data_inicio" in x.split("]")[0])
    assert ">= 202400" in filters


def test_a_calendar_filter_prunes_partitions_at_run_time(spark, sf_dir):
    lake = lake_for(spark, sf_dir)
    some = Period(lake, days=F.col("nr_mes") == 3)
    plan = plan_of(kpi04.kpi04_daily(some))
    assert "dynamicpruning" in plan.replace(" ", "").lower()
    got = {r.dt_abertura for r in kpi04.kpi04_daily(some).collect()}
    assert got == {r.dt_abertura for r in kpi04.kpi04_daily(lake).collect() if r.dt_abertura and r.dt_abertura.month == 3}


def test_stored_layers_are_partitioned_and_keep_rejected_rows(spark, sf_dir, tmp_path):
    lake = Lakehouse(spark, sf_dir, root=str(tmp_path / "lake"), grain="day")
    valid, rejected = lake.silver("chamada")
    assert lake["chamada"].count() == valid.count() and lake.quarantine("chamada").count() == rejected.count() > 0
    folders = {p.name for p in (tmp_path / "lake" / "chamada").glob("*/_lote=completo/_rejeitado=false/ano=*/mes=*/dia=*")}
    assert len(folders) == valid.select("ano", "mes", "dia").distinct().count()
    plan = plan_of(lake["chamada"].filter("ano = 2024 and mes = 1 and dia = 5"))
    filters = next(x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:])
    assert "_rejeitado" in filters and "dia" in filters
    table = lake.marked("chamada")
    before = sorted(map(repr, table.rejected().collect()))
    marked = mark_silver("chamada", lake.bronze("chamada"), as_of=lake.as_of, tie_break="_seq", extended=True)
    table.write(marked, "completo", ingested=F.lit(lake.as_of))  # a retry of the same batch
    assert sorted(map(repr, table.rejected().collect())) == before


def test_a_hot_unknown_key_is_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = spark.range(40_000).selectExpr("id", "case when id % 2 = 0 then if(id % 4 = 0, null, -1) else id % 500 end as k")
        dim = spark.range(-1, 400).selectExpr("id as nk", "id * 10 as sk").withColumn("sk", F.when(F.col("nk") == -1, -1).otherwise(F.col("sk")))
        out = lookup.resolve_keys(fact, {"d": dim}, [lookup.Lookup("d", F.col("k"), "nk", {"sk": "sk"})])
        assert re.search(r"hashpartitioning\(_on0#\d+L?, _share", plan_of(out))
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
        got = {(r.k, r.sk) for r in out.collect()}
        assert got == {(k, k * 10 if k is not None and 0 <= k < 400 else -1) for k in [None, -1, *range(1, 500, 2)]}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_facts_resolve_small_dimensions_without_shuffling_the_fact(spark, sf_dir):
    plan = lake_for(spark, sf_dir).plan("fato_metricas_operacionais")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_layers_can_start_at_gold(spark, sf_dir, tmp_path):
    lake = Lakehouse(spark, sf_dir, root=str(tmp_path / "lake"))
    done = lake.run("gold", only=["fato_jornada_operador"], publish_to=str(tmp_path / "pub"))
    assert "silver" not in done and done["gold"] == ["dim_data", "dim_operador", "fato_jornada_operador"]
    published = Published(spark, str(tmp_path / "pub"))
    assert published.tables() == ["dim_data", "dim_operador", "fato_jornada_operador"]
    opened = published.read("fato_jornada_operador")
    assert opened.count() == lake["fato_jornada_operador"].count() and "particao_sk_data" not in opened.columns
    # A rebuild and a second publication leave what an open reader reads; a half-written one is never seen.
    before, held = sorted(map(repr, opened.collect())), lake["fato_jornada_operador"]
    lake.run("silver", only=["fato_jornada_operador"], publish_to=str(tmp_path / "pub"))
    opened.write.parquet(str(tmp_path / "pub" / "v3" / "fato_jornada_operador"))
    assert published.current() == 2 and sorted(map(repr, opened.collect())) == before and held.count() == len(before)


def test_wave_order_puts_parents_first():
    order = [*SILVER_WAVE, *GOLD]
    lake = Lakehouse.__new__(Lakehouse)
    for name in order:
        assert all(order.index(n) < order.index(name) for n in lake.needs(name))
