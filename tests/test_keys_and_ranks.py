"""Distributed numbering and ranking against brute force, with skewed and repeated values."""

import datetime
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from atende.operators.keys import KeyRegistry, distinct_value_dim, surrogate_key_seq, unknown_member
from atende.operators.lookup import Lookup, resolve_keys
from atende.plans.facts import build_fact
from atende.plans.layers import Lakehouse
from atende.sources.bindings import SOURCES
from atende.streaming.gold_feed import GoldFeed
from atende.operators.ranks import ntile_over_all, rank_over_all, rank_within, ranked, row_number_over_all


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(7)
    # a third of the rows share one value, some are NULL
    rows = [(i, "g1" if rng.random() < 0.4 else f"g{rng.randrange(5)}", None if rng.random() < 0.05 else
             5.0 if rng.random() < 0.35 else round(rng.random() * 20, 1)) for i in range(900)]
    return spark.createDataFrame(rows, "id int, g string, v double").repartition(6)


def plain(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_surrogate_keys_are_dense_and_ordered(spark):
    ids = [i * i * 1000 % 99991 for i in range(1, 700)] + [10**15, 10**15 + 1]
    df = spark.createDataFrame([(i,) for i in sorted(set(ids))], "nk bigint").repartition(7)
    got = {r.nk: r.sk for r in surrogate_key_seq(df, order=["nk"], name="sk").collect()}
    assert got == {nk: i for i, nk in enumerate(sorted(set(ids)), 1)}


def test_known_members_keep_their_keys(spark):
    existing = spark.createDataFrame([(10, 1), (30, 2), (-1, -1)], "nk bigint, sk int")
    df = spark.createDataFrame([(10,), (20,), (30,), (40,)], "nk bigint")
    got = {r.nk: r.sk for r in surrogate_key_seq(df, order=["nk"], name="sk", existing=existing).collect()}
    assert got == {10: 1, 30: 2, 20: 3, 40: 4}


@pytest.mark.parametrize("descending", [True, False])
def test_rank_over_all_equals_a_window(values, descending):
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    expected = values.withColumn("r", F.rank().over(Window.orderBy(order)))
    assert plain(rank_over_all(values, by="v", name="r", descending=descending)) == plain(expected)


@pytest.mark.parametrize("descending", [True, False])
def test_rank_within_equals_a_window(values, descending):
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    expected = values.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(order)))
    got = rank_within(values, partition=["g"], by="v", name="r", descending=descending)
    assert plain(got.select("id", "g", "v", "r")) == plain(expected)


@pytest.fixture(scope="module")
def odd_values(spark):
    """NULL groups, NaN, one hot value, text with a long common prefix."""
    rng, nan = random.Random(3), float("nan")
    rows = [(i, None if i % 7 == 0 else "CAMPANHA " * 3 + str(rng.randrange(4)), rng.choice([None, nan, 1.5, 1.5, 1.5, -0.0, 0.0, rng.random()])) for i in range(700)]
    return spark.createDataFrame(rows, "id int, g string, v double").repartition(6)


@pytest.mark.parametrize("part", [(), ("g",)])
def test_ranks_equal_plain_windows(values, odd_values, part):
    for df in (values, odd_values):
        spec = {"a": ("v", True), "b": ("v", False), "c": ("id", True)}
        window = lambda c, d: Window.partitionBy(*part).orderBy(F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last())
        expected = df.withColumns({n: F.rank().over(window(c, d)) for n, (c, d) in spec.items()})
        assert plain(ranked(df, spec, partition=part).select(expected.columns)) == plain(expected)


def test_text_keys_with_nulls_and_a_common_prefix(spark):
    names = [None, "a", "b", *[f"CAMPANHA {i}" for i in range(300)]]
    df = spark.createDataFrame([(x,) for x in names], "nk string").repartition(5)
    got = {r.nk: r.sk for r in surrogate_key_seq(df, order=["nk"], name="sk").collect()}
    assert got == {x: i for i, x in enumerate(sorted(names, key=lambda x: (x is not None, x or "")), 1)}


@pytest.mark.parametrize("tiles", [4, 7])
def test_ntile_and_row_number(values, tiles):
    order = Window.orderBy(F.col("v").desc_nulls_last(), "id")
    expected = values.withColumn("t", F.ntile(tiles).over(order))
    assert plain(ntile_over_all(values, by="v", tie="id", name="t", tiles=tiles)) == plain(expected)
    numbered = values.withColumn("n", F.row_number().over(order))
    assert plain(row_number_over_all(values, by="v", tie="id", name="n")) == plain(numbered)


def test_ntile_with_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "id int, v double")
    assert [r.t for r in ntile_over_all(df, by="v", tie="id", name="t").orderBy("t").collect()] == [1, 2]


def test_label_dimension_has_each_label_once(spark):
    df = spark.createDataFrame([("a ",), ("A",), ("b",), ("DESCONHECIDO",), (None,)], "s string")
    dim = distinct_value_dim(df, column="s", label="nm", key="sk")
    assert plain(dim) == sorted(map(str, [(-1, "DESCONHECIDO"), (1, "A"), (2, "B")]))


def test_unknown_member_is_typed(spark):
    df = spark.createDataFrame([(1, 2.5, None)], "a smallint, b double, c date")
    out = unknown_member(df, {"a": -1})
    assert out.dtypes == df.dtypes and (-1, None, None) in [tuple(r) for r in out.collect()]


def test_resolve_keys_fills_missing_matches(spark):
    fact = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id int, nk bigint")
    dims = {"d": spark.createDataFrame([(7, 70)], "nk bigint, sk int")}
    out = resolve_keys(fact, dims, [Lookup("d", F.col("nk"), "nk", {"sk": "sk_d"}), Lookup("d", F.col("nk"), "nk", {"sk": "sk_e"}, ("sk_e",))])
    assert plain(out.select("id", "sk_d", "sk_e")) == sorted(map(str, [(1, 70, 70), (2, -1, None), (3, -1, None)]))


def test_registry_keeps_keys_and_survives_a_failed_assignment(spark, tmp_path):
    registry = KeyRegistry(spark, str(tmp_path / "keys"), "a string, b int")
    df = lambda rows: spark.createDataFrame(rows, "a string, b int, v int")
    first = {(r.a, r.b): r.k for r in registry.assign(df([("x", 1, 0), ("x", 1, 9), (None, 2, 0), ("b", None, 0)]), "k").collect()}
    assert sorted(first.values()) == [1, 2, 3]
    # A folder without a line in the log, as a failed assignment leaves it, is passed over and written anew.
    spark.createDataFrame([("z", 1, 99)], "a string, b int, nr_chave bigint").write.parquet(str(tmp_path / "keys" / "membros" / "nr_versao=2"))
    assert registry.state() == (1, 3) and registry.read().count() == 3
    out = registry.assign(df([("a", 0, 0), ("x", 1, 1), (None, 2, 1), ("zz", None, 1), ("b", None, 1)]), "k").collect()
    second = {(r.a, r.b): r.k for r in out}
    assert len(out) == 5 and all(second[m] == k for m, k in first.items()) and sorted(second.values()) == [1, 2, 3, 4, 5]
    assert registry.assign(df([("zz", None, 7)]), "k").first().k == second["zz", None] and registry.state() == (2, 5)
    assert registry.assign(df([]), "k").count() == 0 and registry.state() == (2, 5)


def test_dimensions_of_a_later_build_keep_their_keys(spark, sf_dir, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "lake")
    source.mkdir()
    for table in SOURCES:
        os.symlink(f"{sf_dir}/{table}.parquet", source / f"{table}.parquet")
    people = spark.read.parquet(f"{sf_dir}/customer.parquet")
    os.unlink(source / "customer.parquet")
    people.filter("c_custkey % 3 = 0").write.parquet(str(source / "customer.parquet"))
    build = lambda where: {r.nk_cliente: r.sk_cliente for r in Lakehouse(spark, where, root=root, stable_keys=True)["dim_cliente"].collect()}
    first, second = build(str(source)), build(sf_dir)
    assert len(second) > len(first) > 10 and all(second[nk] == sk for nk, sk in first.items())
    assert len(set(second.values())) == len(second) and build(sf_dir) == second


def test_a_batch_rewrites_its_dates_only_and_removes_deleted_rows(spark, tmp_path):
    """The feed on a small fact: one changed, one new, one deleted row; files of other dates stay."""
    dims = {
        "dim_operador": spark.createDataFrame([(1, 10), (2, 20), (-1, -1)], "nk_operador long, sk_operador int"),
        "dim_data": spark.sql("select cast(date_format(d, 'yyyyMMdd') as int) as sk_data, d as dt_completa from (select explode(sequence(date'2024-01-01', date'2024-01-09')) as d)"),
    }
    schema = "id_jornada long, id_operador long, dt_jornada timestamp, nr_horas_trabalhadas double, nr_chamadas_atendidas int, nr_tickets_resolvidos int, st_presenca string, fl_presente smallint, op_cdc string"
    row = lambda i, day, hours, op="INSERT": (i, i % 3, datetime.datetime(2024, 1, day), hours, 1, 1, "PRESENTE", 1, op)
    state = {i: row(i, i, float(i)) for i in range(1, 7)}
    frame = lambda: spark.createDataFrame(list(state.values()), schema)
    dims["jornada_operador"] = frame()
    feed = GoldFeed(spark, str(tmp_path / "fact"), "fato_jornada_operador", dims)
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id_jornada long")
    assert feed.refresh(frame(), ids(*state), "1")
    files = lambda: {p.parent.name: p.name for p in (tmp_path / "fact" / "data").glob("*/*.parquet")}
    before = files()
    state |= {2: row(2, 3, 9.0), 5: row(5, 5, 5.0, "DELETE"), 7: row(7, 8, 7.0)}
    assert feed.refresh(frame(), ids(2, 5, 7), "2") and not feed.refresh(frame(), ids(2, 5, 7), "2")
    after = files()
    assert {d for d in before if after.get(d) == before[d]} == {"sk_data=20240101", "sk_data=20240104", "sk_data=20240106"}
    assert "sk_data=20240102" not in after and "sk_data=20240105" not in after and "sk_data=20240108" in after
    full = build_fact("fato_jornada_operador", {**dims, "jornada_operador": frame()})
    assert sorted(map(tuple, feed.read().collect())) == sorted(map(tuple, full.collect()))
