"""Change-data properties: dedup, merge, quarantine, incremental runs."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from atende.operators import cdc, merge
from atende.plans.layers import AS_OF, Lakehouse
from atende.plans.silver import SPECS, build_silver, late_columns, mark_silver, silver_spec
from atende.sources import bindings
from atende.sources.tables import write_table_partitioned
from atende.sources.verdicts import INGESTED, MarkedTable
from atende.streaming.incremental import (
    PartitionedTable, UnreadableEvents, VersionedTable, WatermarkStore, merge_batch, run_incremental, run_with_watermark,
    unreadable_events,
)

EVENT = "id string, v string, Op string, _timestamp string, _seq bigint"


def events(spark, rows):
    return spark.createDataFrame(rows, EVENT)


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


rows = st.lists(
    st.tuples(
        st.sampled_from(["1", "2", "3"]), st.sampled_from(["a", "b"]), st.sampled_from(["I", "U", "D", "?"]),
        st.sampled_from(["2024-01-01T00:00:00", "2024-01-02T00:00:00", "ontem"]),
    ),
    max_size=12,
)
quick = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@quick
@given(rows)
def test_dedup_keeps_the_newest_row_per_key(spark, drawn):
    drawn = [(*r, i) for i, r in enumerate(drawn)]
    decoded = cdc.cdc_decode_op(events(spark, drawn))
    got = cdc.cdc_dedup_latest(decoded, keys=["id"], order=["dt_cdc_evento", "_seq"]).select("id", "_seq")
    newest = {}
    for key, _, _, time, seq in drawn:
        rank = (time if time.startswith("2024") else "", seq)
        newest[key] = max(newest.get(key, rank), rank)
    assert plain(got) == sorted((k, r[1]) for k, r in newest.items())


def _table(spark, drawn):
    df = cdc.cdc_decode_op(events(spark, drawn))
    df = cdc.cdc_dedup_latest(df, keys=["id"], order=["dt_cdc_evento", "_seq"])
    return df.select("id", "v", "op_cdc", "dt_cdc_evento").withColumn("hash_registro", cdc.row_hash(["id", "v"]))


@quick
@given(rows, st.integers(0, 12))
def test_split_batches_give_the_same_values_as_one(spark, drawn, cut):
    """In order, two batches merged one after the other end with the values of a single run."""
    drawn = [(k, v, "U", f"2024-01-{i + 1:02d}T00:00:00", i) for i, (k, v, _, _) in enumerate(drawn)]
    first, second = _table(spark, drawn[:cut]), _table(spark, drawn[cut:])
    both = merge.merge_upsert_if_changed(first, second, keys=["id"])
    assert plain(both.select("id", "v")) == plain(_table(spark, drawn).select("id", "v"))
    assert both.count() == both.select("id").distinct().count()


@quick
@given(rows)
def test_replaying_a_batch_changes_nothing(spark, drawn):
    table = _table(spark, [(*r, i) for i, r in enumerate(drawn)])
    assert plain(merge.merge_upsert_if_changed(table, table, keys=["id"])) == plain(table)


def _one(spark, v, op, day):
    return _table(spark, [("1", v, op, f"2024-01-{day:02d}T00:00:00", 0)])


def test_merge_modes(spark):
    old, late, gone = _one(spark, "a", "I", 5), _one(spark, "b", "U", 3), _one(spark, "a", "D", 6)

    def result(source, **kw):
        return merge.merge_upsert_if_changed(old, source, keys=["id"], **kw).select("v", "op_cdc").first()

    assert tuple(result(late)) == ("b", "UPDATE")  # base behaviour: a late event wins
    assert tuple(result(late, newer_only="dt_cdc_evento")) == ("a", "INSERT")
    assert tuple(result(gone)) == ("a", "INSERT")  # the operation is not part of the hash
    assert tuple(result(gone, deletes="apply")) == ("a", "DELETE")


def test_merge_upsert_all_replaces_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert plain(merge.merge_upsert_all(target, source, keys=["k"])) == [(1, "a"), (2, None), (3, "c")]


def test_partition_merge_rewrites_only_touched_partitions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id int, hash_registro string, dia int"
    target = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", 3), (4, "a", 3)], schema)
    write_table_partitioned(target, path, by=["dia"])

    def files():
        return {p.name for p in (tmp_path / "t").glob("dia=3/*.parquet")}

    before = files()
    # 1 moves from day 1 (its only row) to day 2, 5 is new on day 4, day 3 is not touched
    batch = spark.createDataFrame([(1, "b", 2), (5, "b", 4)], schema)
    for _ in range(2):  # merging the batch again changes nothing
        merge.merge_into_partitions(path, batch, keys=["id"], by=["dia"])
        got = spark.read.schema(schema).parquet(path)
        assert plain(got) == [(1, "b", 2), (2, "a", 2), (3, "a", 3), (4, "a", 3), (5, "b", 4)]
    assert files() == before


def test_partition_merge_keeps_null_partitions_and_prunes(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id int, hash_registro string, dia int"
    rows = [(1, "a", None), (2, "a", None), (3, "a", 7), (4, "a", 9), (5, "a", 30)]
    write_table_partitioned(spark.createDataFrame(rows, schema), path, by=["dia"])
    # 1 changes in place, 3 moves to the NULL partition and empties day 7, 4 leaves it as the last of day 9
    batch = spark.createDataFrame([(1, "b", None), (3, "b", None), (4, "b", 8)], schema)
    for _ in range(2):
        merge.merge_into_partitions(path, batch, keys=["id"], by=["dia"])
        got = spark.read.schema(schema).parquet(path)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "b", None), (2, "a", None), (3, "b", None), (4, "b", 8), (5, "a", 30)]))
    assert not list((tmp_path / "t").glob("dia=7")) and not list((tmp_path / "t").glob("dia=9"))
    wanted = spark.createDataFrame([(8,), (9,)], "dia int")
    plan = merge._of_partitions(spark.read.schema(schema).parquet(path), wanted, ["dia"])._jdf.queryExecution().executedPlan().toString()
    filters = next(x for x in plan.split("PartitionFilters: ")[1:])
    assert "dia" in filters and "subquery" in filters.lower()


def test_merge_with_composite_key_and_empty_target(spark):
    source = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a int, b int, hash_registro string")
    empty = source.filter("false")
    assert plain(merge.merge_upsert_if_changed(empty, source, keys=["a", "b"])) == plain(source)


@pytest.mark.parametrize("entity", list(SPECS))
def test_every_latest_row_is_valid_or_rejected(spark, sf_dir, entity):
    bronze = bindings.bronze(spark, entity, lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
    marked = mark_silver(entity, bronze, as_of=AS_OF, tie_break="_seq")
    valid, rejected = build_silver(entity, bronze, as_of=AS_OF, tie_break="_seq")
    keys = SPECS[entity](F.lit(AS_OF).cast("date")).key
    assert valid.count() + rejected.count() == marked.count() == bronze.select(*keys).distinct().count()
    assert "dt_ingestao_silver" not in valid.columns and cdc.REASON not in valid.columns


def test_optional_columns_are_null_when_the_source_lacks_them(spark, sf_dir):
    bronze = bindings.bronze(spark, "operador", lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
    valid, _ = build_silver("operador", bronze.drop("id_supervisor"), as_of=AS_OF, run_ts="2024-01-16 01:00:00")
    assert dict(valid.dtypes)["id_supervisor"] == "bigint"
    assert valid.filter("id_supervisor is not null").count() == 0
    assert valid.first()["dt_ingestao_silver"] == datetime(2024, 1, 16, 1)


def _whatsapp(spark, sf_dir):
    return bindings.bronze(spark, "whatsapp_atendimento", lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))


def test_file_stream_takes_each_file_once(spark, sf_dir, tmp_path):
    source, seen = str(tmp_path / "in"), []
    table = VersionedTable(spark, str(tmp_path / "table"))
    rows = _whatsapp(spark, sf_dir)

    def step(batch, batch_id):
        for _ in range(2):  # the second time is a retry, which repeats no rejected row
            result = merge_batch("whatsapp_atendimento", batch, table, checked=str(tmp_path / "checked"), batch_id=batch_id, as_of=AS_OF, tie_break="_seq")
        seen.append(result)

    for part in (rows.filter("_seq < 400"), rows.filter("_seq >= 400")):
        part.write.mode("append").parquet(source)
        run_incremental(spark, source, rows.schema, str(tmp_path / "mark"), step)
    run_incremental(spark, source, rows.schema, str(tmp_path / "mark"), step)
    assert [r["rows"] for r in seen] == [400, rows.count() - 400]
    valid, rejected = build_silver("whatsapp_atendimento", rows, as_of=AS_OF, tie_break="_seq")
    assert plain(table.read()) == plain(valid)
    assert _checked(spark, rows, tmp_path).rejected().count() == rejected.count()


@pytest.mark.parametrize("partitioned", [False, True])
def test_watermark_run_reads_only_newer_events_and_skips_empty_batches(spark, sf_dir, tmp_path, partitioned):
    rows, path = _whatsapp(spark, sf_dir), str(tmp_path / "table")
    table = PartitionedTable(spark, path, ("ano", "mes", "dia")) if partitioned else VersionedTable(spark, path)
    store = WatermarkStore(spark, str(tmp_path / "marks"))

    def run(df):
        return run_with_watermark(
            "whatsapp_atendimento", df, table, store, checked=str(tmp_path / "checked"), as_of=AS_OF, now=AS_OF, tie_break="_seq"
        )["rows"]

    early = rows.filter("_timestamp < '2024-01-10'")
    assert run(early) == early.count()
    assert run(rows) == rows.count() - early.count()
    assert run(rows) == 0 and table.version() == 2
    assert plain(table.read()) == plain(build_silver("whatsapp_atendimento", rows, as_of=AS_OF, tie_break="_seq")[0])


def _checked(spark, rows, tmp_path):
    schema = mark_silver("whatsapp_atendimento", rows, as_of=AS_OF, tie_break="_seq").schema
    return MarkedTable(spark, str(tmp_path / "checked"), schema)


def test_nothing_rejected_and_nothing_read(spark, sf_dir, tmp_path):
    rows = _whatsapp(spark, sf_dir).filter("id_cliente is not null and dt_inicio like '2024-0%'")
    table = VersionedTable(spark, str(tmp_path / "table"))
    options = dict(checked=str(tmp_path / "checked"), as_of=AS_OF, tie_break="_seq")
    merge_batch("whatsapp_atendimento", rows, table, batch_id=1, **options)
    assert _checked(spark, rows, tmp_path).rejected().count() == 0 and table.version() == 1
    assert merge_batch("whatsapp_atendimento", rows.filter("false"), table, batch_id=2, **options)["rows"] == 0 and table.version() == 1
    figures = _checked(spark, rows, tmp_path).metrics().first()
    assert figures.nr_dedup == figures.nr_validos == table.read().count() and figures.nr_quarentena == 0


def test_unreadable_times_reach_the_quarantine_once(spark, tmp_path):
    bad = UnreadableEvents(spark, str(tmp_path / "bad"))
    rows = spark.createDataFrame([(1, "ontem"), (2, None), (2, None), (3, "2024-01-05 10:00:00"), (None, "")], "id int, _timestamp string")
    for batch in ("1", "1", "2"):  # a retry of the first, then a second run that meets the same rows
        bad.add(unreadable_events(rows), batch, ingested=F.lit(AS_OF))
    more = spark.createDataFrame([(9, "amanha")], "id int, _timestamp string")
    bad.add(unreadable_events(rows.unionByName(more)), "3", ingested=F.lit(AS_OF))
    got = sorted((r._lote, r.ds_linha) for r in bad.read().collect())
    assert [b for b, _ in got] == ["1", "1", "1", "3"] and len({x for _, x in got}) == 4


def test_a_one_day_merge_reads_that_day_only(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["ano", "mes", "dia"]
    rows = spark.range(300).selectExpr("id", "'a' as hash_registro", "2023 + int(id div 150) as ano", "1 + int(id % 12) as mes", "1 + int(id % 25) as dia")
    write_table_partitioned(rows, path, by=by)
    target = spark.read.schema(rows.schema).parquet(path)
    wanted = spark.createDataFrame([(2024, 5, 11)], "ano int, mes int, dia int")
    read = merge._of_partitions(target, wanted, by)
    assert read.count() == rows.filter("ano = 2024 and mes = 5 and dia = 11").count() > 0
    executed = read._jdf.queryExecution().executedPlan()
    read._jdf.queryExecution().toRdd().count()
    final = executed.executedPlan() if executed.nodeName() == "AdaptiveSparkPlan" else executed

    def all_nodes(plan):
        plan = plan.plan() if plan.nodeName().endswith("QueryStage") else plan
        kids = plan.children()
        return [plan] + [x for i in range(kids.size()) for x in all_nodes(kids.apply(i))]

    listed = [p.metrics().apply("numPartitions").value() for p in all_nodes(final) if p.nodeName().startswith("Scan parquet") and p.metrics().contains("numPartitions")]
    assert listed == [1]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = cdc.cdc_dedup_latest(spark.range(100).selectExpr("id % 3 as k", "id as t"), keys=["k"], order=["t"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_events_dealt_by_key_are_sorted_only_behind_the_shuffle(spark):
    """The limit below the shuffle sorts whole input splits; dealt by key, no task sorts more than its part."""
    df = cdc.cdc_decode_op(spark.range(4000).selectExpr(
        "cast(id % 900 as string) as id", "'I' as Op", "'2024-01-01T00:00:00' as _timestamp", "id as _seq", "uuid() as v"
    )).repartition(3)
    tasks = cdc.dedup_tasks(df, ["id"])
    dealt = cdc.cdc_dedup_latest(df, keys=["id"], order=["dt_cdc_evento", "_seq"], tasks=tasks)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(id")[-1]
    assert tasks >= 1 and "Sort [" in plan and "Sort [" not in below
    plainly = cdc.cdc_dedup_latest(df, keys=["id"], order=["dt_cdc_evento", "_seq"])
    assert plain(dealt.select("id", "_seq")) == plain(plainly.select("id", "_seq"))


def test_tasks_follow_the_events_unless_a_key_is_hot(spark, monkeypatch):
    monkeypatch.setattr(cdc, "TASK_ROWS", 100)
    even = spark.range(5000).selectExpr("cast(id as string) as id")
    assert cdc.dedup_tasks(even, ["id"]) == 50
    assert cdc.dedup_tasks(even.selectExpr("if(id % 3 = 0, null, id) as id"), ["id"]) is None
    assert cdc.dedup_tasks(even.limit(0), ["id"]) >= 1


@pytest.mark.parametrize("tasks", [None, 3])
def test_raw_keys_that_read_alike_stay_apart(spark, sf_dir, tasks):
    """Rows are told apart by the text of the key, though the events are typed before they are compared."""
    first = bindings.bronze(spark, "skill_operador", lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")).limit(1)
    names = ["7", "07", " 7", "x", "y", None, "", "-1", "=07", "-"]
    keys = spark.createDataFrame([(a, b, s) for a in names for b in names for s in (1, 2)], "a string, b string, s bigint")
    bronze = first.crossJoin(keys).withColumns({"id_skill": F.col("a"), "id_operador": F.col("b"), "_seq": F.col("s")}).drop("a", "b", "s")
    marked = mark_silver("skill_operador", bronze, as_of=AS_OF, tie_break="_seq", tasks=tasks)
    assert marked.count() == len(names) ** 2


def test_the_late_row_hash_is_the_same(spark, sf_dir):
    lake = Lakehouse(spark, sf_dir)
    expected = mark_silver("discagem", lake.bronze("discagem"), as_of=AS_OF, tie_break="_seq", extended=True).filter(F.col(cdc.REASON).isNull())
    assert plain(lake["discagem"].select("id_discagem", "hash_registro")) == plain(expected.select("id_discagem", "hash_registro"))
    assert lake["discagem"].columns == [c for c in expected.columns if c != cdc.REASON]


@pytest.mark.parametrize("entity", ["cliente", "ticket", "metricas_operacionais", "gravacao_chamada"])
def test_derived_columns_are_not_shuffled_by_date(spark, sf_dir, tmp_path, entity):
    lake = Lakehouse(spark, sf_dir)
    marked = mark_silver(entity, lake.bronze(entity), as_of=AS_OF, tie_break="_seq", extended=True)
    late = late_columns(entity, AS_OF)
    spec = silver_spec(entity, AS_OF)
    by = [c for c in (spec.partition[1] if spec.partition else ()) if c != "dia"]
    sent = MarkedTable(spark, str(tmp_path / "t"), marked.schema, by)._dealt(marked, F.lit(AS_OF), late)._jdf.queryExecution().optimizedPlan()
    while sent.nodeName() != "RebalancePartitions":
        sent = sent.children().apply(0)
    names = {sent.output().apply(i).name() for i in range(sent.output().size())}
    assert spec.key[0] in names and not names & {n for step in late for n in step} and not names & {*INGESTED, *by}
    assert plain(lake.marked(entity).read().select(*marked.columns)) == plain(marked)
