"""Registered queries for scans, sinks, change-data operators and column rules."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions import casts, privacy, rules
from atende.operators import cdc, keys, lookup, merge, quality
from atende.plans import views
from atende.plans.facts import FACTS
from atende.plans.layers import AS_OF, GOLD, SILVER_WAVE, Lakehouse
from atende.plans.silver import build_silver, latest_events, mark_silver, silver_spec
from atende.sources import tables
from atende.sources.verdicts import INGESTED, MarkedTable
from atende.streaming import incremental
from atende.streaming.gold_feed import GoldFeed

BASE: dict[str, Callable[[Lakehouse], DataFrame]] = {}


def query(fn: Callable[[Lakehouse], DataFrame]) -> Callable[[Lakehouse], DataFrame]:
    BASE[fn.__name__] = fn
    return fn


def _fresh(lake: Lakehouse, name: str) -> str:
    """A new folder for a query that writes."""
    return lake.path("runs", f"{name}-{uuid.uuid4().hex[:8]}")


def _as_of():
    return F.lit(AS_OF).cast("date")


# --- scans, sinks, incremental reads -------------------------------------------------

@query
def a1_scan_csv_strings(lake):
    rows = lake.bronze("cliente").drop("_seq")
    path = _fresh(lake, "csv")
    tables.write_csv(rows, path)
    return tables.scan_csv_strings(lake.spark, path, rows.columns)


@query
def a2_scan_parquet(lake):
    recent = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return tables.scan_parquet(lake.spark, f"{lake.source_dir}/orders.parquet", recent).select(
        "o_orderkey", "o_custkey"
    )


@query
def a3_scan_catalog(lake):
    lake.source("orders").createOrReplaceTempView("catalogo_pedidos")
    return tables.scan_catalog(lake.spark, "catalogo_pedidos").select("o_orderkey", "o_orderstatus")


def _now():
    return F.lit(AS_OF).cast("timestamp")


@query
def a4_derive_date_partitions(lake):
    out = tables.derive_date_partitions(lake.bronze("ticket"), date="dt_abertura", now=_now())
    return out.select("id_ticket", *tables.LANDING)


@query
def a5_write_bronze_partitioned(lake):
    return tables.write_bronze_partitioned(
        lake.bronze("chamada"), _fresh(lake, "bronze"), date="dt_inicio", now=_now()
    )


@query
def a5_load_tables(lake):
    """Three tables landed side by side, one of them empty: status and rows, and whether files came."""
    root = _fresh(lake, "landing")
    given = {
        "chamada": (lake.bronze("chamada"), "dt_inicio"), "ticket": (lake.bronze("ticket"), "dt_abertura"),
        "vazia": (lake.bronze("chat").filter("id_chat = 'nenhum'"), "dt_inicio"),
    }
    report = tables.load_tables(lake.spark, {n: (df, os.path.join(root, n), date) for n, (df, date) in given.items()}, now=_now())
    return report.select("nm_tabela", "ds_status", "nr_linhas", rules.flag(F.col("nr_arquivos") > 0).alias("fl_tem_arquivos"))


@query
def a6_watermark_filter(lake):
    return incremental.watermark_filter(lake.bronze("chamada"), "2024-01-15 00:00:00").select(
        "id_chamada", "Op", "_timestamp"
    )


def _garbled(lake):
    """Calls of which every seventh event has a time that cannot be read, or none."""
    rows, third = lake.bronze("chamada"), F.pmod(F.col("id_chamada").try_cast("bigint"), F.lit(7))
    return rows.withColumn("_timestamp", F.when(third == 3, F.concat(F.lit("sem hora "), "_timestamp")).when(third == 5, None).otherwise(F.col("_timestamp")))


@query
def a6_unreadable_times(lake):
    """Two runs over early events, then all: what was merged, and what reached the quarantine of unreadable times."""
    root, rows = _fresh(lake, "garbled"), _garbled(lake)
    table = incremental.VersionedTable(lake.spark, os.path.join(root, "table"))
    store = incremental.WatermarkStore(lake.spark, os.path.join(root, "marks"))
    bad = incremental.UnreadableEvents(lake.spark, os.path.join(root, "unreadable"))
    early = rows.filter(F.coalesce(F.col("_timestamp") < "2024-01-15", F.col("_seq") == 0))
    for part in (early, rows, rows):
        incremental.run_with_watermark(
            "chamada", part, table, store, checked=os.path.join(root, "checked"), as_of=AS_OF, now=AS_OF, tie_break="_seq", unreadable=bad
        )
    kept = table.read().agg(F.count(F.lit(1)).alias("nr_linhas")).select(F.lit("mesclado").alias("ds_destino"), "nr_linhas")
    return kept.unionByName(bad.read().groupBy(F.col(cdc.REASON).alias("ds_destino")).agg(F.count(F.lit(1)).alias("nr_linhas")))


@query
def a7_watermark_advance(lake):
    return incremental.watermark_advance(lake.bronze("chamada"), "1970-01-01 00:00:00")


@query
def a8_incremental_files(lake):
    """Two landings of the same table, each picked up once by the file stream."""
    root = _fresh(lake, "stream")
    source = os.path.join(root, "landed")
    table = incremental.PartitionedTable(lake.spark, os.path.join(root, "table"), ("ano", "mes", "dia"))
    rows = lake.bronze("whatsapp_atendimento")
    early = F.col("_timestamp") < "2024-01-16"

    def step(batch: DataFrame, batch_id: int) -> None:
        incremental.merge_batch(
            "whatsapp_atendimento", batch, table, checked=os.path.join(root, "checked"), batch_id=batch_id,
            as_of=AS_OF, tie_break="_seq",
        )

    for part in (rows.filter(early), rows.filter(~early)):
        part.write.mode("append").parquet(source)
        incremental.run_incremental(lake.spark, source, rows.schema, os.path.join(root, "bookmark"), step)
    return table.read()


@query
def a9_empty_batch_noop(lake):
    """Rows read by two runs on the same input: the second finds nothing and writes nothing."""
    root = _fresh(lake, "watermark")
    table = incremental.VersionedTable(lake.spark, os.path.join(root, "table"))
    store = incremental.WatermarkStore(lake.spark, os.path.join(root, "marks"))
    runs = [
        incremental.run_with_watermark(
            "ura_navegacao", lake.bronze("ura_navegacao"), table, store,
            checked=os.path.join(root, "checked"), as_of=AS_OF, now=AS_OF, tie_break="_seq",
        )
        for _ in range(2)
    ]
    kept = table.read().agg(F.count(F.lit(1)).alias("nr_tabela"), F.lit(table.version()).alias("nr_versao"))
    return kept.select(
        F.lit(runs[0]["rows"]).cast("bigint").alias("nr_primeira"),
        F.lit(runs[1]["rows"]).cast("bigint").alias("nr_segunda"), "*",
    )


@query
def a10_write_quarantine(lake):
    """What the layer build stored of the rejected calls."""
    return lake.quarantine("chamada").groupBy(cdc.REASON, *INGESTED).agg(F.count(F.lit(1)).alias("nr_linhas"))


@query
def a11_write_table_partitioned(lake):
    """The layer's own table, by the date parts it is partitioned by."""
    return lake["chamada"].groupBy("ano", "mes", "dia").agg(
        F.count(F.lit(1)).alias("nr_linhas"), F.sum("nr_duracao_segundos").alias("nr_segundos")
    )


@query
def a12_publish_snapshot(lake):
    path = _fresh(lake, "snapshot")
    for _ in range(2):
        tables.publish_snapshot(lake["dim_operador"], path)
    return lake.spark.read.parquet(path)


@query
def a13_export_csv_for_load(lake):
    rows, path = lake["chat"], _fresh(lake, "export")
    tables.export_csv_for_load(rows, path)
    return tables.load_exported_csv(lake.spark, path, rows.schema)


@query
def a14_reprocess_partition(lake):
    """One day is rebuilt without its tombstones; every other day keeps its rows."""
    path, by = _fresh(lake, "reprocess"), ("ano", "mes", "dia")
    tables.write_table_partitioned(lake["chamada"], path, by=by)
    rebuilt = cdc.drop_tombstones(lake["chamada"])
    tables.reprocess_partition(rebuilt, path, by=by, day={"ano": 2024, "mes": 1, "dia": 10})
    return lake.spark.read.schema(lake["chamada"].schema).parquet(path).groupBy(*by).agg(
        F.count(F.lit(1)).alias("nr_linhas")
    )


@query
def a15_layer_entry(lake):
    """Both upper layers of one dependent fact, built in wave order into their own folder."""
    own = Lakehouse(lake.spark, lake.source_dir, root=_fresh(lake, "layers"))
    built = own.run("silver", only=["fato_mensagem_chat"])
    return reduce(
        DataFrame.unionByName,
        [
            quality.table_counts({n: own[n] for n in names}).withColumn("nm_camada", F.lit(layer))
            for layer, names in built.items()
        ],
    )


@query
def a15_publish(lake):
    """A run from bronze on that publishes, then one that only publishes: what readers see after both."""
    own = Lakehouse(lake.spark, lake.source_dir, root=_fresh(lake, "layers"))
    shop = tables.Published(lake.spark, own.path("publicado"))
    for start in ("bronze", "publish"):
        own.run(start, only=["fato_mensagem_chat"], publish_to=shop.path)
    counts = quality.table_counts({n: shop.read(n) for n in shop.tables()})
    return counts.withColumn("nr_publicacao", F.lit(shop.current()))


@query
def a16_ctas_monthly_report(lake):
    return tables.monthly_report(
        lake["chamada"], time="dt_inicio", seconds="nr_duracao_segundos",
        resolved=F.col("st_chamada") == "ATENDIDA",
    )


@query
def a16_last_30_days(lake):
    return tables.monthly_report(
        lake["chamada"], time="dt_inicio", seconds="nr_duracao_segundos",
        resolved=F.col("st_chamada") == "ATENDIDA", last_days=30, as_of=F.lit("2024-02-05").cast("date"),
    )


# --- change data, quality, personal data ---------------------------------------------

@query
def b1_cdc_decode_op(lake):
    return cdc.cdc_decode_op(lake.bronze("chamada")).select("id_chamada", "_seq", "op_cdc", "dt_cdc_evento")


@query
def b2_cdc_dedup_latest(lake):
    events = lake.source("events").select("user_id", "event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    return cdc.cdc_dedup_latest(events, keys=["user_id"], order=["ts", "event_id"])


@query
def b2_cdc_dedup_composite(lake):
    rows = latest_events("skill_operador", lake.bronze("skill_operador"), AS_OF, "_seq")
    return rows.select("id_skill", "id_operador", "nr_nivel", "dt_cdc_evento", "_seq")


@query
def b3_safe_cast(lake):
    rows = lake.bronze("avaliacao_qualidade").select("id_avaliacao", "id_chamada", "nr_nota_geral", "dt_avaliacao")
    return casts.cast_columns(
        rows, {"id_avaliacao": "bigint", "id_chamada": "bigint", "nr_nota_geral": "double", "dt_avaliacao": "timestamp"}
    )


@query
def b4_normalize_text(lake):
    return lake.bronze("cliente").select(
        "id_cliente", casts.upper_text("nm_cliente").alias("nm_cliente"), casts.lower_text("ds_email").alias("ds_email"),
        casts.digits("nr_documento").alias("nr_documento"), casts.digits("nr_telefone", keep_plus=True).alias("nr_telefone"),
    )


@query
def b5_fill_defaults(lake):
    rows = lake.bronze("chamada").select("id_chamada", "_seq", "id_operador", "id_fila", "st_chamada", "tp_chamada")
    typed = casts.cast_columns(rows, {"id_operador": "bigint", "id_fila": "bigint"})
    return casts.fill_defaults(typed, {"id_operador": -1, "id_fila": -1, "st_chamada": rules.UNKNOWN, "tp_chamada": rules.UNKNOWN})


@query
def b6_mask_document(lake):
    return lake.bronze("cliente").select("id_cliente", privacy.mask_document(casts.digits("nr_documento")).alias("ds_mascara"))


@query
def b7_mask_email(lake):
    return lake.bronze("cliente").select("id_cliente", privacy.mask_email(casts.lower_text("ds_email", "")).alias("ds_mascara"))


@query
def b8_mask_phone(lake):
    return lake.bronze("cliente").select("id_cliente", privacy.mask_phone(casts.digits("nr_telefone", keep_plus=True)).alias("ds_mascara"))


@query
def b9_mask_postal_code(lake):
    return lake.bronze("endereco_cliente").select("id_endereco", privacy.mask_postal_code(casts.digits("nr_cep")).alias("ds_mascara"))


@query
def b10_mask_login(lake):
    return lake.bronze("operador").select("id_operador", privacy.mask_login(casts.lower_text("ds_email", "")).alias("ds_mascara"))


@query
def b11_redact_free_text(lake):
    return lake.source("documents").select(
        "doc_id", privacy.text_length("text").alias("nr_tamanho"), privacy.has_text("text").alias("fl_tem_texto")
    )


@query
def b12_row_hash(lake):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return lake.source("orders").select("o_orderkey", cdc.row_hash(["o_orderkey", "o_custkey", "o_orderstatus", day]).alias("hash_registro"))


@query
def b13_quarantine_split(lake):
    """Rejected rows of all current-state tables, by reason, from their stored quarantine."""
    lake.require(SILVER_WAVE)
    return reduce(
        DataFrame.unionByName,
        [
            lake.quarantine(e).groupBy(cdc.REASON).agg(F.count(F.lit(1)).alias("nr_linhas")).withColumn("nm_tabela", F.lit(e))
            for e in SILVER_WAVE
        ],
    )


def _batches(lake):
    """Valid calls of two batches: the first events, then the later updates."""
    rows = lake.bronze("chamada")
    return [
        build_silver("chamada", rows.filter(F.col("_seq") == i), as_of=AS_OF, tie_break="_seq")[0] for i in range(2)
    ]


@query
def b14_merge_upsert_if_changed(lake):
    target, source = _batches(lake)
    return merge.merge_upsert_if_changed(target, source, keys=["id_chamada"])


@query
def b14_merge_into_partitions(lake):
    """The same merge on a table partitioned by date, in place."""
    (target, source), path, by = _batches(lake), _fresh(lake, "merge"), ("ano", "mes", "dia")
    tables.write_table_partitioned(target, path, by=by)
    merge.merge_into_partitions(path, source, keys=["id_chamada"], by=by)
    return lake.spark.read.schema(target.schema).parquet(path)


@query
def b14_merge_apply_deletes(lake):
    """The updates arrive first and the original events late: only newer rows get in, deletes do."""
    source, target = _batches(lake)
    return merge.merge_upsert_if_changed(
        target, source, keys=["id_chamada"], newer_only="dt_cdc_evento", deletes="apply"
    )


@query
def b15_merge_upsert_all(lake):
    orders = lake.source("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    target = orders.filter("o_orderstatus <> 'P'")
    source = orders.filter("o_orderstatus <> 'F'").withColumn("o_orderstatus", F.lower("o_orderstatus"))
    return merge.merge_upsert_all(target, source, keys=["o_orderkey"])


@query
def b16_add_audit_columns(lake):
    return cdc.add_audit_columns(lake.source("supplier"), name="dt_ingestao_silver", run_ts="2024-01-16 01:00:00")


@query
def b17_partition_columns(lake):
    return lake["ticket"].select("id_ticket", *[c.alias(n) for n, c in cdc.partition_columns("dt_abertura").items()])


@query
def b18_run_metrics(lake):
    """Rows read, and of the stored batch the rows after dedup, valid and rejected."""
    read = lake.bronze("chamada").agg(F.count(F.lit(1))).scalar()
    return lake.marked("chamada").metrics().withColumn("nr_lidos", read)


@query
def b19_drop_tombstones(lake):
    return cdc.drop_tombstones(lake["discagem"]).groupBy("op_cdc").agg(F.count(F.lit(1)).alias("nr_linhas"))


@query
def b20_schema_project(lake):
    return cdc.schema_project(lake["campanha"], silver_spec("campanha", AS_OF).columns)


# --- column rules --------------------------------------------------------------------

def rule(name: str, entity: str, key: str, build: Callable[[], dict]) -> None:
    """Register a rule as key + recomputed columns over a whole current-state table."""
    BASE[name] = lambda lake: lake[entity].select(key, *[c.alias(n) for n, c in build().items()])


rule("c1_flag_valid_duration", "chamada", "id_chamada", lambda: {"v": rules.flag_valid_duration("nr_duracao_segundos", "dt_inicio", "dt_fim")})
rule("c2_flag_complete", "whatsapp_atendimento", "id_whatsapp", lambda: {"v": rules.flag_complete("dt_inicio", "dt_fim")})
rule("c3_minutes_from_seconds", "chamada", "id_chamada", lambda: {"v": rules.minutes_from_seconds("nr_duracao_segundos")})
rule("c4_duration_seconds", "whatsapp_atendimento", "id_whatsapp", lambda: {"v": rules.duration_seconds("dt_inicio", "dt_fim")})
rule("c5_resolution_minutes", "ticket", "id_ticket", lambda: {"v": rules.resolution_minutes("dt_abertura", "dt_resolucao")})
rule("c6_flag_resolved", "ticket", "id_ticket", lambda: {"v": rules.flag_resolved("st_ticket")})
rule("c7_flag_within_sla", "ticket", "id_ticket", lambda: {"v": rules.flag_within_sla("nr_tempo_resolucao_min")})
rule("c8_band_score", "avaliacao_qualidade", "id_avaliacao", lambda: {
    "v": rules.band_score("nr_nota_geral"), "ok": rules.flag_passed("nr_nota_geral"), "mau": rules.flag_critical("nr_nota_geral")})
rule("c9_band_tenure", "operador", "id_operador", lambda: {"v": rules.band_tenure(rules.tenure_days("dt_admissao", _as_of()))})
rule("c10_band_skill_level", "skill_operador", "id_operador", lambda: {"nr_nivel": F.col("nr_nivel"), "v": rules.band_skill_level("nr_nivel")})
rule("c11_band_wait", "ura_navegacao", "id_ura", lambda: {"v": rules.band_wait("nr_duracao_segundos")})
rule("c12_flag_ivr_abandon", "ura_navegacao", "id_ura", lambda: {"v": rules.flag_ivr_abandon("ds_opcao_selecionada")})
rule("c13_service_level", "metricas_operacionais", "id_metrica", lambda: {
    "v": rules.service_level("nr_chamadas_atendidas", "nr_chamadas_abandonadas"), "presenca": rules.attendance_rate("nr_taxa_abandono"),
    "meta": rules.flag_service_goal("nr_nivel_servico"), "alto": rules.flag_high_abandon("nr_taxa_abandono")})
rule("c14_campaign_window", "campanha", "id_campanha", lambda: {
    "dias": rules.campaign_days("dt_inicio", "dt_fim"), "vigente": rules.flag_in_force("dt_inicio", "dt_fim", _as_of()),
    "ativa": rules.flag_status("st_campanha", "ATIVA")})
rule("c15_recording_expiry", "gravacao_chamada", "id_gravacao", lambda: {
    "expirada": rules.flag_expired("dt_gravacao", _as_of()), "dias": rules.days_to_expire("dt_gravacao", _as_of())})
rule("c16_contact_flags", "discagem", "id_discagem", lambda: {"sim": F.col("fl_discagem_atendida"), "nao": rules.complement("fl_discagem_atendida")})
rule("c17_sender_flags", "mensagem_chat", "id_mensagem", lambda: {
    "cliente": rules.flag_sender("ds_remetente", "CLIENTE"), "operador": rules.flag_sender("ds_remetente", "OPERADOR")})
rule("c18_presence_flag", "jornada_operador", "id_jornada", lambda: {"v": rules.presence_flag("st_presenca")})
rule("c19_active_and_has_flags", "cliente", "id_cliente", lambda: {
    "ativo": rules.flag_active("st_cliente"), "doc": rules.flag_has("nr_documento_mascarado"), "mail": rules.flag_has("ds_email_mascarado"),
    "fone": rules.flag_has("nr_telefone_mascarado")})
rule("c19_active_and_supervisor_flags", "operador", "id_operador", lambda: {
    "ativo": rules.flag_active("st_operador"), "supervisor": rules.flag_has(F.col("id_supervisor").cast("string"))})


@query
def c20_calendar_attributes(lake):
    days = lake.source("orders").select(F.to_date("o_orderdate").alias("dia")).distinct()
    return days.select("dia", *[c.alias(n) for n, c in rules.calendar_attributes("dia").items()])


rule("c21_traffic_light", "metricas_operacionais", "id_metrica", lambda: {
    "alto": rules.traffic_light("nr_nivel_servico", (95, 85)),
    "baixo": rules.traffic_light("nr_taxa_abandono", (5, 10), higher_is_better=False),
    "quatro": rules.traffic_light("nr_nivel_servico", (95, 90, 80), ("A", "B", "C", "D"))})


@query
def c22_pct(lake):
    return lake.source("lineitem").groupBy("l_suppkey").agg(
        rules.pct(F.count(F.when(F.col("l_returnflag") == "R", 1)), F.count(F.lit(1))).alias("pct_r"),
        rules.pct(F.sum("l_linenumber"), F.sum(F.lit(0))).alias("pct_zero"),
    )


# --- keys, lookups, checks -----------------------------------------------------------

@query
def e1_surrogate_key_seq(lake):
    return keys.surrogate_key_seq(lake.source("customer").select("c_custkey"), order=["c_custkey"], name="sk")


@query
def e1_surrogate_key_stable(lake):
    """Customers of the first half keep their keys; the others continue after the greatest."""
    people = lake.source("customer").select("c_custkey", "c_mktsegment")
    known = people.filter("c_mktsegment in ('BUILDING', 'MACHINERY')").select("c_custkey")
    existing = keys.surrogate_key_seq(known, order=["c_custkey"], name="sk")
    return keys.surrogate_key_seq(people, order=["c_custkey"], name="sk", existing=existing)


@query
def e1_key_registry(lake):
    """Three builds on one registry: half of the customers, all of them, all again. The first half keeps its keys."""
    people = lake.source("customer").select("c_custkey", "c_mktsegment")
    registry = keys.KeyRegistry(lake.spark, _fresh(lake, "keys"), "c_custkey bigint")
    first = registry.assign(people.filter("c_mktsegment in ('BUILDING', 'MACHINERY')"), "sk")
    first.write.parquet(_fresh(lake, "first"))
    registry.assign(people, "sk").write.parquet(_fresh(lake, "second"))
    return registry.assign(people, "sk")


@query
def f6_incremental_whatsapp(lake):
    """The WhatsApp fact from two batches of events, each of which rewrites only the dates it touches."""
    root, entity = _fresh(lake, "feed"), "whatsapp_atendimento"
    silver = incremental.PartitionedTable(lake.spark, os.path.join(root, "silver"), ("ano", "mes", "dia"))
    feed = GoldFeed(lake.spark, os.path.join(root, "fact"), "fato_whatsapp", lake, extended=True)
    rows, early = lake.bronze(entity), F.col("_timestamp") < "2024-01-16"
    schema = mark_silver(entity, rows, as_of=AS_OF, tie_break="_seq", extended=True).schema
    checked = MarkedTable(lake.spark, os.path.join(root, "checked"), schema)
    for batch, part in (("1", rows.filter(early)), ("2", rows.filter(~early)), ("2", rows.filter(~early))):
        incremental.merge_batch(entity, part, silver, checked=checked.path, batch_id=batch, as_of=AS_OF, tie_break="_seq", extended=True)
        feed.refresh(silver.read(), checked.valid(batch), batch)
    return feed.read()


@query
def e2_unknown_member(lake):
    rows = lake.source("customer").select(F.col("c_custkey").alias("sk"), F.col("c_name").alias("nm"))
    return keys.unknown_member(rows, {"sk": -1, "nm": rules.UNKNOWN})


@query
def e7_dim_canal(lake):
    """The channel list with the sessions of each channel."""
    facts = [lake[f].select("sk_canal") for f in ("fato_chamada", "fato_chat", "fato_whatsapp")]
    used = reduce(DataFrame.unionByName, facts).groupBy("sk_canal").agg(F.count(F.lit(1)).alias("_n"))
    return lake.plan("dim_canal").join(used, "sk_canal", "left").withColumn(
        "nr_atendimentos", F.coalesce("_n", F.lit(0))
    ).drop("_n")


@query
def e11_dim_data(lake):
    """The calendar with the tickets opened per day."""
    opened = lake["fato_ticket"].groupBy(F.col("sk_data_abertura").alias("sk_data")).agg(F.count(F.lit(1)).alias("_n"))
    return lake.plan("dim_data").join(opened, "sk_data", "left").withColumn(
        "nr_tickets", F.coalesce("_n", F.lit(0))
    ).drop("_n")


@query
def f1_resolve_keys(lake):
    """Calls without a match per dimension role."""
    looks = FACTS["fato_chamada"].lookups()
    roles = [a for look in looks for a in look.take.values()]
    resolved = lookup.resolve_keys(cdc.drop_tombstones(lake["chamada"]), lake, looks)
    return resolved.agg(F.count(F.lit(1)).alias("nr_linhas"), *[F.count(F.when(F.col(a) == -1, 1)).alias(a) for a in roles])


@query
def f2_fact_key(lake):
    rows = lake["fato_discagem"]
    return rows.agg(
        F.count(F.lit(1)).alias("nr_linhas"), F.countDistinct("sk_discagem").alias("nr_chaves"), F.max("sk_discagem").alias("nr_maior")
    )


RELATIONS = [
    ("fato_chamada", "dim_cliente", "sk_cliente", "sk_cliente"),
    ("fato_chamada", "dim_data", "sk_data_inicio", "sk_data"),
    ("fato_ticket", "dim_status_ticket", "sk_status_ticket", "sk_status"),
    ("fato_discagem", "dim_campanha", "sk_campanha", "sk_campanha"),
    ("fato_chamada", "dim_canal", "sk_canal", "sk_canal"),
    ("fato_chamada", "dim_operador", "sk_operador", "sk_operador"),
    ("fato_ticket", "dim_cliente", "sk_cliente", "sk_cliente"),
    # Facts have no unknown member: a review whose call is unknown counts as an orphan.
    ("fato_qualidade", "fato_chamada", "sk_chamada", "sk_chamada"),
]
VIEWS = [
    views.view_calls_month_status, views.view_operators, views.view_quality_month, views.view_tickets_month, views.view_ticket_sla,
    views.view_digital_month, views.view_campaigns, views.view_queue_metrics, views.view_ivr_options,
]


@query
def f14_orphan_check(lake):
    return reduce(
        DataFrame.unionByName,
        [
            quality.orphan_check(lake[f], lake[d], fk=fk, sk=sk).select(F.lit(f"{f}.{fk}").alias("nm_relacao"), "nr_orfaos")
            for f, d, fk, sk in RELATIONS
        ],
    )


@query
def f15_table_counts(lake):
    """Rows of all gold tables and reporting views."""
    lake.require(GOLD)
    return quality.table_counts({**{n: lake[n] for n in GOLD}, **{v.__name__: v(lake) for v in VIEWS}})


@query
def f16_score_distribution(lake):
    return quality.score_distribution(lake["fato_qualidade"], band="ds_faixa_nota", score="nr_nota")
