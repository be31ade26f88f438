"""Scans, change-data operators, column rules and keys in DuckDB SQL."""

from __future__ import annotations

from atende.plans.silver import SPECS
from oracle import AS_OF, flag, pct, rnd, total
from oracle.gold import DOW, HOLIDAY, MON, WEEKEND
from oracle.kpis import avg, cnt, light
from oracle.silver import DECODE, T, big, dbl, dig, low, mail, mins, output_columns, phone, relations_of, secs, ts, up

FINALS: dict[str, str] = {}
RELATIONS: dict[str, str] = {}
C = "count(*)"
UNK = "'DESCONHECIDO'"

# An empty CSV field is NULL.
FINALS["a1_scan_csv_strings"] = "select nullif(columns(* exclude (_seq)), '') from bz_cliente"
FINALS["a2_scan_parquet"] = "select o_orderkey, o_custkey from orders where o_orderdate >= timestamp '1998-01-01'"
FINALS["a3_scan_catalog"] = "select o_orderkey, o_orderstatus from orders"


def land(c: str) -> str:
    d = f"coalesce(try_cast({c} as timestamp), {AS_OF}::timestamp)"
    return f"strftime({d}, '%Y') as ano, strftime({d}, '%m') as mes, strftime({d}, '%d') as dia"


FINALS["a4_derive_date_partitions"] = f"select id_ticket, {land('dt_abertura')} from bz_ticket"
FINALS["a5_write_bronze_partitioned"] = f"select {land('dt_inicio')}, {C} as nr_linhas from bz_chamada group by all"
FINALS["a5_load_tables"] = f"""select 'chamada' as nm_tabela, 'OK' as ds_status, {C} as nr_linhas, 1::smallint as fl_tem_arquivos from bz_chamada
union all select 'ticket', 'OK', {C}, 1::smallint from bz_ticket union all select 'vazia', 'SKIP', 0, 0::smallint"""
EVT = "try_cast(replace(_timestamp, 'T', ' ') as timestamp)"
FINALS["a6_watermark_filter"] = f"""select id_chamada, "Op", _timestamp from bz_chamada where {EVT} > timestamp '2024-01-15 00:00:00'"""
_ID = "try_cast(id_chamada as bigint)"
RELATIONS["bzr_chamada"] = f"select * from bz_chamada where coalesce(((({_ID} % 7) + 7) % 7) not in (3, 5), true)"
FINALS["a6_unreadable_times"] = f"""select 'mesclado' as ds_destino, {C} as nr_linhas from svr_chamada
union all select '_timestamp_ilegivel', {C} from (select distinct * from (select * from bz_chamada except all select * from bzr_chamada))"""
FINALS["a7_watermark_advance"] = f"select max({EVT}) as last_watermark from bz_chamada"
FINALS["a8_incremental_files"] = f"select {', '.join(output_columns('whatsapp_atendimento'))} from sv_whatsapp_atendimento"
FINALS["a9_empty_batch_noop"] = "select (select count(*) from bz_ura_navegacao) as nr_primeira, 0::bigint as nr_segunda, (select count(*) from sv_ura_navegacao) as nr_tabela, 1::int as nr_versao"
FINALS["a10_write_quarantine"] = f"""select motivo as _motivo_quarentena, 2024 as ano_ingestao, 1 as mes_ingestao, 16 as dia_ingestao, {C} as nr_linhas
from qz_chamada where motivo is not null group by 1"""
FINALS["a11_write_table_partitioned"] = f"select ano, mes, dia, {C} as nr_linhas, {total('nr_duracao_segundos')} as nr_segundos from sv_chamada group by all"
FINALS["a12_publish_snapshot"] = "select * from dim_operador"
FINALS["a13_export_csv_for_load"] = f"select {', '.join(T['chat'][3])}, id_fila, nr_satisfacao, dt_cdc_evento, op_cdc, hash_registro, ano, mes, dia from sv_chat"
FINALS["a14_reprocess_partition"] = f"select ano, mes, dia, {C} as nr_linhas from sv_chamada where not (op_cdc = 'DELETE' and ano = 2024 and mes = 1 and dia = 10) group by all"
_SILVER = ["cliente", "endereco_cliente", "operador", "chat", "mensagem_chat"]
_GOLD = ["dim_data", "dim_cliente", "dim_operador", "fato_chat", "fato_mensagem_chat"]
FINALS["a15_layer_entry"] = " union all ".join(
    [f"select 'silver' as nm_camada, '{e}' as nm_tabela, count(*) as nr_linhas from sv_{e}" for e in _SILVER]
    + [f"select 'gold' as nm_camada, '{g}' as nm_tabela, count(*) as nr_linhas from {g}" for g in _GOLD])
FINALS["a15_publish"] = " union all ".join(f"select '{g}' as nm_tabela, count(*) as nr_linhas, 2::int as nr_publicacao from {g}" for g in _GOLD)
REPORT = f"""select date_trunc('month', dt_inicio)::timestamp as mes, {C} as total_chamadas, {avg('nr_duracao_segundos')} as duracao_media,
  {cnt("st_chamada = 'ATENDIDA'")} as resolvidas from sv_chamada where {{}} group by 1"""
FINALS["a16_ctas_monthly_report"] = REPORT.format("true")
FINALS["a16_last_30_days"] = REPORT.format("dt_inicio >= date '2024-02-05' - 30")

FINALS["b1_cdc_decode_op"] = f"select id_chamada, _seq, {DECODE} from bz_chamada"
FINALS["b2_cdc_dedup_latest"] = "select user_id, event_id, event_type, value, ts from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"
FINALS["b2_cdc_dedup_composite"] = "select id_skill, id_operador, nr_nivel, dt_cdc_evento, _seq from lt_skill_operador"
FINALS["b3_safe_cast"] = f"""select {big('id_avaliacao')} as id_avaliacao, {big('id_chamada')} as id_chamada, {dbl('nr_nota_geral')} as nr_nota_geral,
  {ts('dt_avaliacao')} as dt_avaliacao from bz_avaliacao_qualidade"""
FINALS["b4_normalize_text"] = f"""select id_cliente, {up('nm_cliente')} as nm_cliente, lower(trim(ds_email)) as ds_email, {dig('nr_documento')} as nr_documento,
  {dig('nr_telefone', True)} as nr_telefone from bz_cliente"""
FINALS["b5_fill_defaults"] = f"""select id_chamada, _seq, {big('id_operador', -1)} as id_operador, {big('id_fila', -1)} as id_fila, coalesce(st_chamada, {UNK}) as st_chamada,
  coalesce(tp_chamada, {UNK}) as tp_chamada from bz_chamada"""
DOC = dig("nr_documento")
FINALS["b6_mask_document"] = f"select id_cliente, case when length({DOC}) > 0 then left({DOC}, 3) || '*****' || right({DOC}, 2) else '' end as ds_mascara from bz_cliente"
FINALS["b7_mask_email"] = f"select id_cliente, {mail(low('ds_email'))} as ds_mascara from bz_cliente"
FINALS["b8_mask_phone"] = f"select id_cliente, {phone(dig('nr_telefone', True))} as ds_mascara from bz_cliente"
FINALS["b9_mask_postal_code"] = f"select id_endereco, case when length({dig('nr_cep')}) >= 5 then left({dig('nr_cep')}, 5) || '***' else '' end as ds_mascara from bz_endereco_cliente"
FINALS["b10_mask_login"] = f"select id_operador, case when length({low('ds_email')}) > 0 then left({low('ds_email')}, 3) || '***' else '' end as ds_mascara from bz_operador"
FINALS["b11_redact_free_text"] = "select doc_id, cast(length(text) as int) as nr_tamanho, cast(length(text) > 0 as smallint) as fl_tem_texto from documents"
FINALS["b12_row_hash"] = "select o_orderkey, md5(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d'))) as hash_registro from orders"
FINALS["b13_quarantine_split"] = " union all ".join(
    f"select '{e}' as nm_tabela, motivo as _motivo_quarentena, {C} as nr_linhas from qz_{e} where motivo is not null group by all"
    for e in SPECS)
for _i in (0, 1):
    RELATIONS[f"bz{_i}_chamada"] = f"select * from bz_chamada where _seq = {_i}"
    RELATIONS |= relations_of("chamada", f"bz{_i}_chamada", str(_i))
COLS = output_columns("chamada")
RELATIONS |= relations_of("chamada", "bzr_chamada", "r")


def merged(old: int, new: int, take: str) -> str:
    pick = ", ".join(f"case when o.id_chamada is null or (n.id_chamada is not null and ({take})) then n.{c} else o.{c} end as {c}" for c in COLS)
    return f"select {pick} from sv{old}_chamada o full outer join sv{new}_chamada n on o.id_chamada = n.id_chamada"


DIFFERS = "o.hash_registro is distinct from n.hash_registro"
FINALS["b14_merge_upsert_if_changed"] = merged(0, 1, DIFFERS)
FINALS["b14_merge_into_partitions"] = merged(0, 1, DIFFERS)
FINALS["b14_merge_apply_deletes"] = merged(1, 0, f"({DIFFERS} or o.op_cdc <> n.op_cdc) and coalesce(n.dt_cdc_evento >= o.dt_cdc_evento, true)")
FINALS["b15_merge_upsert_all"] = "select o_orderkey, o_custkey, case when o_orderstatus <> 'F' then lower(o_orderstatus) else o_orderstatus end as o_orderstatus, o_totalprice from orders"
FINALS["b16_add_audit_columns"] = "select *, timestamp '2024-01-16 01:00:00' as dt_ingestao_silver from supplier"
FINALS["b17_partition_columns"] = "select id_ticket, cast(year(dt_abertura) as int) as ano, cast(month(dt_abertura) as int) as mes, cast(day(dt_abertura) as int) as dia from sv_ticket"
FINALS["b18_run_metrics"] = "select (select count(*) from bz_chamada) as nr_lidos, count(*) as nr_dedup, count(*) - count(motivo) as nr_validos, count(motivo) as nr_quarentena from qz_chamada"
FINALS["b19_drop_tombstones"] = f"select op_cdc, {C} as nr_linhas from sv_discagem where op_cdc <> 'DELETE' group by 1"
FINALS["b20_schema_project"] = f"select {', '.join(T['campanha'][3])} from sv_campanha"


def rule(name: str, entity: str, key: str, cols: str) -> None:
    FINALS[name] = f"select {key}, {cols} from sv_{entity}"


rule("c1_flag_valid_duration", "chamada", "id_chamada", flag("nr_duracao_segundos > 0 and dt_fim > dt_inicio") + " as v")
rule("c2_flag_complete", "whatsapp_atendimento", "id_whatsapp", flag("dt_inicio is not null and dt_fim is not null") + " as v")
rule("c3_minutes_from_seconds", "chamada", "id_chamada", f"{mins('nr_duracao_segundos')} as v")
rule("c4_duration_seconds", "whatsapp_atendimento", "id_whatsapp", f"cast({secs('dt_inicio', 'dt_fim')} as int) as v")
rule("c5_resolution_minutes", "ticket", "id_ticket", f"{mins(secs('dt_abertura', 'dt_resolucao'))} as v")
rule("c6_flag_resolved", "ticket", "id_ticket", flag("st_ticket in ('FECHADO', 'RESOLVIDO')") + " as v")
rule("c7_flag_within_sla", "ticket", "id_ticket", flag(f"trunc({secs('dt_abertura', 'dt_resolucao')} / 60e0) <= 480") + " as v")
rule("c8_band_score", "avaliacao_qualidade", "id_avaliacao", """case when nr_nota_geral >= 9 then 'EXCELENTE' when nr_nota_geral >= 7 then 'BOM' when nr_nota_geral >= 5 then 'REGULAR'
  when nr_nota_geral >= 3 then 'RUIM' else 'CRITICO' end as v, cast(nr_nota_geral >= 7 as smallint) as ok, cast(nr_nota_geral < 5 as smallint) as mau""")
_D = f"({AS_OF} - dt_admissao)"
rule("c9_band_tenure", "operador", "id_operador", f"""case when {_D} < 90 then 'ATE_3_MESES' when {_D} < 180 then '3_A_6_MESES' when {_D} < 365 then '6_A_12_MESES'
  when {_D} < 730 then '1_A_2_ANOS' else 'ACIMA_2_ANOS' end as v""")
rule("c10_band_skill_level", "skill_operador", "id_operador", "nr_nivel, case when nr_nivel < 1 then 'DESCONHECIDO' when nr_nivel = 1 then 'BASICO' when nr_nivel = 2 then 'INTERMEDIARIO' when nr_nivel = 3 then 'AVANCADO' else 'ESPECIALISTA' end as v")
_S = "nr_duracao_segundos"
rule("c11_band_wait", "ura_navegacao", "id_ura", f"case when {_S} > 120 then 'ACIMA_120S' when {_S} > 60 then '61_A_120S' when {_S} > 30 then '31_A_60S' else 'ATE_30S' end as v")
rule("c12_flag_ivr_abandon", "ura_navegacao", "id_ura", flag("ds_opcao_selecionada = 'ABANDONO'") + " as v")
_N = "(nr_chamadas_atendidas + nr_chamadas_abandonadas)"
rule("c13_service_level", "metricas_operacionais", "id_metrica", f"""case when {_N} > 0 then {rnd(f'nr_chamadas_atendidas * 100e0 / {_N}')} end as v,
  {rnd('100e0 - nr_taxa_abandono')} as presenca, {flag('nr_nivel_servico >= 80')} as meta, {flag('nr_taxa_abandono > 10')} as alto""")
rule("c14_campaign_window", "campanha", "id_campanha", f"cast(dt_fim - dt_inicio as int) as dias, {flag(f'{AS_OF} between dt_inicio and dt_fim')} as vigente, " + flag("st_campanha = 'ATIVA'") + " as ativa")
rule("c15_recording_expiry", "gravacao_chamada", "id_gravacao", f"{flag(f'dt_gravacao < {AS_OF}')} as expirada, cast(dt_gravacao - {AS_OF} as int) as dias")
rule("c16_contact_flags", "discagem", "id_discagem", "fl_discagem_atendida as sim, cast(1 - fl_discagem_atendida as smallint) as nao")
rule("c17_sender_flags", "mensagem_chat", "id_mensagem", flag("ds_remetente = 'CLIENTE'") + " as cliente, " + flag("ds_remetente = 'OPERADOR'") + " as operador")
rule("c18_presence_flag", "jornada_operador", "id_jornada", flag("st_presenca = 'PRESENTE'") + " as v")
rule("c19_active_and_has_flags", "cliente", "id_cliente", flag("st_cliente = 'A'") + " as ativo, " + flag("nr_documento_mascarado <> ''") + " as doc, " + flag("ds_email_mascarado <> ''") + " as mail, " + flag("nr_telefone_mascarado <> ''") + " as fone")
rule("c19_active_and_supervisor_flags", "operador", "id_operador", flag("st_operador = 'A'") + " as ativo, " + flag("length(cast(id_supervisor as varchar)) > 0") + " as supervisor")
FINALS["c20_calendar_attributes"] = f"""select d as dia, cast(year(d) as int) as nr_ano, cast(month(d) as int) as nr_mes, cast(day(d) as int) as nr_dia, cast(quarter(d) as int) as nr_trimestre,
  cast(week(d) as int) as nr_semana_ano, cast(dayofweek(d) + 1 as int) as nr_dia_semana, {DOW} as ds_dia_semana, {MON} as ds_mes, 'Q' || quarter(d) as ds_trimestre,
  {flag(WEEKEND)} as fl_fim_de_semana, {flag(HOLIDAY)} as fl_feriado, {flag(f"not ({WEEKEND} or {HOLIDAY})")} as fl_dia_util
from (select distinct cast(o_orderdate as date) as d from orders)"""
rule("c21_traffic_light", "metricas_operacionais", "id_metrica", f"""{light('nr_nivel_servico', 95, 85)} as alto, {light('nr_taxa_abandono', 5, 10, False)} as baixo,
  case when nr_nivel_servico >= 95 then 'A' when nr_nivel_servico >= 90 then 'B' when nr_nivel_servico >= 80 then 'C' else 'D' end as quatro""")
_R = cnt("l_returnflag = 'R'")
FINALS["c22_pct"] = f"select l_suppkey, {pct(_R, C)} as pct_r, cast(null as double) as pct_zero from lineitem group by 1"

FINALS["e1_surrogate_key_seq"] = "select c_custkey, cast(row_number() over (order by c_custkey) as int) as sk from customer"
FINALS["e1_surrogate_key_stable"] = f"""select c_custkey, c_mktsegment, cast(case when k then row_number() over (partition by k order by c_custkey)
  else (select count(*) from customer where c_mktsegment in ('BUILDING', 'MACHINERY')) + row_number() over (partition by k order by c_custkey) end as int) as sk
from (select *, c_mktsegment in ('BUILDING', 'MACHINERY') as k from customer)"""
FINALS["e1_key_registry"] = FINALS["e1_surrogate_key_stable"].replace("as int) as sk", "as bigint) as sk")
FINALS["f6_incremental_whatsapp"] = "select * from fato_whatsapp"
FINALS["e2_unknown_member"] = f"select c_custkey as sk, c_name as nm from customer union all select -1, {UNK}"
FINALS["e7_dim_canal"] = """select c.*, coalesce(n, 0) as nr_atendimentos from dim_canal c left join (select sk_canal, count(*) as n from
  (select sk_canal from fato_chamada union all select sk_canal from fato_chat union all select sk_canal from fato_whatsapp) group by 1) u using (sk_canal)"""
FINALS["e11_dim_data"] = """select d.*, coalesce(n, 0) as nr_tickets from dim_data d left join (select sk_data_abertura as sk_data, count(*) as n from fato_ticket group by 1) using (sk_data)"""
FINALS["f1_resolve_keys"] = "select count(*) as nr_linhas, " + ", ".join(
    f"{cnt(f'{c} = -1')} as {c}" for c in ("sk_cliente", "sk_operador", "sk_fila", "sk_status_chamada", "sk_data_inicio", "sk_data_fim")) + " from fato_chamada"
FINALS["f2_fact_key"] = "select count(*) as nr_linhas, count(distinct sk_discagem) as nr_chaves, max(sk_discagem) as nr_maior from fato_discagem"
FINALS["f14_orphan_check"] = " union all ".join(
    f"select '{f}.{fk}' as nm_relacao, count(*) as nr_orfaos from {f} where {fk} not in (select {sk} from {d})"
    for f, d, fk, sk in (("fato_chamada", "dim_cliente", "sk_cliente", "sk_cliente"), ("fato_chamada", "dim_data", "sk_data_inicio", "sk_data"),
                         ("fato_ticket", "dim_status_ticket", "sk_status_ticket", "sk_status"), ("fato_discagem", "dim_campanha", "sk_campanha", "sk_campanha"),
                         ("fato_chamada", "dim_canal", "sk_canal", "sk_canal"), ("fato_chamada", "dim_operador", "sk_operador", "sk_operador"),
                         ("fato_ticket", "dim_cliente", "sk_cliente", "sk_cliente"), ("fato_qualidade", "fato_chamada", "sk_chamada", "sk_chamada")))
FINALS["f16_score_distribution"] = f"select ds_faixa_nota, {C} as nr_avaliacoes, {avg('nr_nota')} as nr_nota_media from fato_qualidade group by 1"
