"""Exploratory statistics in DuckDB SQL."""

from __future__ import annotations

from oracle import flag, pct, rnd

from oracle.kpis import avg, cnt, light

FINALS: dict[str, str] = {}
RELATIONS: dict[str, str] = {}
C = "count(*)"
WEEK = ["DOMINGO", "SEGUNDA", "TERCA", "QUARTA", "QUINTA", "SEXTA", "SABADO"]
MON = ["JANEIRO", "FEVEREIRO", "MARCO", "ABRIL", "MAIO", "JUNHO", "JULHO", "AGOSTO", "SETEMBRO", "OUTUBRO", "NOVEMBRO", "DEZEMBRO"]


def profile(e: str, cols: list[str]) -> str:
    nulls = " + ".join(f"count(*) - count({c})" for c in cols)
    return f"""select '{e}' as nm_tabela, count(*) as nr_linhas, {len(cols)} as nr_colunas, cast({nulls} as bigint) as nr_nulos,
  count(*) - (select count(*) from (select distinct {', '.join(cols)} from bz_{e})) as nr_duplicadas from bz_{e}"""


# Columns of the raw events.
BRONZE = {
    "cliente": [
        "id_cliente", "nm_cliente", "nr_documento", "ds_email", "nr_telefone", "dt_cadastro", "st_cliente",
    ],
    "operador": [
        "id_operador", "nm_operador", "ds_cargo", "ds_email", "dt_admissao", "st_operador", "fl_supervisor",
        "id_supervisor", "ds_equipe",
    ],
    "chamada": [
        "id_chamada", "id_cliente", "id_operador", "id_fila", "nr_telefone_origem", "nr_telefone_destino",
        "dt_inicio", "dt_fim", "nr_duracao_segundos", "st_chamada", "tp_chamada", "nr_espera_segundos",
    ],
    "ticket": [
        "id_ticket", "id_cliente", "id_operador", "ds_titulo", "ds_categoria", "ds_prioridade", "st_ticket",
        "dt_abertura", "dt_resolucao", "nr_tempo_resolucao_horas",
    ],
    "chat": [
        "id_chat", "id_cliente", "id_operador", "id_fila", "dt_inicio", "dt_fim", "nr_duracao_minutos",
        "st_chat", "nr_satisfacao",
    ],
    "campanha": [
        "id_campanha", "nm_campanha", "ds_objetivo", "dt_inicio", "dt_fim", "nr_meta_contatos",
        "nr_contatos_realizados", "nr_conversoes", "fl_ativa",
    ],
    "discagem": [
        "id_discagem", "id_campanha", "id_cliente", "id_operador", "nr_tentativas", "fl_contato_realizado",
        "fl_convertido", "nr_valor_convertido", "nr_custo_discagem", "dt_ultima_tentativa", "st_discagem",
    ],
}
FINALS["j1_profile_tables"] = "\nunion all\n".join(profile(e, c) for e, c in BRONZE.items())
FINALS["j2_null_pct_by_column"] = "\nunion all\n".join(
    f"select '{c}' as nm_coluna, {pct(f'count(*) - count({c})', C)} as pct_nulos, {rnd('100 - ' + pct(f'count(*) - count({c})', C))} as pct_completude from bz_chamada"
    for c in BRONZE["chamada"])


def freq(t: str, by: str, limit: int | None = None, where: str = "true") -> str:
    tail = f" limit {limit}" if limit else ""
    return f"select {by}, {C} as nr_linhas, {pct(C, f'(select count(*) from {t} where {where})')} as pct_total from {t} where {where} group by 1 order by 2 desc, 1{tail}"


FINALS["j3_value_counts_status"] = freq("sv_chamada", "st_chamada")
FINALS["j3_top_states"] = freq("sv_endereco_cliente", "ds_estado", 10)
FINALS["j3_top_options"] = freq("sv_ura_navegacao", "ds_opcao_selecionada", 10)


def slot(t: str, e: str, a: int, b: int) -> str:
    return f"select cast(k as int) as nr_faixa, coalesce(n, 0) as nr_linhas from (select unnest(range({a}, {b + 1})) as k) left join (select {e} as k, count(*) as n from {t} group by 1) using (k)"


FINALS["j4_volume_by_weekday"] = slot("sv_chamada", "dayofweek(dt_inicio) + 1", 1, 7)
FINALS["j4_volume_by_month"] = slot("sv_ticket", "month(dt_abertura)", 1, 12)
FINALS["j4_volume_by_hour"] = slot("sv_ura_navegacao", "hour(dt_navegacao)", 0, 23)
FINALS["j5_pivot_hour_weekday"] = "select cast(hour(dt_inicio) as int) as nr_hora, " + ", ".join(
    f"{cnt(f'dayofweek(dt_inicio) = {i}')} as {d.lower()}" for i, d in enumerate(WEEK)) + " from sv_chamada group by 1"
FINALS["j6_weekly_cumulative"] = """select *, cast(sum(nr_linhas) over (order by dt_semana) as bigint) as nr_acumulado from (select s.dt_semana, coalesce(n, 0) as nr_linhas from
  (select cast(unnest(generate_series(min(w), max(w), interval 7 day)) as date) as dt_semana from (select date_trunc('week', dt_abertura) as w from sv_ticket)) s
  left join (select cast(date_trunc('week', dt_abertura) as date) as dt_semana, count(*) as n from sv_ticket group by 1) c on s.dt_semana = c.dt_semana)"""
STATUS = ["ATENDIDA", "ABANDONADA", "TRANSFERIDA", "ENGAJADA", "DESCONHECIDO"]
FINALS["j7_crosstab_row_pct"] = "select tp_chamada, " + ", ".join(f"""{pct(cnt(f"st_chamada = '{s}'"), C)} as {s.lower()}""" for s in STATUS) + " from sv_chamada group by 1"
HANDLED = "st_chamada = 'ATENDIDA' and nr_duracao_segundos > 0"
D = "nr_duracao_segundos"
FINALS["j8_trim_outliers_p99"] = f"""select tp_chamada, {C} as nr_linhas, {avg(D)} as nr_media, {rnd(f'median({D})')} as nr_mediana, {rnd(f'quantile_cont({D}, 0.95)')} as nr_p95,
  {rnd('max(corte)')} as nr_corte from sv_chamada, (select quantile_cont({D}, 0.99) as corte from sv_chamada where {HANDLED}) where {HANDLED} and {D} <= corte group by 1"""
RELATIONS["x_prod"] = """select p.id_operador, nr_chamadas, coalesce(nm_operador, 'Op ' || p.id_operador) as nm_operador, ds_equipe from (select id_operador, count(*) as nr_chamadas
  from sv_chamada where st_chamada = 'ATENDIDA' group by 1) p left join sv_operador o on o.id_operador = p.id_operador"""
for _n, _l in ((10, "top10"), (15, "top15"), (20, "top20")):
    FINALS[f"j9_{_l}_operators"] = f"select * from x_prod order by nr_chamadas desc, id_operador limit {_n}"
FINALS["j9_bottom10_operators"] = "select * from x_prod order by nr_chamadas, id_operador limit 10"
MES = "cast(month(dt_inicio) as int) as nr_mes"
FINALS["j10_handle_time_vs_goal"] = f"select *, cast(nr_tma <= 180 as smallint) as fl_na_meta from (select {MES}, id_fila, {C} as nr_chamadas, {avg(D)} as nr_tma from sv_chamada where {HANDLED} group by all)"
GONE = cnt("st_chamada = 'ABANDONADA'")
for _k, _by in (("by_queue", "id_fila"), ("by_month", MES), ("global", "")):
    _c = f"{_by}, " if _by else ""
    FINALS[f"j11_abandon_rate_{_k}"] = f"select *, {light('taxa_abandono', 5, 10, False)} as semaforo from (select {_c}{C} as nr_chamadas, {pct(GONE, C)} as taxa_abandono from sv_chamada group by all)"
for _k, _by in (("by_channel", "tp_chamada"), ("by_queue", "id_fila"), ("by_month", MES)):
    FINALS[f"j12_call_sla_20s_{_k}"] = f"""select *, cast(sla_pct >= 80 as smallint) as fl_na_meta from (select {_by}, {C} as nr_atendidas, {pct(cnt('nr_espera_segundos <= 20'), C)} as sla_pct
  from sv_chamada where st_chamada = 'ATENDIDA' group by all)"""
KINDS = ["ENTRADA", "SAIDA"]
FINALS["j13_channel_mix_monthly"] = f"select {MES}, " + ", ".join(
    f"""{cnt(f"tp_chamada = '{k}'")} as nr_{k.lower()}, {pct(cnt(f"tp_chamada = '{k}'"), cnt("tp_chamada in ('ENTRADA', 'SAIDA')"))} as pct_{k.lower()}""" for k in KINDS) + " from sv_chamada group by all"
LIM = "case ds_prioridade when 'URGENTE' then 4 when 'ALTA' then 8 when 'MEDIA' then 24 when 'BAIXA' then 48 end"
RELATIONS["x_sla"] = f"""select ds_prioridade, {LIM} as limite_h, {C} as nr_total, {cnt(f'nr_tempo_resolucao_min <= {LIM} * 60')} as nr_dentro_sla,
  {pct(cnt(f'nr_tempo_resolucao_min <= {LIM} * 60'), C)} as sla_pct from sv_ticket where fl_ticket_resolvido = 1 and {LIM} is not null group by 1, 2"""
FINALS["j14_ticket_sla_by_priority"] = "select * from x_sla"
RELATIONS["x_res"] = """select *, case when id_ticket in (select id_ticket from sv_interacao_ticket where ds_tipo_interacao = 'ESCALONAMENTO') then 1 else 0 end as esc
  from sv_ticket where fl_ticket_resolvido = 1"""
for _k, _by in (("global", ""), ("by_category", "ds_categoria, "), ("by_priority", "ds_prioridade, ")):
    FINALS[f"j15_fcr_{_k}"] = f"select {_by}{C} as nr_tickets, {pct(cnt('esc = 0'), C)} as fcr_pct from x_res group by all"
ANSW = "st_chamada = 'ATENDIDA'"
FINALS["j16_executive_kpis"] = f"""with v as (
  select 'TMA' as nm_kpi, {avg(D, HANDLED)} as nr_valor from sv_chamada union all select 'ABANDONO', {pct(GONE, C)} from sv_chamada
  union all select 'SLA_CHAMADAS', {pct(cnt(ANSW + ' and nr_espera_segundos <= 20'), cnt(ANSW))} from sv_chamada
  union all select 'SLA_TICKETS', {pct('sum(nr_dentro_sla)', 'sum(nr_total)')} from x_sla union all select 'FCR', {pct(cnt('esc = 0'), C)} from x_res
  union all select 'CHAMADAS_DIA', floor(count(*) / 365)::double from sv_chamada)
select *, {flag("case nm_kpi when 'TMA' then nr_valor <= 180 when 'ABANDONO' then nr_valor <= 5 when 'SLA_CHAMADAS' then nr_valor >= 80 when 'SLA_TICKETS' then nr_valor >= 85 when 'FCR' then nr_valor >= 75 else true end")} as fl_meta from v"""
RELATIONS["x_qual"] = f"""select id_operador, {rnd('avg(nr_nota_geral)', 4)} as nota_media, {rnd('stddev_samp(nr_nota_geral)', 4)} as nota_std, count(*) as n_aval
  from sv_avaliacao_qualidade group by 1"""
FINALS["j17_quality_stats"] = "select * from x_qual"
FINALS["j18_correlation"] = f"select {rnd('corr(nr_chamadas, nota_media)', 6)} as correlacao from x_prod join x_qual using (id_operador)"
FINALS["j19_handle_time_stats"] = f"select id_operador, {avg(D)} as tma_medio, {rnd(f'median({D})')} as tma_mediana, {C} as n_chamadas from sv_chamada where {HANDLED} group by 1"
AWAY = cnt("fl_presente = 0")
RELATIONS["x_abs"] = f"select id_operador, {C} as total_dias, {AWAY} as dias_ausente, {pct(AWAY, C)} as pct_ausencia from sv_jornada_operador group by 1"
FINALS["j20_absence_pct"] = "select * from x_abs"
FINALS["j20_absence_weekday"] = "select id_operador, " + ", ".join(
    f"coalesce({pct(cnt(f'dayofweek(dt_jornada) = {i} and fl_presente = 0'), cnt(f'dayofweek(dt_jornada) = {i}'))}, 0) as {WEEK[i].lower()}" for i in range(1, 6)
) + " from sv_jornada_operador where id_operador in (select id_operador from x_abs order by pct_ausencia desc, id_operador limit 20) group by 1"
RELATIONS["x_matrix"] = """select p.*, nota_media, pct_ausencia from x_prod p join x_qual using (id_operador) join x_abs using (id_operador)
  where nm_operador is not null and ds_equipe is not null"""
NORM = lambda c: rnd(f"coalesce(({c} - min({c}) over ())::double / nullif((max({c}) over () - min({c}) over ())::double, 0), 0)", 6)
RELATIONS["x_norm"] = f"select *, {NORM('nr_chamadas')} as prod_norm, {NORM('nota_media')} as qual_norm, {NORM('pct_ausencia')} as aus_norm from x_matrix"
RELATIONS["x_score"] = f"select *, {rnd('least(greatest(0.4e0 * prod_norm + 0.4e0 * qual_norm - 0.2e0 * aus_norm, 0), 1)', 4)} as score_geral from x_norm"
FINALS["j21_minmax_normalize"] = "select * from x_norm"
FINALS["j22_composite_score"] = "select * from x_score"
FINALS["j23_quadrant"] = """select x_score.*, case when prod_norm >= p and qual_norm >= q then 'Estrela' when prod_norm >= p then 'Eficiente' when qual_norm >= q then 'Qualificado' else 'Desenvolvimento' end as quadrante
from x_score, (select median(prod_norm) as p, median(qual_norm) as q from x_score)"""
FINALS["j24_team_summary"] = f"""select ds_equipe, {avg('score_geral')} as score_medio, {avg('nr_chamadas')} as prod_media, {avg('nota_media')} as qual_media, {avg('pct_ausencia')} as abs_media,
  {C} as n_operadores from x_score group by 1"""
FINALS["j25_linear_trend"] = f"select {rnd('regr_slope(nr_conversoes, nr_meta_contatos)', 6)} as inclinacao, {rnd('regr_intercept(nr_conversoes, nr_meta_contatos)', 6)} as intercepto from sv_campanha"
FINALS["j26_contact_conversion_rates"] = f"""select ds_objetivo, {avg('100e0 * nr_contatos_realizados / nullif(nr_meta_contatos, 0)')} as taxa_contato_media,
  {avg('case when nr_contatos_realizados > 0 then 100e0 * nr_conversoes / nr_contatos_realizados else 0 end')} as taxa_conversao_media, {C} as n_campanhas from sv_campanha group by 1"""
CV, AT = "cast(sum(fl_convertido) as bigint)", cnt("st_discagem = 'ATENDIDA'")


def dial(by: str) -> str:
    return f"select {by}, {C} as nr_total, {CV} as nr_convertidas, {AT} as nr_atendidas, {pct(AT, C)} as taxa_contato, {pct(CV, C)} as taxa_conversao from sv_discagem group by all"


FINALS["j27_diminishing_returns"] = dial("nr_tentativas")
RELATIONS["x_eff"] = f"select id_campanha, nm_campanha, ds_objetivo, {rnd('100e0 * nr_conversoes / nullif(nr_meta_contatos, 0)')} as efetividade from sv_campanha"
FINALS["j28_effectiveness_rank"] = "select *, cast(row_number() over (order by efetividade desc nulls last, id_campanha) as int) as nr_rank from x_eff"
FINALS["j28_effectiveness_by_objective"] = f"select ds_objetivo, {avg('efetividade')} as media, {rnd('median(efetividade)')} as mediana, max(efetividade) as maximo from x_eff group by 1"
FINALS["j29_operator_conversion"] = f"""select d.*, nm_operador from (select id_operador, {C} as total_discagens, {CV} as conversoes, {AT} as atendidas, coalesce({pct(CV, AT)}, 0) as taxa_conversao,
  {pct(AT, C)} as taxa_contato from sv_discagem group by 1 having {AT} >= 50 order by taxa_conversao desc, id_operador limit 10) d left join sv_operador using (id_operador)"""
FINALS["j30_dials_by_week"] = dial("cast(date_trunc('week', dt_ultima_tentativa) as date) as dt_semana")
FINALS["j30_dials_by_hour"] = dial("cast(hour(dt_ultima_tentativa) as int) as nr_hora")
FINALS["j30_dials_objective_month"] = "select ds_objetivo, " + ", ".join(
    f"{cnt(f'month(dt_ultima_tentativa) = {i}')} as {m.lower()}" for i, m in enumerate(MON, 1)) + " from sv_discagem left join (select id_campanha, ds_objetivo from sv_campanha) using (id_campanha) group by 1"
FINALS["j31_channel_comparison"] = f"""select 'CHAT' as ds_canal, {C} as nr_volume, {pct(cnt("st_chat = 'ENCERRADO'"), C)} as pct_conclusao, {avg('nr_satisfacao')} as nr_satisfacao, {avg('nr_duracao_minutos')} as nr_duracao_min from sv_chat
union all select 'WHATSAPP', {C}, {pct(cnt("st_atendimento = 'RESOLVIDO'"), C)}, {avg('nr_satisfacao')}, {rnd('median(nr_duracao_minutos) filter (where nr_duracao_minutos > 0)')} from sv_whatsapp_atendimento
union all select 'URA', {C}, {pct(cnt('fl_transferiu_humano = 0'), C)}, null, {rnd('avg(nr_duracao_segundos) / 60e0')} from sv_ura_navegacao"""
FINALS["j32_chat_enrich"] = f"""select id_chat, st_chat, nr_mensagens, msgs_cliente, nr_mensagens - coalesce(msgs_cliente, 0) as msgs_operador, {pct('msgs_cliente', 'nr_mensagens')} as pct_msgs_cliente
from sv_chat left join (select id_chat, {C} as nr_mensagens, {cnt("ds_remetente = 'CLIENTE'")} as msgs_cliente from sv_mensagem_chat group by 1) using (id_chat)"""
RELATIONS["x_sat"] = """select case when nr_satisfacao <= 2 then 'Insatisfeito (1-2)' when nr_satisfacao <= 3 then 'Neutro (3)' when nr_satisfacao <= 4 then 'Satisfeito (4)' else 'Muito Satisfeito (5)' end as ds_faixa
  from sv_whatsapp_atendimento where nr_satisfacao between 0 and 5.1"""
FINALS["j33_satisfaction_bins"] = freq("x_sat", "ds_faixa")
RELATIONS["x_sat_chat"] = RELATIONS["x_sat"].replace("sv_whatsapp_atendimento", "sv_chat")
FINALS["j33_satisfaction_bins_chat"] = freq("x_sat_chat", "ds_faixa")
Q = lambda q: rnd(f"quantile_cont({D}, {q})")
FINALS["j34_duration_box_stats"] = f"""select ds_opcao_selecionada, min({D}) as nr_minimo, {Q(0.25)} as nr_q1, {Q(0.5)} as nr_q2, {Q(0.75)} as nr_q3, max({D}) as nr_maximo from sv_ura_navegacao
where ds_opcao_selecionada in (select ds_opcao_selecionada from sv_ura_navegacao group by 1 order by count(*) desc, 1 limit 5) group by 1"""
FINALS["j34_duration_box_operators"] = f"""select id_operador, min({D}) as nr_minimo, {Q(0.25)} as nr_q1, {Q(0.5)} as nr_q2, {Q(0.75)} as nr_q3, max({D}) as nr_maximo
from sv_chamada group by 1"""
FINALS["j35_self_service_rate"] = f"""select *, cast(taxa_autoatendimento >= 60 as smallint) as fl_na_meta from (select {pct(cnt('fl_transferiu_humano = 0'), C)} as taxa_autoatendimento,
  {pct(cnt('fl_transferiu_humano = 1'), C)} as taxa_transferencia from sv_ura_navegacao)"""
