"""KPI families in DuckDB SQL: shared relations and one SELECT per result."""

from __future__ import annotations

import re

from oracle import pct, ratio, rnd, total

MIN_YEAR = 2024
RELATIONS: dict[str, str] = {}
FINALS: dict[str, str] = {}


def avg(x: str, cond: str | None = None) -> str:
    return rnd(f"avg({x})" + (f" filter (where {cond})" if cond else ""))


def cnt(cond: str) -> str:
    return f"count(*) filter (where {cond})"


def light(c: str, a: float, b: float, up: bool = True, labels: tuple[str, ...] = ("VERDE", "AMARELO", "VERMELHO")) -> str:
    o = ">=" if up else "<="
    return f"case when {c} {o} {a} then '{labels[0]}' when {c} {o} {b} then '{labels[1]}' else '{labels[2]}' end"


def rank(order: str, part: str = "") -> str:
    p = f"partition by {part} " if part else ""
    return f"cast(rank() over ({p}order by {order} nulls last) as int)"


def one(cond: str) -> str:
    return f"case when {cond} then 1 else 0 end"


YM = "strftime(dt_completa, '%Y-%m')"
SUM_OK, SUM_GONE, SUM_FULL = total("fl_atendida"), total("fl_abandonada"), total("fl_chamada_completa")
OK = "fl_duracao_valida = 1 and fl_atendida = 1"

# --- calls ---------------------------------------------------------------------------
RELATIONS["k_calls"] = f"""select f.*, d.dt_completa, d.nr_ano, d.nr_mes, d.nr_dia, d.ds_dia_semana, d.fl_fim_de_semana, c.nm_canal as ds_canal,
  q.nm_fila as ds_fila, q.nr_capacidade_max as nr_capacidade_maxima, s.ds_status as ds_status_chamada,
  {one("s.ds_status in ('ATENDIDA', 'COMPLETADA', 'TRANSFERIDA')")} as fl_atendida,
  {one("s.ds_status in ('ABANDONADA', 'ABANDONADA_FILA')")} as fl_abandonada
  from fato_chamada f join dim_data d on f.sk_data_inicio = d.sk_data join dim_canal c on f.sk_canal = c.sk_canal
  join dim_fila q on f.sk_fila = q.sk_fila left join dim_status_chamada s on f.sk_status_chamada = s.sk_status"""
RELATIONS["k1_base"] = f"""select sk_chamada, sk_fila, sk_canal, sk_status_chamada, nr_duracao_segundos, nr_duracao_minutos, fl_duracao_valida,
  fl_chamada_completa, dt_completa, nr_ano, nr_mes, nr_dia, ds_dia_semana, fl_fim_de_semana, ds_canal, ds_fila, ds_status_chamada,
  fl_atendida, fl_abandonada from k_calls where nr_ano >= {MIN_YEAR}"""
FINALS["g1_1_kpi01_base"] = "select * from k1_base"
FINALS["g1_2_kpi01_by_channel"] = f"""select *, {light('pct_taxa_atendimento', 95, 85)} as semaforo_atendimento,
  {light('pct_taxa_abandono', 5, 10, False)} as semaforo_abandono, {light('nr_tma_segundos', 180, 300, False)} as semaforo_tma
from (select dt_completa, nr_ano, nr_mes, nr_dia, ds_dia_semana, fl_fim_de_semana, ds_canal, count(*) as nr_total_chamadas,
  {SUM_OK} as nr_chamadas_atendidas, {SUM_GONE} as nr_chamadas_abandonadas, {pct(SUM_OK, 'count(*)')} as pct_taxa_atendimento,
  {pct(SUM_GONE, 'count(*)')} as pct_taxa_abandono, {avg('nr_duracao_segundos', OK)} as nr_tma_segundos,
  {avg('nr_duracao_minutos', OK)} as nr_tma_minutos, max(nr_duracao_segundos) filter (where fl_duracao_valida = 1) as nr_duracao_max_seg,
  min(nr_duracao_segundos) filter (where {OK}) as nr_duracao_min_seg, {SUM_FULL} as nr_chamadas_completas,
  {pct(SUM_FULL, 'count(*)')} as pct_chamadas_completas from k1_base group by all)
order by dt_completa desc, nr_total_chamadas desc, ds_canal"""
RELATIONS["k1_queue"] = f"""select dt_completa, ds_fila, ds_canal, count(*) as nr_total_chamadas_fila, {SUM_OK} as nr_atendidas_fila,
  {SUM_GONE} as nr_abandonadas_fila, {pct(SUM_OK, 'count(*)')} as pct_atendimento_fila, {pct(SUM_GONE, 'count(*)')} as pct_abandono_fila,
  {avg('nr_duracao_segundos', OK)} as nr_tma_fila_segundos from k1_base group by all"""
FINALS["g1_3_kpi01_by_queue"] = "select * from k1_queue"
FINALS["g1_4_kpi01_queue_rank"] = f"""select *, {rank('nr_total_geral desc')} as rank_volume from (select ds_fila, ds_canal,
  {total('nr_total_chamadas_fila')} as nr_total_geral, {avg('pct_abandono_fila')} as pct_abandono_medio,
  {avg('nr_tma_fila_segundos')} as nr_tma_medio_segundos from k1_queue group by all)"""

# --- operators -----------------------------------------------------------------------
RELATIONS["k2_ops"] = "select sk_operador, nm_operador, ds_faixa_tempo_casa as ds_cargo from dim_operador where fl_operador_ativo = 1"
RELATIONS["k2_calls"] = f"""select f.sk_operador, nr_ano, nr_mes, count(*) as nr_total_chamadas, {cnt('fl_duracao_valida = 1')} as nr_chamadas_validas,
  {avg('nr_duracao_segundos', 'fl_duracao_valida = 1')} as nr_tma_segundos, {avg('nr_duracao_minutos', 'fl_duracao_valida = 1')} as nr_tma_minutos,
  {SUM_FULL} as nr_chamadas_completas, {pct(SUM_FULL, 'count(*)')} as pct_chamadas_completas
  from fato_chamada f join dim_data d on f.sk_data_inicio = d.sk_data join k2_ops o on o.sk_operador = f.sk_operador group by all"""
RELATIONS["k2_quality"] = f"""select sk_operador_avaliado as sk_operador, count(*) as nr_avaliacoes, {avg('nr_nota')} as nr_nota_geral_media,
  {avg('nr_nota_comunicacao')} as nr_nota_comunicacao_media, {avg('nr_nota_resolucao')} as nr_nota_resolucao_media,
  {pct(cnt('nr_nota = 10'), 'count(*)')} as pct_excelentes, {pct(cnt('nr_nota < 6'), 'count(*)')} as pct_criticas
  from fato_qualidade f join k2_ops o on o.sk_operador = f.sk_operador_avaliado group by all"""
PRES = cnt("st_presenca = 'PRESENTE'")
RELATIONS["k2_shifts"] = f"""select f.sk_operador, sum(nr_horas_trabalhadas) as nr_horas_total, {total('nr_chamadas_atendidas')} as nr_chamadas_jornada,
  {total('nr_tickets_resolvidos')} as nr_tickets_resolvidos, {PRES} as nr_dias_presente, count(*) as nr_dias_total,
  {pct(PRES, 'count(*)')} as pct_presenca from fato_jornada_operador f join k2_ops o on o.sk_operador = f.sk_operador group by all"""
Z = lambda c, t="double": f"coalesce({c}, 0)::{t} as {c.split('.')[-1]}"
RELATIONS["k2_all"] = f"""select o.sk_operador, nm_operador, ds_cargo, {Z('nr_total_chamadas', 'bigint')}, {Z('nr_chamadas_validas', 'bigint')},
  {Z('nr_tma_segundos')}, {Z('nr_tma_minutos')}, {Z('pct_chamadas_completas')}, {Z('nr_avaliacoes', 'bigint')}, {Z('nr_nota_geral_media')},
  {Z('nr_nota_comunicacao_media')}, {Z('nr_nota_resolucao_media')}, {Z('pct_excelentes')}, {Z('pct_criticas')},
  coalesce(nr_horas_total, 0)::double as nr_horas_trabalhadas, {Z('pct_presenca')},
  {rnd('coalesce(nr_total_chamadas, 0)::double / nullif(nr_horas_total, 0)')} as nr_calls_por_hora
  from k2_ops o left join (select sk_operador, {total('nr_total_chamadas')} as nr_total_chamadas, {total('nr_chamadas_validas')} as nr_chamadas_validas,
    {avg('nr_tma_segundos')} as nr_tma_segundos, {avg('nr_tma_minutos')} as nr_tma_minutos, {avg('pct_chamadas_completas')} as pct_chamadas_completas
    from k2_calls group by 1) c using (sk_operador) left join k2_quality q using (sk_operador) left join k2_shifts s using (sk_operador)"""
FINALS["g2_1_kpi02_calls_by_operator_month"] = "select * from k2_calls"
FINALS["g2_2_kpi02_quality_by_operator"] = "select * from k2_quality"
FINALS["g2_3_kpi02_attendance"] = "select * from k2_shifts"
FINALS["g2_4_kpi02_consolidated"] = "select * from k2_all"
FINALS["g2_5_kpi02_ranking"] = f"""select * exclude (m_tma, m_nota, nr_chamadas_validas), {rnd('rank_volume * 0.3e0 + rank_qualidade * 0.4e0 + rank_produtividade * 0.3e0')} as score_ranking_composto
from (select *, {pct('nr_tma_segundos - m_tma', 'm_tma')} as pct_desvio_tma, {pct('nr_nota_geral_media - m_nota', 'm_nota')} as pct_desvio_nota,
  {rank('nr_total_chamadas desc')} as rank_volume, {rank('nr_nota_geral_media desc')} as rank_qualidade, {rank('nr_calls_por_hora desc')} as rank_produtividade
  from k2_all, (select avg(nr_tma_segundos) as m_tma, avg(nr_nota_geral_media) as m_nota from k2_all where nr_total_chamadas > 0)
  where nr_total_chamadas > 0) order by rank_qualidade, nr_total_chamadas desc, sk_operador"""

# --- quality -------------------------------------------------------------------------
RELATIONS["k3_base"] = f"""select sk_avaliacao as sk_qualidade, f.sk_chamada, sk_operador_avaliado as sk_operador, sk_avaliador as sk_supervisor,
  nr_nota as nr_nota_geral, nr_nota_comunicacao, nr_nota_resolucao, case when nr_nota < 6 then 'RUIM' when nr_nota between 6 and 7.99 then 'REGULAR'
  when nr_nota between 8 and 9.99 then 'BOM' when nr_nota = 10 then 'EXCELENTE' else 'NAO_CLASSIFICADO' end as ds_banda_qualidade,
  {one('nr_nota >= 7')} as fl_conforme, o.nm_operador, o.ds_faixa_tempo_casa as ds_cargo, nm_supervisor, dt_completa, nr_ano, nr_mes, nr_dia, {YM} as ds_ano_mes
  from fato_qualidade f join dim_operador o on f.sk_operador_avaliado = o.sk_operador and o.fl_operador_ativo = 1
  left join dim_supervisor p on f.sk_avaliador = p.sk_supervisor join fato_chamada c on f.sk_chamada = c.sk_chamada
  join dim_data d on c.sk_data_inicio = d.sk_data"""
B = lambda b: cnt(f"ds_banda_qualidade = '{b}'")
BANDS = ["EXCELENTE", "BOM", "REGULAR", "RUIM"]
CONF = pct(total("fl_conforme"), "count(*)")
FINALS["g3_1_kpi03_base"] = "select * from k3_base"
FINALS["g3_2_kpi03_by_operator"] = f"""select *, {rnd('nr_nota_geral_media - media_equipe_geral')} as desvio_vs_media,
  case when nr_nota_geral_media < media_equipe_geral then 'ABAIXO_DA_MEDIA' else 'NA_MEDIA_OU_ACIMA' end as ds_situacao_vs_media,
  case {' '.join(f"when pct_{b.lower()} >= 50 then 'PREDOMINANTEMENTE_{b}'" for b in BANDS)} else 'MISTO' end as ds_perfil_qualidade,
  {rank('nr_nota_geral_media desc')} as rank_qualidade
from (select sk_operador, nm_operador, ds_cargo, nm_supervisor, count(*) as nr_total_avaliacoes, {avg('nr_nota_geral')} as nr_nota_geral_media,
  {avg('nr_nota_comunicacao')} as nr_nota_comunicacao_media, {avg('nr_nota_resolucao')} as nr_nota_resolucao_media,
  {', '.join(f"{B(b)} as nr_{b.lower()}, {pct(B(b), 'count(*)')} as pct_{b.lower()}" for b in BANDS)}, {CONF} as pct_conformidade,
  min(nr_nota_geral) as nr_nota_minima, max(nr_nota_geral) as nr_nota_maxima from k3_base group by all),
  (select {avg('nr_nota_geral')} as media_equipe_geral from k3_base)
order by nr_nota_geral_media desc, nr_total_avaliacoes desc, sk_operador, nm_supervisor nulls last"""
FINALS["g3_3_kpi03_by_supervisor"] = f"""select nm_supervisor, count(distinct sk_operador) as nr_agentes_equipe, count(*) as nr_total_avaliacoes_equipe,
  {avg('nr_nota_geral')} as nr_nota_media_equipe, {avg('nr_nota_comunicacao')} as nr_nota_comunicacao_equipe, {avg('nr_nota_resolucao')} as nr_nota_resolucao_equipe,
  {CONF} as pct_conformidade_equipe, {B('RUIM')} as nr_avaliacoes_ruins, {pct(B('RUIM'), 'count(*)')} as pct_ruins_equipe
from k3_base where nm_supervisor is not null group by all"""
FINALS["g3_4_kpi03_monthly_trend"] = f"""select ds_ano_mes, nr_ano, nr_mes, count(*) as nr_avaliacoes_mes, {avg('nr_nota_geral')} as nr_nota_media_mes,
  {avg('nr_nota_comunicacao')} as nr_nota_comunicacao_mes, {avg('nr_nota_resolucao')} as nr_nota_resolucao_mes, {CONF} as pct_conformidade_mes,
  {B('EXCELENTE')} as nr_excelente_mes, {B('RUIM')} as nr_ruim_mes from k3_base group by all"""

# --- tickets -------------------------------------------------------------------------
TARGET = "case nm_prioridade when 'ALTA' then 4 when 'MEDIA' then 8 when 'BAIXA' then 24 end"
RELATIONS["k_tickets"] = f"""select f.*, sk_operador_abertura as sk_operador, sk_data_fechamento as sk_data_resolucao,
  {rnd('nr_tempo_resolucao_min / 60e0')} as nr_tempo_resolucao_horas, nm_categoria as ds_categoria_ticket, nm_prioridade as ds_prioridade_ticket,
  ds_status as ds_status_ticket, dt_completa as dt_abertura, nr_ano, nr_mes, nr_dia, {YM} as ds_ano_mes, {TARGET} as alvo,
  {one("ds_status in ('RESOLVIDO', 'FECHADO')")} as fl_resolvido, {one("ds_status in ('ABERTO', 'EM_ATENDIMENTO', 'PENDENTE')")} as fl_em_aberto
  from fato_ticket f join dim_categoria_ticket using (sk_categoria) join dim_prioridade_ticket using (sk_prioridade)
  join dim_status_ticket s on f.sk_status_ticket = s.sk_status join dim_data d on f.sk_data_abertura = d.sk_data"""
IDS = "sk_ticket, sk_operador, sk_categoria, sk_prioridade, sk_status_ticket, sk_data_abertura, sk_data_resolucao, nr_tempo_resolucao_horas, ds_categoria_ticket, ds_prioridade_ticket, ds_status_ticket, dt_abertura"
RELATIONS["k4_base"] = f"""select {IDS}, sk_cliente, nr_ano as nr_ano_abertura, nr_mes as nr_mes_abertura, nr_dia as nr_dia_abertura,
  ds_ano_mes as ds_ano_mes_abertura, alvo as nr_sla_horas_target, {one('nr_tempo_resolucao_min < alvo * 60')} as fl_sla_cumprido, fl_resolvido, fl_em_aberto from k_tickets"""
PR = lambda p: cnt(f"ds_prioridade_ticket = '{p}'")
DONE = "fl_resolvido = 1"
SLA = pct(total("fl_sla_cumprido"), cnt(DONE))
FINALS["g4_1_kpi04_base"] = "select * from k4_base"
FINALS["g4_2_kpi04_daily"] = f"""select *, {pct('nr_tickets_resolvidos', 'nr_tickets_abertos_dia')} as pct_resolucao_dia,
  {', '.join(f"{pct(f'nr_tickets_{p}', 'nr_tickets_abertos_dia')} as pct_{p}_prioridade" for p in ('alta', 'media', 'baixa'))},
  case when nr_tickets_alta > 50 then 'ATENCAO_ALTA_PRIORIDADE' when nr_tickets_alta > 20 then 'MONITORAR' else 'NORMAL' end as ds_alerta_volume
from (select dt_abertura, nr_ano_abertura, nr_mes_abertura, nr_dia_abertura, ds_ano_mes_abertura, count(*) as nr_tickets_abertos_dia,
  {', '.join(f"{PR(p)} as nr_tickets_{p.lower()}" for p in ('ALTA', 'MEDIA', 'BAIXA'))}, {total('fl_resolvido')} as nr_tickets_resolvidos,
  {total('fl_em_aberto')} as nr_tickets_em_aberto from k4_base group by all) order by dt_abertura desc nulls last, nr_tickets_abertos_dia desc"""
FINALS["g4_3_kpi04_sla_by_priority"] = f"""select ds_prioridade_ticket, nr_sla_horas_target, count(*) as nr_total_tickets, {cnt(DONE)} as nr_resolvidos,
  {total('fl_sla_cumprido')} as nr_dentro_sla, {SLA} as pct_sla_cumprido, {cnt(DONE + ' and fl_sla_cumprido = 0')} as nr_fora_sla,
  {avg('nr_tempo_resolucao_horas', DONE)} as nr_tempo_medio_resolucao_horas, max(nr_tempo_resolucao_horas) filter (where {DONE}) as nr_tempo_max_resolucao_horas
from k4_base where ds_prioridade_ticket in ('ALTA', 'MEDIA', 'BAIXA') group by all"""
FINALS["g4_4_kpi04_by_category"] = f"""select *, {rank('nr_total_tickets desc')} as rank_volume_categoria from (select ds_categoria_ticket, count(*) as nr_total_tickets,
  {PR('ALTA')} as nr_alta_prioridade, {cnt(DONE)} as nr_resolvidos, {cnt('fl_em_aberto = 1')} as nr_em_aberto, {avg('nr_tempo_resolucao_horas', DONE)} as nr_mttr_horas,
  {SLA} as pct_sla_categoria from k4_base group by all)"""
FINALS["g4_5_kpi04_status_share"] = f"select ds_status_ticket, count(*) as nr_tickets, {pct('count(*)', '(select count(*) from k4_base)')} as pct_do_total from k4_base group by 1"

MIN = "nr_tempo_resolucao_min"
RELATIONS["k5_base"] = f"""select {IDS}, nr_ano, nr_mes, ds_ano_mes, fl_resolvido, fl_em_aberto, {one("ds_status_ticket = 'ESCALONADO'")} as fl_escalonado,
  {one("fl_resolvido = 1 and ds_status_ticket <> 'ESCALONADO'")} as fl_fcr_candidato, alvo as nr_sla_target_horas,
  case when {MIN} is null then 'NAO_RESOLVIDO' when {MIN} < 60 then 'MENOS_1H' when {MIN} < 240 then '1H_A_4H' when {MIN} < 480 then '4H_A_8H'
  when {MIN} < 1440 then '8H_A_24H' when {MIN} < 4320 then '24H_A_72H' else 'MAIS_72H' end as ds_faixa_resolucao from k_tickets"""
FCR = pct(total("fl_fcr_candidato"), cnt(DONE))
MEAN_H = f"avg(nr_tempo_resolucao_horas) filter (where {DONE})"
RELATIONS["k5_backlog"] = """select ds_prioridade_ticket, ds_categoria_ticket, count(*) as nr_backlog, count(nr_sla_target_horas) as nr_backlog_total_aberto,
  avg(nr_sla_target_horas) as nr_media_horas_em_aberto from k5_base where fl_em_aberto = 1 group by all"""
RELATIONS["k5_global"] = f"""select count(*) as nr_total_resolvidos, {total('fl_fcr_candidato')} as nr_fcr, {FCR} as pct_fcr_global,
  {rnd(MEAN_H)} as nr_mttr_global_horas from k5_base where fl_resolvido = 1"""
FINALS["g5_1_kpi05_base"] = "select * from k5_base"
FINALS["g5_2_kpi05_mttr_category"] = f"""select c.* exclude (media), coalesce(b.nr_backlog, 0)::bigint as nr_backlog_atual, g.pct_fcr_global, g.nr_mttr_global_horas,
  {rnd('nr_mttr_horas - nr_mttr_global_horas')} as desvio_mttr_vs_global, {light('pct_fcr', 80, 65)} as semaforo_fcr
from (select *, {rank('media asc')} as rank_mttr_categoria from (select ds_categoria_ticket, count(*) as nr_total_tickets, {cnt(DONE)} as nr_tickets_resolvidos,
    {rnd(MEAN_H)} as nr_mttr_horas, {rnd(f'{MEAN_H} / 24e0')} as nr_mttr_dias, quantile_disc(coalesce(nr_tempo_resolucao_horas, 0), 0.5) as nr_mttr_mediana_horas,
    quantile_disc(coalesce(nr_tempo_resolucao_horas, 0), 0.9) as nr_mttr_p90_horas, min(nr_tempo_resolucao_horas) filter (where {DONE}) as nr_mttr_minimo,
    max(nr_tempo_resolucao_horas) filter (where {DONE}) as nr_mttr_maximo, {FCR} as pct_fcr, {MEAN_H} as media from k5_base group by 1)) c
left join (select ds_categoria_ticket, sum(nr_backlog) as nr_backlog from k5_backlog group by 1) b using (ds_categoria_ticket) cross join k5_global g
order by nr_mttr_horas desc nulls last, nr_total_tickets desc, ds_categoria_ticket"""
FINALS["g5_3_kpi05_mttr_priority"] = f"""select ds_prioridade_ticket, nr_sla_target_horas, count(*) as nr_total_tickets, {cnt(DONE)} as nr_tickets_resolvidos,
  {rnd(MEAN_H)} as nr_mttr_horas, {rnd(f'{MEAN_H} / nullif(nr_sla_target_horas, 0)')} as nr_ratio_mttr_sla, {FCR} as pct_fcr from k5_base group by ds_prioridade_ticket, nr_sla_target_horas"""
FINALS["g5_4_kpi05_backlog"] = "select * from k5_backlog"
FINALS["g5_5_kpi05_band_share"] = f"""select *, {pct('nr_tickets', 'sum(nr_tickets) over (partition by ds_prioridade_ticket)')} as pct_faixa
from (select ds_faixa_resolucao, ds_prioridade_ticket, count(*) as nr_tickets from k5_base group by all)"""
FINALS["g5_6_kpi05_fcr_global"] = "select * from k5_global"

# --- digital -------------------------------------------------------------------------
DAYC = "dt_completa, nr_ano, nr_mes, nr_dia, ds_dia_semana, fl_fim_de_semana"
SESS = f"sk_cliente, sk_operador, f.sk_canal, nm_canal as ds_canal, {DAYC}, {YM} as ds_ano_mes, nr_duracao_segundos, {rnd('nr_duracao_segundos / 60e0')} as nr_duracao_minutos"
JOIN = "f join dim_canal c on f.sk_canal = c.sk_canal join dim_data d on f.sk_data_inicio = d.sk_data"
RELATIONS["k6_chat"] = f"""select sk_chat, {SESS}, case when nm_canal like '%WHATSAPP%' then 'WHATSAPP' when nm_canal like '%CHAT%' then 'CHAT' else 'OUTRO_DIGITAL' end
  as ds_tipo_canal_digital from fato_chat {JOIN} where nm_canal like '%CHAT%' or nm_canal like '%WHATSAPP%'"""
RELATIONS["k6_wa"] = f"select sk_whatsapp, {SESS}, 'WHATSAPP' as ds_tipo_canal_digital from fato_whatsapp {JOIN}"
RELATIONS["k6_msgs"] = f"""select sk_chat, count(*) as nr_total_mensagens, {cnt("ds_remetente = 'CLIENTE'")} as nr_mensagens_cliente,
  {cnt("ds_remetente = 'OPERADOR'")} as nr_mensagens_agente, cast(null as double) as nr_tempo_medio_resposta_seg from fato_mensagem_chat group by 1"""
K6C = f"ds_canal, ds_tipo_canal_digital, {DAYC}, ds_ano_mes, nr_duracao_segundos, nr_duracao_minutos"
RELATIONS["k6_all"] = f"""select c.sk_chat, {K6C}, coalesce(nr_total_mensagens, 0) as nr_total_mensagens, coalesce(nr_mensagens_cliente, 0) as nr_mensagens_cliente,
  coalesce(nr_mensagens_agente, 0) as nr_mensagens_agente, coalesce(nr_tempo_medio_resposta_seg, 0)::double as nr_tempo_resposta_seg
  from k6_chat c left join k6_msgs m on c.sk_chat = m.sk_chat
  union all select sk_whatsapp, {K6C}, 0, 0, 0, 0 from k6_wa"""
LONG = cnt("nr_duracao_segundos > 1800")
RELATIONS["k6_daily"] = f"""select {DAYC}, ds_ano_mes, ds_tipo_canal_digital, count(*) as nr_total_sessoes, {avg('nr_duracao_minutos')} as nr_duracao_media_minutos,
  {avg('nr_duracao_segundos')} as nr_duracao_media_segundos, max(nr_duracao_segundos) as nr_duracao_maxima_seg,
  {avg('nr_total_mensagens')} as nr_media_mensagens_sessao, {avg('nr_mensagens_cliente')} as nr_media_msg_cliente, {avg('nr_mensagens_agente')} as nr_media_msg_agente,
  {total('nr_total_mensagens')} as nr_total_mensagens_dia, {avg('nr_tempo_resposta_seg', 'nr_tempo_resposta_seg > 0')} as nr_tma_resposta_seg,
  {LONG} as nr_sessoes_longas, {pct(LONG, 'count(*)')} as pct_sessoes_longas from k6_all group by all"""
FINALS["g6_1_kpi06_chat_base"] = "select * from k6_chat"
FINALS["g6_2_kpi06_whatsapp_base"] = "select * from k6_wa"
FINALS["g6_3_kpi06_messages_per_session"] = "select * from k6_msgs"
FINALS["g6_4_kpi06_unified"] = "select * from k6_all"
FINALS["g6_5_kpi06_daily_channel"] = f"""select * exclude (ds_ano_mes), case when nr_total_sessoes > 500 then 'ALTO_VOLUME' when nr_total_sessoes > 200 then 'VOLUME_NORMAL'
  else 'BAIXO_VOLUME' end as ds_classificacao_volume, {ratio('nr_media_mensagens_sessao', 'nr_duracao_media_minutos')} as nr_mensagens_por_minuto
from k6_daily order by dt_completa desc, nr_total_sessoes desc, ds_tipo_canal_digital"""
FINALS["g6_6_kpi06_monthly_trend"] = f"""select ds_ano_mes, nr_ano, nr_mes, ds_tipo_canal_digital, {total('nr_total_sessoes')} as nr_sessoes_mes,
  {avg('nr_duracao_media_minutos')} as nr_duracao_media_mes, {avg('nr_media_mensagens_sessao')} as nr_media_msg_mes from k6_daily group by all"""

NOTE = "nr_nota_satisfacao"
SIDE = "select {k} as sk_chat, sk_cliente, f.sk_operador, f.sk_canal, '{t}' as ds_tipo_canal, nm_canal as ds_canal, nr_satisfacao as nr_nota_satisfacao, dt_completa, nr_ano, nr_mes, {ym} as ds_ano_mes, nm_operador from {f} {j} join dim_operador o on f.sk_operador = o.sk_operador where {c} = 1"
RELATIONS["k7_all"] = SIDE.format(k="sk_chat", t="CHAT", ym=YM, f="fato_chat", j=JOIN, c="fl_chat_completo") + "\n union all " + SIDE.format(
    k="sk_whatsapp", t="WHATSAPP", ym=YM, f="fato_whatsapp", j=JOIN, c="fl_atendimento_completo")
PRO, DET = cnt(f"{NOTE} >= 4"), cnt(f"{NOTE} <= 2")
FINALS["g7_1_kpi07_unified"] = "select * from k7_all"
FINALS["g7_2_kpi07_csat_channel"] = f"""select *, {light('nr_csat_medio', 4, 3, True, ('VERDE_SATISFATORIO', 'AMARELO_ATENCAO', 'VERMELHO_CRITICO'))} as semaforo_csat,
  {light('pct_detratores', 10, 20, False)} as semaforo_detratores from (select ds_tipo_canal, count(*) as nr_avaliacoes, {avg(NOTE)} as nr_csat_medio,
  {', '.join(f"{cnt(f'{NOTE} = {i}')} as nr_nota_{i}, {pct(cnt(f'{NOTE} = {i}'), 'count(*)')} as pct_nota_{i}" for i in range(1, 6))},
  {pct(PRO, 'count(*)')} as pct_promotores, {pct(DET, 'count(*)')} as pct_detratores,
  {rnd(f'100e0 * {PRO} / count(*) - 100e0 * {DET} / count(*)')} as nr_nps_proxy from k7_all group by 1)"""
FINALS["g7_3_kpi07_monthly_trend"] = f"""select *, {rnd('nr_csat_medio_mes - nr_csat_mes_anterior')} as nr_variacao_csat_mom from (select *,
  lag(nr_csat_medio_mes) over (partition by ds_tipo_canal order by nr_ano, nr_mes) as nr_csat_mes_anterior from (select ds_ano_mes, nr_ano, nr_mes, ds_tipo_canal,
  count(*) as nr_avaliacoes_mes, {avg(NOTE)} as nr_csat_medio_mes, {pct(PRO, 'count(*)')} as pct_promotores_mes, {pct(DET, 'count(*)')} as pct_detratores_mes
  from k7_all group by all))"""
FINALS["g7_4_kpi07_by_operator"] = f"""select * exclude (media), {rank('media desc', 'ds_tipo_canal')} as rank_csat_canal from (select sk_operador, nm_operador, ds_tipo_canal,
  count(*) as nr_avaliacoes, {avg(NOTE)} as nr_csat_medio, {pct(PRO, 'count(*)')} as pct_promotores, avg({NOTE}) as media
  from k7_all where nm_operador is not null group by all having count(*) >= 10)"""

# --- campaigns -----------------------------------------------------------------------
RELATIONS["k8_base"] = """select sk_discagem, f.sk_campanha, sk_cliente, nr_tentativas, fl_discagem_atendida as fl_contato_realizado, fl_convertido, nm_campanha,
  ds_objetivo as ds_tipo_campanha, st_campanha as ds_status_campanha, dt_inicio as dt_inicio_campanha, dt_fim as dt_fim_campanha, nr_meta_contatos
  from fato_discagem f join dim_campanha c on f.sk_campanha = c.sk_campanha"""
CON, CONV, TRY = total("fl_contato_realizado"), total("fl_convertido"), total("nr_tentativas")
CAMP = "sk_campanha, nm_campanha, ds_tipo_campanha, ds_status_campanha, dt_inicio_campanha, dt_fim_campanha"
FINALS["g8_1_kpi08_base"] = "select * exclude (ds_tipo_campanha) from k8_base"
FINALS["g8_2_kpi08_campaign"] = f"""select * exclude (rt), {rnd('rank_taxa_contato * 0.35e0 + rank_taxa_conversao * 0.5e0 + rt * 0.15e0')} as score_efetividade_campanha
from (select *, {pct('nr_contatos_realizados', 'nr_meta_contatos')} as pct_atingimento_meta, {rank('pct_taxa_contato desc')} as rank_taxa_contato,
  {rank('pct_taxa_conversao_sobre_contato desc')} as rank_taxa_conversao, {rank('nr_conversoes desc')} as rank_volume_conversao, {rank('nr_media_tentativas asc')} as rt,
  {light('pct_taxa_contato', 50, 30)} as semaforo_contato, {light('pct_taxa_conversao_sobre_contato', 15, 8)} as semaforo_conversao
  from (select {CAMP}, max(nr_meta_contatos) as nr_meta_contatos, count(*) as nr_total_discagens, {CON} as nr_contatos_realizados, {CONV} as nr_conversoes,
    count(*) - {CON} as nr_sem_contato, {CON} - {CONV} as nr_contatos_sem_conversao, {TRY} as nr_total_tentativas, {avg('nr_tentativas')} as nr_media_tentativas,
    {avg('nr_tentativas', 'fl_contato_realizado = 1')} as nr_tentativas_ate_contato, {pct(CON, 'count(*)')} as pct_taxa_contato,
    {pct(CONV, CON)} as pct_taxa_conversao_sobre_contato, {pct(CONV, 'count(*)')} as pct_taxa_conversao_sobre_discagens from k8_base group by all))
order by pct_taxa_conversao_sobre_contato desc nulls last, nr_conversoes desc, sk_campanha"""
FINALS["g8_3_kpi08_client_campaign"] = f"""select *, {rank('nr_conversoes_operador desc', 'sk_campanha')} as rank_conversao_campanha from (select sk_campanha, nm_campanha, sk_cliente,
  count(*) as nr_discagens_operador, {CON} as nr_contatos_operador, {CONV} as nr_conversoes_operador, {pct(CON, 'count(*)')} as pct_contato_operador,
  {pct(CONV, CON)} as pct_conversao_operador, {avg('nr_tentativas')} as nr_media_tentativas_operador from k8_base group by all)"""
FINALS["g8_4_kpi08_attempt_bands"] = f"""select sk_campanha, nm_campanha, case when nr_tentativas = 1 then '1_TENTATIVA' when nr_tentativas = 2 then '2_TENTATIVAS'
  when nr_tentativas between 3 and 5 then '3_A_5_TENTATIVAS' when nr_tentativas > 5 then 'MAIS_DE_5' else 'INDEFINIDO' end as ds_faixa_tentativas,
  count(*) as nr_discagens, {CON} as nr_contatos, {pct(CON, 'count(*)')} as pct_contato_faixa from k8_base group by all"""

GOAL = "max(nr_meta_contatos)"
RELATIONS["k9_all"] = f"""select {CAMP}, ds_situacao_campanha, {GOAL} as nr_meta_contatos, count(*) as nr_total_discagens, {CON} as nr_contatos_realizados, {CONV} as nr_conversoes,
  {TRY} as nr_total_tentativas, {pct(CON, 'count(*)')} as pct_taxa_contato, {pct(CONV, GOAL)} as pct_efetividade_meta, {pct(CONV, CON)} as pct_aproveitamento_contato,
  {ratio(TRY, CONV)} as nr_tentativas_por_conversao, {ratio(TRY, CON)} as nr_tentativas_por_contato, {CONV} - {GOAL} as nr_gap_meta,
  {pct(f'{CONV} - {GOAL}', GOAL)} as pct_superacao_meta
  from (select *, case when ds_status_campanha in ('ATIVA', 'EM_ANDAMENTO', 'RUNNING') then 'ATIVA'
    when ds_status_campanha in ('ENCERRADA', 'FINALIZADA', 'CONCLUIDA', 'INATIVA') then 'ENCERRADA' else 'OUTRO' end as ds_situacao_campanha from k8_base)
  where ds_situacao_campanha <> 'OUTRO' group by all"""
RELATIONS["k9_class"] = f"""select *, case quartil_efetividade when 1 then 'TOP_25_PCT' when 2 then 'SEGUNDO_QUARTIL' when 3 then 'TERCEIRO_QUARTIL' when 4 then 'BOTTOM_25_PCT' end
  as ds_quartil_efetividade from (select sk_campanha, nm_campanha, ds_situacao_campanha, pct_efetividade_meta, nr_conversoes, nr_tentativas_por_conversao,
  {rank('pct_efetividade_meta desc')} as rank_geral_efetividade, {rank('nr_conversoes desc')} as rank_geral_volume, {rank('nr_tentativas_por_conversao asc')} as rank_eficiencia_custo,
  cast(ntile(4) over (order by pct_efetividade_meta desc nulls last, sk_campanha) as int) as quartil_efetividade from k9_all where nr_conversoes > 0)"""
FINALS["g9_1_kpi09_roi"] = f"""select a.*, c.rank_geral_efetividade, c.rank_geral_volume, c.rank_eficiencia_custo, c.quartil_efetividade, c.ds_quartil_efetividade,
  case when a.pct_efetividade_meta >= 100 then 'META_SUPERADA' when a.pct_efetividade_meta >= 80 then 'VERDE' when a.pct_efetividade_meta >= 60 then 'AMARELO' else 'VERMELHO' end as semaforo_efetividade,
  {light('a.nr_tentativas_por_conversao', 5, 10, False, ('EFICIENTE', 'MODERADO', 'INEFICIENTE'))} as ds_eficiencia_operacional
from k9_all a left join k9_class c on a.sk_campanha = c.sk_campanha order by a.pct_efetividade_meta desc nulls last, a.nr_conversoes desc, a.sk_campanha"""
FINALS["g9_2_kpi09_by_situation"] = f"""select ds_situacao_campanha, count(*) as nr_campanhas, {avg('pct_efetividade_meta')} as nr_efetividade_media,
  {avg('pct_aproveitamento_contato')} as nr_aproveitamento_medio, {avg('pct_taxa_contato')} as nr_taxa_contato_media, {avg('nr_tentativas_por_conversao')} as nr_custo_medio_conversao,
  {total('nr_conversoes')} as nr_total_conversoes_grupo, {total('nr_meta_contatos')} as nr_total_meta_grupo, {pct(total('nr_conversoes'), total('nr_meta_contatos'))} as pct_efetividade_grupo
from k9_all group by 1"""
FINALS["g9_3_kpi09_rank_by_type"] = f"""select sk_campanha, nm_campanha, coalesce(ds_tipo_campanha, '') as ds_tipo_campanha, ds_situacao_campanha, nr_conversoes, pct_efetividade_meta,
  pct_aproveitamento_contato, nr_tentativas_por_conversao, {rank('pct_efetividade_meta desc', 'ds_tipo_campanha')} as rank_efetividade_tipo,
  {rank('nr_conversoes desc', 'ds_tipo_campanha')} as rank_volume_tipo from k9_all"""
FINALS["g9_4_kpi09_quartiles"] = "select * from k9_class"

# --- attendance ----------------------------------------------------------------------
RELATIONS["k10_base"] = f"""select sk_jornada, f.sk_operador, f.sk_data, nr_horas_trabalhadas, nr_chamadas_atendidas, nr_tickets_resolvidos, st_presenca, nm_operador,
  ds_faixa_tempo_casa as ds_cargo, {DAYC}, {YM} as ds_ano_mes, case when st_presenca in ('PRESENTE', 'AUSENTE', 'FERIAS', 'AFASTADO', 'FOLGA') then st_presenca else 'OUTRO' end
  as ds_tipo_ocorrencia, {one('fl_fim_de_semana = 0')} as fl_dia_util from fato_jornada_operador f join dim_operador o on f.sk_operador = o.sk_operador and fl_operador_ativo = 1
  join dim_data d on f.sk_data = d.sk_data"""
T10 = lambda k: cnt(f"ds_tipo_ocorrencia = '{k}'")
W = "filter (where ds_tipo_ocorrencia = 'PRESENTE')"
UTIL = cnt("fl_dia_util = 1")
HRS = f"sum(nr_horas_trabalhadas) {W}"
CALLS, TIX = f"cast(sum(nr_chamadas_atendidas) {W} as bigint)", f"cast(sum(nr_tickets_resolvidos) {W} as bigint)"
RELATIONS["k10_people"] = f"""select sk_operador, nm_operador, ds_cargo, count(*) as nr_dias_registrados, {UTIL} as nr_dias_uteis,
  {', '.join(f"{T10(k)} as nr_dias_{k.lower()}" for k in ('PRESENTE', 'AUSENTE', 'FERIAS', 'AFASTADO', 'FOLGA'))}, {pct(T10('PRESENTE'), UTIL)} as pct_taxa_presenca,
  {pct(T10('AUSENTE'), UTIL)} as pct_taxa_absenteismo, {rnd(HRS)} as nr_horas_totais, {CALLS} as nr_chamadas_totais, {TIX} as nr_tickets_totais,
  {ratio(CALLS, HRS)} as nr_chamadas_por_hora, {ratio(TIX, HRS)} as nr_tickets_por_hora, {ratio(HRS, T10('PRESENTE'))} as nr_horas_medias_por_dia from k10_base group by all"""
FINALS["g10_1_kpi10_base"] = "select * from k10_base"
FINALS["g10_2_kpi10_attendance"] = f"""select *, {rnd('pct_taxa_presenca - media_presenca_equipe')} as desvio_presenca_vs_media,
  {rnd('nr_chamadas_por_hora - media_calls_hora_equipe')} as desvio_produtividade_vs_media, {rank('pct_taxa_presenca desc')} as rank_presenca,
  {rank('pct_taxa_absenteismo asc')} as rank_menor_absenteismo, {rank('nr_chamadas_por_hora desc')} as rank_produtividade_hora,
  {light('pct_taxa_absenteismo', 5, 10, False)} as semaforo_absenteismo, case when nr_chamadas_por_hora >= media_calls_hora_equipe * 1.1e0 then 'ACIMA_DA_MEDIA'
  when nr_chamadas_por_hora >= media_calls_hora_equipe * 0.9e0 then 'NA_MEDIA' else 'ABAIXO_DA_MEDIA' end as ds_situacao_produtividade
from k10_people, (select {avg('pct_taxa_presenca')} as media_presenca_equipe, {avg('pct_taxa_absenteismo')} as media_absenteismo_equipe,
  {avg('nr_chamadas_por_hora')} as media_calls_hora_equipe from k10_people)
order by pct_taxa_absenteismo desc nulls last, nr_chamadas_por_hora desc nulls last, sk_operador"""
FINALS["g10_3_kpi10_monthly"] = f"""select sk_operador, nm_operador, ds_ano_mes, nr_ano, nr_mes, {UTIL} as nr_dias_uteis_mes, {T10('PRESENTE')} as nr_presente_mes,
  {T10('AUSENTE')} as nr_ausente_mes, {pct(T10('AUSENTE'), UTIL)} as pct_absenteismo_mes, {rnd(HRS)} as nr_horas_mes, {CALLS} as nr_chamadas_mes from k10_base group by all"""
FINALS["g10_4_kpi10_absence_weekday"] = f"""select ds_dia_semana, {T10('AUSENTE')} as nr_ausencias, count(*) as nr_registros_dia,
  {pct(T10('AUSENTE'), 'count(*)')} as pct_ausencia_dia_semana from k10_base where fl_dia_util = 1 group by 1"""

# --- queues --------------------------------------------------------------------------
H = "coalesce(nr_hora_inicio, 0)"
RELATIONS["k11_base"] = f"""select sk_chamada, sk_fila, sk_canal, sk_data_inicio, nr_duracao_segundos, fl_chamada_completa, fl_duracao_valida, ds_fila, nr_capacidade_maxima, ds_canal,
  {DAYC}, {YM} as ds_ano_mes, nr_hora_inicio, case when {H} between 6 and 11 then 'MANHA' when {H} between 12 and 17 then 'TARDE' when {H} between 18 and 21 then 'NOITE'
  else 'MADRUGADA' end as ds_turno, ds_status_chamada, fl_atendida, fl_abandonada from k_calls"""
RELATIONS["k11_daily"] = f"""select {DAYC}, sk_fila, ds_fila, ds_canal, max(nr_capacidade_maxima) as nr_capacidade_maxima, count(*) as nr_chamadas_recebidas, {SUM_OK} as nr_chamadas_atendidas,
  {SUM_GONE} as nr_chamadas_abandonadas, {pct('count(*)', 'max(nr_capacidade_maxima) * 8')} as pct_ocupacao_fila, {pct(SUM_OK, 'count(*)')} as pct_taxa_atendimento,
  {avg('nr_duracao_segundos', OK)} as nr_tma_segundos from k11_base group by all"""
RELATIONS["k11_hours"] = f"""select *, {pct('nr_chamadas_hora', 'sum(nr_chamadas_hora) over (partition by ds_fila)')} as pct_volume_hora_vs_total,
  {rank('nr_chamadas_hora desc', 'ds_fila')} as rank_horario_volume from (select ds_fila, ds_canal, nr_hora_inicio, ds_turno, count(*) as nr_chamadas_hora,
  {SUM_OK} as nr_atendidas_hora, {SUM_GONE} as nr_abandonadas_hora, {avg('nr_duracao_segundos')} as nr_duracao_media_hora from k11_base group by all)"""
RELATIONS["k11_over"] = f"""select * exclude (m), {rank('m desc')} as rank_sobrecarga from (select sk_fila, ds_fila, ds_canal, {avg('nr_chamadas_recebidas')} as nr_media_chamadas_dia,
  {avg('pct_ocupacao_fila')} as nr_ocupacao_media, max(pct_ocupacao_fila) as nr_ocupacao_maxima, min(pct_ocupacao_fila) as nr_ocupacao_minima,
  {avg('pct_taxa_atendimento')} as nr_atendimento_medio, {avg('nr_tma_segundos')} as nr_tma_medio, {cnt('pct_ocupacao_fila > 85')} as nr_dias_sobrecarga_critica,
  {rnd('avg(pct_ocupacao_fila)', 9)} as m from k11_daily group by all)"""
PEAKC = "ds_fila, nr_hora_inicio, ds_turno, nr_chamadas_hora, pct_volume_hora_vs_total, rank_horario_volume"
FINALS["g11_1_kpi11_base"] = "select * from k11_base"
FINALS["g11_2_kpi11_daily_occupancy"] = f"""select d.* exclude (sk_fila), o.rank_sobrecarga, o.nr_ocupacao_media, o.nr_dias_sobrecarga_critica, p.nr_hora_inicio as nr_hora_pico,
  p.ds_turno as ds_turno_pico, p.nr_chamadas_hora as nr_chamadas_hora_pico, p.pct_volume_hora_vs_total as pct_volume_hora_pico,
  case when pct_ocupacao_fila > 100 then 'SATURADA' when pct_ocupacao_fila > 85 then 'SOBRECARGA_CRITICA' when pct_ocupacao_fila > 70 then 'ATENCAO' else 'NORMAL' end as ds_situacao_ocupacao,
  {light('d.pct_taxa_atendimento', 95, 85)} as semaforo_atendimento
from k11_daily d left join k11_over o on d.sk_fila = o.sk_fila left join (select * from k11_hours where rank_horario_volume = 1
  qualify row_number() over (partition by ds_fila order by nr_hora_inicio nulls first, ds_turno) = 1) p on d.ds_fila = p.ds_fila
order by dt_completa desc nulls last, pct_ocupacao_fila desc nulls last, d.sk_fila, d.ds_canal"""
FINALS["g11_2_kpi11_daily_occupancy_ties"] = re.sub(r"\s+qualify row_number.*?= 1\)", ")", FINALS["g11_2_kpi11_daily_occupancy"])
FINALS["g11_3_kpi11_intraday"] = "select * from k11_hours"
FINALS["g11_4_kpi11_overload_rank"] = "select * from k11_over"
FINALS["g11_5_kpi11_weekly_pattern"] = f"""select ds_dia_semana, ds_fila, {avg('nr_chamadas_recebidas')} as nr_media_chamadas, {avg('pct_ocupacao_fila')} as nr_ocupacao_media_semana,
  {avg('pct_taxa_atendimento')} as nr_atendimento_medio_semana from k11_daily group by all"""
FINALS["g11_6_kpi11_peak_hour"] = f"select {PEAKC} from k11_hours where rank_horario_volume = 1"

# --- voice menu ----------------------------------------------------------------------
RELATIONS["k12_base"] = f"""select sk_ura as sk_ura_navegacao, sk_chamada, f.sk_data, ds_opcao_selecionada as ds_fluxo_ura, ds_opcao_selecionada, nr_tentativas as nr_nivel_menu,
  nr_duracao_segundos as nr_tempo_navegacao_segundos, fl_transferiu_humano, {one('fl_abandonou_ura = 0')} as fl_autoatendimento_concluido, fl_abandonou_ura as fl_abandono_ura,
  case fl_abandonou_ura when 0 then 'AUTO_ATENDIDO' when 1 then 'ABANDONO_URA' else 'OUTRO' end as ds_resultado_ura, dt_completa, nr_ano, nr_mes, nr_dia, ds_dia_semana, {YM} as ds_ano_mes
  from fato_ura_navegacao f join dim_data d on f.sk_data = d.sk_data"""
SOLVED, MOVED, GONE = cnt("fl_autoatendimento_concluido = 1"), cnt("fl_transferiu_humano = 1"), cnt("fl_abandono_ura = 1")
SEC = "nr_tempo_navegacao_segundos"
RELATIONS["k12_total"] = f"""select count(*) as nr_total_sessoes, {pct(SOLVED, 'count(*)')} as pct_autoatendimento_global, {pct(GONE, 'count(*)')} as pct_abandono_global,
  {avg(SEC)} as nr_tempo_medio_global_seg from k12_base"""
FINALS["g12_1_kpi12_base"] = "select * from k12_base"
FINALS["g12_2_kpi12_daily"] = f"""select a.*, g.* exclude (nr_total_sessoes), {rnd('pct_taxa_autoatendimento - pct_autoatendimento_global')} as desvio_autoatendimento_vs_global,
  case when pct_taxa_autoatendimento >= 50 then 'VERDE_EXCELENTE' when pct_taxa_autoatendimento >= 35 then 'VERDE' when pct_taxa_autoatendimento >= 20 then 'AMARELO' else 'VERMELHO_CRITICO' end as semaforo_autoatendimento,
  {light('pct_abandono_ura', 5, 10, False)} as semaforo_abandono, case when nr_tempo_medio_navegacao_seg <= 60 then 'RAPIDO' when nr_tempo_medio_navegacao_seg <= 120 then 'NORMAL'
  when nr_tempo_medio_navegacao_seg <= 180 then 'LENTO' else 'MUITO_LENTO' end as ds_classificacao_tempo
from (select dt_completa, nr_ano, nr_mes, nr_dia, ds_ano_mes, count(*) as nr_total_sessoes_ura, {SOLVED} as nr_auto_atendidos, {MOVED} as nr_transferidos_humano, {GONE} as nr_abandonos_ura,
  {pct(SOLVED, 'count(*)')} as pct_taxa_autoatendimento, {pct(MOVED, 'count(*)')} as pct_transferencia_humano, {pct(GONE, 'count(*)')} as pct_abandono_ura, {avg(SEC)} as nr_tempo_medio_navegacao_seg,
  {rnd(f'avg({SEC}) / 60e0')} as nr_tempo_medio_navegacao_min, {avg('nr_nivel_menu')} as nr_nivel_medio_menu, max({SEC}) as nr_tempo_max_navegacao_seg from k12_base group by all) a, k12_total g
order by dt_completa desc, nr_total_sessoes_ura desc"""
FINALS["g12_3_kpi12_top_flows"] = f"""select *, {rank('nr_acessos desc')} as rank_acesso from (select ds_fluxo_ura, ds_opcao_selecionada, count(*) as nr_acessos,
  {pct('count(*)', '(select count(*) from k12_base)')} as pct_acessos_total, {pct(SOLVED, 'count(*)')} as pct_autoatendimento_fluxo, {pct(GONE, 'count(*)')} as pct_abandono_fluxo,
  {pct(MOVED, 'count(*)')} as pct_transferencia_fluxo, {avg(SEC)} as nr_tempo_medio_seg from k12_base group by all)"""
FINALS["g12_4_kpi12_abandon_points"] = f"""select * exclude (r), {rank('r desc')} as rank_abandono from (select ds_fluxo_ura, ds_opcao_selecionada, nr_nivel_menu, count(*) as nr_total_chegadas,
  {GONE} as nr_abandonos, {pct(GONE, 'count(*)')} as pct_abandono_ponto, 100e0 * {GONE} / count(*) as r from k12_base group by all having count(*) >= 10)"""
FINALS["g12_5_kpi12_monthly_trend"] = f"""select *, lag(pct_autoatendimento_mes) over (order by nr_ano, nr_mes) as pct_autoatendimento_mes_anterior from (select ds_ano_mes, nr_ano, nr_mes,
  count(*) as nr_sessoes_mes, {pct(SOLVED, 'count(*)')} as pct_autoatendimento_mes, {pct(GONE, 'count(*)')} as pct_abandono_mes, {avg(SEC)} as nr_tempo_medio_mes_seg from k12_base group by all)"""
FINALS["g12_6_kpi12_global"] = "select * from k12_total"
