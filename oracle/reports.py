"""Reporting views and dashboard datasets in DuckDB SQL."""

from __future__ import annotations

from oracle import pct, ratio, rnd, total
from oracle.kpis import MIN_YEAR, OK, SUM_FULL, SUM_GONE, SUM_OK, avg, light

FINALS: dict[str, str] = {}
C = "count(*)"
FINALS["h1_view_calls_month_status"] = f"""select nr_ano, nr_mes, ds_mes, ds_status, {C} as nr_total_chamadas, {SUM_FULL} as nr_chamadas_completas,
  {avg('nr_duracao_minutos')} as nr_tma_medio_minutos, {pct(SUM_FULL, C)} as pct_taxa_atendimento
from fato_chamada f join dim_data d on f.sk_data_inicio = d.sk_data join dim_status_chamada s on f.sk_status_chamada = s.sk_status group by all"""
FINALS["h2_view_operators"] = f"""select nm_operador, ds_faixa_tempo_casa, fl_operador_ativo, {C} as nr_chamadas_atendidas, {avg('nr_duracao_minutos')} as nr_tma_medio,
  {pct(SUM_FULL, C)} as pct_conclusao from fato_chamada join dim_operador using (sk_operador) group by all"""
APR = total("fl_aprovado")
FINALS["h3_view_quality_month"] = f"""select nm_operador, nr_ano, nr_mes, {C} as nr_avaliacoes, {avg('nr_nota')} as nr_nota_media, {APR} as nr_aprovados,
  {total('fl_critico')} as nr_criticos, {pct(APR, C)} as pct_aprovacao from fato_qualidade f join dim_operador o on f.sk_operador_avaliado = o.sk_operador
  join dim_data d on f.sk_data = d.sk_data group by all"""
FINALS["h4_view_tickets_month"] = f"""select nr_ano, nr_mes, ds_status, nm_categoria, nm_prioridade, {C} as nr_total_tickets, {total('f.fl_ticket_resolvido')} as nr_resolvidos,
  {total('fl_dentro_sla')} as nr_dentro_sla from fato_ticket f join dim_data d on f.sk_data_abertura = d.sk_data join dim_status_ticket s on f.sk_status_ticket = s.sk_status
  join dim_categoria_ticket using (sk_categoria) join dim_prioridade_ticket using (sk_prioridade) group by all"""
FINALS["h5_view_ticket_sla"] = f"""select nr_ano, nr_mes, nm_prioridade, {avg('nr_tempo_resolucao_min')} as nr_trt_medio_minutos, {rnd('avg(nr_tempo_resolucao_min) / 60e0')} as nr_trt_medio_horas,
  {pct(total('fl_dentro_sla'), C)} as pct_sla_cumprido from fato_ticket f join dim_data d on f.sk_data_abertura = d.sk_data
  join dim_prioridade_ticket using (sk_prioridade) where fl_ticket_resolvido = 1 group by all"""
FINALS["h6_view_digital_month"] = " union all ".join(
    f"""select nr_ano, nr_mes, '{k}' as ds_canal, {C} as nr_atendimentos, {avg('nr_duracao_minutos')} as nr_duracao_media, {total(c)} as nr_completos
from {f} f join dim_data d on f.sk_data_inicio = d.sk_data group by all"""
    for k, f, c in (("CHAT", "fato_chat", "fl_chat_completo"), ("WHATSAPP", "fato_whatsapp", "fl_atendimento_completo")))
ANS = total("fl_discagem_atendida")
FINALS["h7_view_campaigns"] = f"""select nm_campanha, coalesce(cast(dt_inicio as varchar), 'N/A') as dt_inicio, coalesce(cast(dt_fim as varchar), 'N/A') as dt_fim, fl_campanha_ativa,
  {C} as nr_total_discagens, {ANS} as nr_atendidas, {pct(ANS, C)} as pct_taxa_atendimento from fato_discagem join dim_campanha using (sk_campanha)
group by nm_campanha, dim_campanha.dt_inicio, dim_campanha.dt_fim, fl_campanha_ativa"""
FINALS["h8_view_queue_metrics"] = f"""select nm_fila, ds_tipo_canal, nr_ano, nr_mes, {total('nr_chamadas_recebidas')} as nr_chamadas_recebidas, {total('nr_chamadas_atendidas')} as nr_chamadas_atendidas,
  {avg('nr_nivel_servico')} as nr_nivel_servico_medio, {avg('nr_tma_minutos')} as nr_tma_medio, {avg('nr_tme_minutos')} as nr_tme_medio,
  {avg('nr_taxa_abandono')} as nr_taxa_abandono_media from fato_metricas_operacionais f join dim_fila using (sk_fila) join dim_data d on f.sk_data = d.sk_data group by all"""
ABA = total("fl_abandonou_ura")
FINALS["h9_view_ivr_options"] = f"""select nr_ano, nr_mes, ds_opcao_selecionada, {C} as nr_navegacoes, {ABA} as nr_abandonos, {rnd('avg(nr_duracao_segundos)', 0)} as nr_duracao_media_segundos,
  {pct(ABA, C)} as pct_abandono from fato_ura_navegacao f join dim_data d on f.sk_data = d.sk_data group by all"""

FINALS["i1_dataset_calls"] = f"""select *, {light('pct_taxa_atendimento', 95, 85)} as semaforo_atendimento from (select dt_completa, nr_ano, nr_mes, nr_dia, ds_dia_semana, fl_fim_de_semana,
  ds_canal, ds_fila, ds_status_chamada, {C} as nr_total_chamadas, {SUM_OK} as nr_chamadas_atendidas, {SUM_GONE} as nr_chamadas_abandonadas, {avg('nr_duracao_segundos', OK)} as nr_tma_segundos,
  {avg('nr_duracao_minutos', OK)} as nr_tma_minutos, {pct(SUM_OK, C)} as pct_taxa_atendimento, {pct(SUM_GONE, C)} as pct_taxa_abandono
  from k_calls where nr_ano >= {MIN_YEAR} group by all)"""
OPS = f"""from k_calls f join dim_operador o on f.sk_operador = o.sk_operador and o.fl_operador_ativo = 1"""
OPC = "nm_operador, ds_equipe, ds_faixa_tempo_casa, fl_operador_ativo, dt_completa, nr_ano, nr_mes, ds_canal, ds_fila"
FINALS["i2_dataset_operators"] = f"""select {OPC}, {C} as nr_chamadas, {avg('nr_duracao_segundos', 'fl_duracao_valida = 1')} as nr_tma_segundos,
  {avg('nr_nota')} as nr_nota_qualidade_media, count(distinct sk_avaliacao) as nr_avaliacoes
{OPS} left join fato_qualidade q on q.sk_operador_avaliado = f.sk_operador and q.sk_data = f.sk_data_inicio where nr_ano >= {MIN_YEAR} group by all"""
FINALS["i2_dataset_operators_once"] = f"""select {OPC}, {total('1')} as nr_chamadas, {avg('nr_duracao_segundos', 'fl_duracao_valida = 1')} as nr_tma_segundos,
  any_value({rnd('notas / n')}) as nr_nota_qualidade_media, cast(coalesce(any_value(n), 0) as bigint) as nr_avaliacoes
{OPS} left join (select sk_operador_avaliado as op, sk_data as dia, sum(nr_nota) as notas, count(*) as n from fato_qualidade group by all) q
on op = f.sk_operador and dia = f.sk_data_inicio where nr_ano >= {MIN_YEAR} group by all"""
FINALS["i3_dataset_tickets"] = f"""select *, {light('pct_sla_cumprido', 90, 75)} as semaforo_sla from (select dt_completa as dt_abertura, nr_ano, nr_mes, ds_dia_semana, 'EMAIL' as ds_canal,
  ds_status as ds_status_ticket, nm_operador, ds_equipe, {C} as nr_total_tickets, {avg('nr_tempo_resolucao_min')} as nr_tma_resolucao_min,
  {rnd('avg(nr_tempo_resolucao_min) / 60e0')} as nr_tma_resolucao_horas, {total('fl_dentro_sla')} as nr_tickets_sla_ok, {pct(total('fl_dentro_sla'), C)} as pct_sla_cumprido
  from fato_ticket f join dim_data d on f.sk_data_abertura = d.sk_data left join dim_status_ticket s on f.sk_status_ticket = s.sk_status
  left join dim_operador o on f.sk_operador_abertura = o.sk_operador where nr_ano >= 1995 group by all)"""


def _side(kind: str, table: str, queue: str, done: str) -> str:
    r = f"count(*) filter (where {done})"
    return f"""select dt_completa, nr_ano, nr_mes, ds_dia_semana, '{kind}' as ds_tipo_digital, {queue} as ds_fila, nm_operador, {C} as nr_total_interacoes,
  {avg('nr_duracao_minutos')} as nr_duracao_media_min, {r} as nr_resolvidos, {pct(r, C)} as pct_resolucao
from {table} f join dim_data d on f.sk_data_inicio = d.sk_data left join dim_operador o on f.sk_operador = o.sk_operador
{'left join dim_fila q on f.id_fila = q.nk_fila' if queue == 'nm_fila' else ''} where nr_ano >= {MIN_YEAR} group by all"""


FINALS["i4_dataset_digital"] = _side("CHAT", "fato_chat", "nm_fila", "st_chat = 'ENCERRADO'") + "\nunion all\n" + _side(
    "WHATSAPP", "fato_whatsapp", "cast(null as varchar)", "st_atendimento = 'RESOLVIDO'")
CV = total("fl_convertido")
VAL = "sum(case when fl_convertido = 1 then nr_valor_convertido else 0 end)"
FINALS["i5_dataset_campaign_roi"] = f"""select dt_completa, nr_ano, nr_mes, ds_dia_semana, 'TELEFONE' as ds_canal, ds_objetivo, {C} as nr_total_discagens, {ANS} as nr_discagens_atendidas,
  {pct(ANS, C)} as pct_taxa_atendimento_discagem, {CV} as nr_conversoes, {pct(CV, ANS)} as pct_taxa_conversao, {rnd(VAL)} as nr_valor_total_convertido,
  {rnd('avg(nr_custo_discagem)', 4)} as nr_custo_medio_discagem, {ratio(VAL, 'sum(nr_custo_discagem)')} as nr_roi_campanha
from fato_discagem f join dim_data d on f.sk_data = d.sk_data join dim_campanha c on f.sk_campanha = c.sk_campanha where nr_ano >= 1995 group by all"""
