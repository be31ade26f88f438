"""Reporting views over the star schema: inner joins and one aggregation each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import half_up, pct
from atende.operators.lookup import with_dim
from atende.plans.kpi.common import mean, n, with_day

MONTH = ["nr_ano", "nr_mes"]


def view_calls_month_status(t) -> DataFrame:
    f = with_day(t["fato_chamada"], t, "sk_data_inicio", [*MONTH, "ds_mes"])
    f = with_dim(f, t["dim_status_chamada"], fk="sk_status_chamada", sk="sk_status", take=["ds_status"])
    return f.groupBy(*MONTH, "ds_mes", "ds_status").agg(
        n("sk_chamada").alias("nr_total_chamadas"),
        F.sum("fl_chamada_completa").alias("nr_chamadas_completas"),
        mean("nr_duracao_minutos").alias("nr_tma_medio_minutos"),
        pct(F.sum("fl_chamada_completa"), n("sk_chamada")).alias("pct_taxa_atendimento"),
    )


def view_operators(t) -> DataFrame:
    who = ["nm_operador", "ds_faixa_tempo_casa", "fl_operador_ativo"]
    f = with_dim(t["fato_chamada"], t["dim_operador"], fk="sk_operador", sk="sk_operador", take=who)
    return f.groupBy(*who).agg(
        n("sk_chamada").alias("nr_chamadas_atendidas"),
        mean("nr_duracao_minutos").alias("nr_tma_medio"),
        pct(F.sum("fl_chamada_completa"), n("sk_chamada")).alias("pct_conclusao"),
    )


def view_quality_month(t) -> DataFrame:
    f = with_dim(
        t["fato_qualidade"], t["dim_operador"], fk="sk_operador_avaliado", sk="sk_operador", take=["nm_operador"]
    )
    return with_day(f, t, "sk_data", MONTH).groupBy("nm_operador", *MONTH).agg(
        n("sk_avaliacao").alias("nr_avaliacoes"),
        mean("nr_nota").alias("nr_nota_media"),
        F.sum("fl_aprovado").alias("nr_aprovados"),
        F.sum("fl_critico").alias("nr_criticos"),
        pct(F.sum("fl_aprovado"), n("sk_avaliacao")).alias("pct_aprovacao"),
    )


def view_tickets_month(t) -> DataFrame:
    f = with_day(t["fato_ticket"], t, "sk_data_abertura", MONTH)
    f = with_dim(f, t["dim_status_ticket"], fk="sk_status_ticket", sk="sk_status", take=["ds_status"])
    f = with_dim(f, t["dim_categoria_ticket"], fk="sk_categoria", sk="sk_categoria", take=["nm_categoria"])
    f = with_dim(f, t["dim_prioridade_ticket"], fk="sk_prioridade", sk="sk_prioridade", take=["nm_prioridade"])
    return f.groupBy(*MONTH, "ds_status", "nm_categoria", "nm_prioridade").agg(
        n("sk_ticket").alias("nr_total_tickets"),
        F.sum("fl_ticket_resolvido").alias("nr_resolvidos"),
        F.sum("fl_dentro_sla").alias("nr_dentro_sla"),
    )


def view_ticket_sla(t) -> DataFrame:
    """Resolved tickets only. The stored measure is in minutes, so hours are minutes / 60."""
    f = with_day(t["fato_ticket"].filter("fl_ticket_resolvido = 1"), t, "sk_data_abertura", MONTH)
    f = with_dim(f, t["dim_prioridade_ticket"], fk="sk_prioridade", sk="sk_prioridade", take=["nm_prioridade"])
    minutes = F.col("nr_tempo_resolucao_min")
    return f.groupBy(*MONTH, "nm_prioridade").agg(
        mean(minutes).alias("nr_trt_medio_minutos"),
        half_up(F.avg(minutes) / F.lit(60.0)).alias("nr_trt_medio_horas"),
        pct(F.sum("fl_dentro_sla"), n("sk_ticket")).alias("pct_sla_cumprido"),
    )


def view_digital_month(t) -> DataFrame:
    def side(fact: str, key: str, complete: str, channel: str) -> DataFrame:
        return with_day(t[fact], t, "sk_data_inicio", MONTH).groupBy(*MONTH).agg(
            n(key).alias("nr_atendimentos"),
            mean("nr_duracao_minutos").alias("nr_duracao_media"),
            F.sum(complete).alias("nr_completos"),
        ).withColumn("ds_canal", F.lit(channel))

    return side("fato_chat", "sk_chat", "fl_chat_completo", "CHAT").unionByName(
        side("fato_whatsapp", "sk_whatsapp", "fl_atendimento_completo", "WHATSAPP")
    )


def view_campaigns(t) -> DataFrame:
    """Dials per campaign; the unknown campaign has no dates and shows N/A."""
    camp = t["dim_campanha"]
    day = {c: F.coalesce(F.col(c).cast("string"), F.lit("N/A")) for c in ("dt_inicio", "dt_fim")}
    f = with_dim(
        t["fato_discagem"], camp.withColumns(day), fk="sk_campanha", sk="sk_campanha",
        take=["nm_campanha", "dt_inicio", "dt_fim", "fl_campanha_ativa"],
    )
    return f.groupBy("nm_campanha", "dt_inicio", "dt_fim", "fl_campanha_ativa").agg(
        n("sk_discagem").alias("nr_total_discagens"),
        F.sum("fl_discagem_atendida").alias("nr_atendidas"),
        pct(F.sum("fl_discagem_atendida"), n("sk_discagem")).alias("pct_taxa_atendimento"),
    )


def view_queue_metrics(t) -> DataFrame:
    f = with_dim(
        t["fato_metricas_operacionais"], t["dim_fila"], fk="sk_fila", sk="sk_fila", take=["nm_fila", "ds_tipo_canal"]
    )
    return with_day(f, t, "sk_data", MONTH).groupBy("nm_fila", "ds_tipo_canal", *MONTH).agg(
        F.sum("nr_chamadas_recebidas").alias("nr_chamadas_recebidas"),
        F.sum("nr_chamadas_atendidas").alias("nr_chamadas_atendidas"),
        mean("nr_nivel_servico").alias("nr_nivel_servico_medio"),
        mean("nr_tma_minutos").alias("nr_tma_medio"),
        mean("nr_tme_minutos").alias("nr_tme_medio"),
        mean("nr_taxa_abandono").alias("nr_taxa_abandono_media"),
    )


def view_ivr_options(t) -> DataFrame:
    f = with_day(t["fato_ura_navegacao"], t, "sk_data", MONTH)
    return f.groupBy(*MONTH, "ds_opcao_selecionada").agg(
        n("sk_ura").alias("nr_navegacoes"),
        F.sum("fl_abandonou_ura").alias("nr_abandonos"),
        mean("nr_duracao_segundos", 0).alias("nr_duracao_media_segundos"),
        pct(F.sum("fl_abandonou_ura"), n("sk_ura")).alias("pct_abandono"),
    )
