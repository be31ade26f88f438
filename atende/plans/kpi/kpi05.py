"""Ticket resolution efficiency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atende.functions.rules import half_up, ladder, pct, traffic_light
from atende.operators.ranks import ranked
from atende.operators.scalars import one_row
from atende.plans.kpi.common import (
    SLA_HOURS, mean_if, n, n_if, one_if, top, year_month,
)
from atende.plans.kpi.kpi04 import target_hours, tickets

# Upper limits (minutes) and labels of the resolution-time bands.
RESOLUTION_BANDS = [
    (60, "MENOS_1H"), (240, "1H_A_4H"), (480, "4H_A_8H"), (1440, "8H_A_24H"), (4320, "24H_A_72H"),
]


def kpi05_base(t, hours: dict[str, int] = SLA_HOURS) -> DataFrame:
    f = tickets(t, {"nr_ano": "nr_ano", "nr_mes": "nr_mes"})
    minutes, escalated = F.col("nr_tempo_resolucao_min"), F.col("ds_status_ticket") == "ESCALONADO"
    open_or_long = F.when(minutes.isNull(), "NAO_RESOLVIDO").otherwise("MAIS_72H")
    return f.select(
        "sk_ticket", "sk_operador", "sk_categoria", "sk_prioridade", "sk_status_ticket",
        "sk_data_abertura", "sk_data_resolucao", "nr_tempo_resolucao_horas",
        "ds_categoria_ticket", "ds_prioridade_ticket", "ds_status_ticket", "dt_abertura",
        "nr_ano", "nr_mes", year_month("dt_abertura").alias("ds_ano_mes"), "fl_resolvido",
        "fl_em_aberto", one_if(escalated).alias("fl_escalonado"),
        one_if((F.col("fl_resolvido") == 1) & ~escalated).alias("fl_fcr_candidato"),
        target_hours(F.col("ds_prioridade_ticket"), hours).alias("nr_sla_target_horas"),
        ladder(minutes, RESOLUTION_BANDS, "<", open_or_long).alias("ds_faixa_resolucao"),
    )


def _done():
    return F.col("fl_resolvido") == 1


def _fcr():
    return pct(F.sum("fl_fcr_candidato"), n_if(_done()))


def _mean_hours():
    return F.avg(F.when(_done(), F.col("nr_tempo_resolucao_horas")))


def _quantile(q: float):
    """Exact quantile of the hours, open tickets counting as 0.

    Its state is one counter per distinct value; hours have two decimals, so it grows with
    the range of the hours and not with the tickets.
    """
    return F.expr(f"percentile_disc({q}) within group (order by coalesce(nr_tempo_resolucao_horas, 0D))")


def _by_category(base: DataFrame, t) -> DataFrame:
    out = base.groupBy("ds_categoria_ticket").agg(
        n("sk_ticket").alias("nr_total_tickets"),
        n_if(_done()).alias("nr_tickets_resolvidos"),
        half_up(_mean_hours(), 2).alias("nr_mttr_horas"),
        half_up(_mean_hours() / F.lit(24.0), 2).alias("nr_mttr_dias"),
        _quantile(0.5).alias("nr_mttr_mediana_horas"),
        _quantile(0.9).alias("nr_mttr_p90_horas"),
        F.min(F.when(_done(), F.col("nr_tempo_resolucao_horas"))).alias("nr_mttr_minimo"),
        F.max(F.when(_done(), F.col("nr_tempo_resolucao_horas"))).alias("nr_mttr_maximo"),
        _fcr().alias("pct_fcr"),
        _mean_hours().alias("_mttr"),
    )
    return ranked(out, {"rank_mttr_categoria": ("_mttr", False)}).drop("_mttr")


def kpi05_mttr_category(t, limit: int | None = None) -> DataFrame:
    base = kpi05_base(t)
    backlog = kpi05_backlog(t).groupBy("ds_categoria_ticket").agg(F.sum("nr_backlog").alias("_backlog"))
    overall = one_row(kpi05_fcr_global(t).select("pct_fcr_global", "nr_mttr_global_horas"))
    out = (
        _by_category(base, t)
        .join(backlog, "ds_categoria_ticket", "left")
        .withColumns(overall)
        .withColumns(
            {
                "nr_backlog_atual": F.coalesce("_backlog", F.lit(0)),
                "desvio_mttr_vs_global": half_up(F.col("nr_mttr_horas") - F.col("nr_mttr_global_horas"), 2),
                "semaforo_fcr": traffic_light("pct_fcr", (80, 65)),
            }
        )
        .drop("_backlog")
    )
    return top(out, [("nr_mttr_horas", True), ("nr_total_tickets", True), ("ds_categoria_ticket", False)], limit)


def kpi05_mttr_priority(t) -> DataFrame:
    return kpi05_base(t).groupBy("ds_prioridade_ticket", "nr_sla_target_horas").agg(
        n("sk_ticket").alias("nr_total_tickets"),
        n_if(_done()).alias("nr_tickets_resolvidos"),
        mean_if(_done(), "nr_tempo_resolucao_horas").alias("nr_mttr_horas"),
        half_up(_mean_hours() / F.nullif("nr_sla_target_horas", F.lit(0)), 2).alias("nr_ratio_mttr_sla"),
        _fcr().alias("pct_fcr"),
    )


def kpi05_backlog(t) -> DataFrame:
    return (
        kpi05_base(t)
        .filter("fl_em_aberto = 1")
        .groupBy("ds_prioridade_ticket", "ds_categoria_ticket")
        .agg(
            n("sk_ticket").alias("nr_backlog"),
            n("nr_sla_target_horas").alias("nr_backlog_total_aberto"),
            F.avg("nr_sla_target_horas").alias("nr_media_horas_em_aberto"),
        )
    )


def kpi05_band_share(t) -> DataFrame:
    per_band = kpi05_base(t).groupBy("ds_faixa_resolucao", "ds_prioridade_ticket").agg(n("sk_ticket").alias("nr_tickets"))
    whole = F.sum("nr_tickets").over(Window.partitionBy("ds_prioridade_ticket"))
    return per_band.withColumn("pct_faixa", pct(F.col("nr_tickets"), whole))


def kpi05_fcr_global(t) -> DataFrame:
    return (
        kpi05_base(t)
        .filter(_done())
        .agg(
            n("sk_ticket").alias("nr_total_resolvidos"),
            F.sum("fl_fcr_candidato").alias("nr_fcr"),
            _fcr().alias("pct_fcr_global"),
            half_up(_mean_hours(), 2).alias("nr_mttr_global_horas"),
        )
    )
