"""Call volume and handle time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import pct, traffic_light
from atende.operators.lookup import with_dim
from atende.operators.ranks import ranked
from atende.plans.kpi.common import (
    ABANDONED, ANSWERED, mean, mean_if, n, one_if, since_year, top, with_day,
)

DAY = ["dt_completa", "nr_ano", "nr_mes", "nr_dia", "ds_dia_semana", "fl_fim_de_semana"]


def calls(t, min_year: int | None, day: list[str] = DAY) -> DataFrame:
    """Calls with day, channel, queue, status and the answered/abandoned flags."""
    f = since_year(t["fato_chamada"], "sk_data_inicio", min_year)
    f = with_day(f, t, "sk_data_inicio", day)
    f = with_dim(f, t["dim_canal"], fk="sk_canal", sk="sk_canal", take={"nm_canal": "ds_canal"})
    f = with_dim(f, t["dim_fila"], fk="sk_fila", sk="sk_fila", take={"nm_fila": "ds_fila"})
    f = with_dim(
        f, t["dim_status_chamada"], fk="sk_status_chamada", sk="sk_status",
        take={"ds_status": "ds_status_chamada"}, how="left",
    )
    status = F.col("ds_status_chamada")
    return f.withColumns(
        {"fl_atendida": one_if(status.isin(*ANSWERED)), "fl_abandonada": one_if(status.isin(*ABANDONED))}
    )


def _handled():
    return (F.col("fl_duracao_valida") == 1) & (F.col("fl_atendida") == 1)


def kpi01_base(t, min_year: int | None = 2025) -> DataFrame:
    return calls(t, min_year).select(
        "sk_chamada", "sk_fila", "sk_canal", "sk_status_chamada", "nr_duracao_segundos",
        "nr_duracao_minutos", "fl_duracao_valida", "fl_chamada_completa", *DAY, "ds_canal",
        "ds_fila", "ds_status_chamada", "fl_atendida", "fl_abandonada",
    )


def kpi01_by_channel(t, min_year: int | None = 2025, limit: int | None = None) -> DataFrame:
    rows, valid = n("sk_chamada"), F.col("fl_duracao_valida") == 1
    out = (
        kpi01_base(t, min_year)
        .groupBy(*DAY, "ds_canal")
        .agg(
            rows.alias("nr_total_chamadas"),
            F.sum("fl_atendida").alias("nr_chamadas_atendidas"),
            F.sum("fl_abandonada").alias("nr_chamadas_abandonadas"),
            pct(F.sum("fl_atendida"), rows).alias("pct_taxa_atendimento"),
            pct(F.sum("fl_abandonada"), rows).alias("pct_taxa_abandono"),
            mean_if(_handled(), "nr_duracao_segundos").alias("nr_tma_segundos"),
            mean_if(_handled(), "nr_duracao_minutos").alias("nr_tma_minutos"),
            F.max(F.when(valid, F.col("nr_duracao_segundos"))).alias("nr_duracao_max_seg"),
            F.min(F.when(_handled(), F.col("nr_duracao_segundos"))).alias("nr_duracao_min_seg"),
            F.sum("fl_chamada_completa").alias("nr_chamadas_completas"),
            pct(F.sum("fl_chamada_completa"), rows).alias("pct_chamadas_completas"),
        )
        .withColumns(
            {
                "semaforo_atendimento": traffic_light("pct_taxa_atendimento", (95, 85)),
                "semaforo_abandono": traffic_light("pct_taxa_abandono", (5, 10), higher_is_better=False),
                "semaforo_tma": traffic_light("nr_tma_segundos", (180, 300), higher_is_better=False),
            }
        )
    )
    return top(out, [("dt_completa", True), ("nr_total_chamadas", True), ("ds_canal", False)], limit)


def kpi01_by_queue(t, min_year: int | None = 2025) -> DataFrame:
    rows = n("sk_chamada")
    return (
        kpi01_base(t, min_year)
        .groupBy("dt_completa", "ds_fila", "ds_canal")
        .agg(
            rows.alias("nr_total_chamadas_fila"),
            F.sum("fl_atendida").alias("nr_atendidas_fila"),
            F.sum("fl_abandonada").alias("nr_abandonadas_fila"),
            pct(F.sum("fl_atendida"), rows).alias("pct_atendimento_fila"),
            pct(F.sum("fl_abandonada"), rows).alias("pct_abandono_fila"),
            mean_if(_handled(), "nr_duracao_segundos").alias("nr_tma_fila_segundos"),
        )
    )


def kpi01_queue_rank(t, min_year: int | None = 2025) -> DataFrame:
    totals = (
        kpi01_by_queue(t, min_year)
        .groupBy("ds_fila", "ds_canal")
        .agg(
            F.sum("nr_total_chamadas_fila").alias("nr_total_geral"),
            mean("pct_abandono_fila").alias("pct_abandono_medio"),
            mean("nr_tma_fila_segundos").alias("nr_tma_medio_segundos"),
        )
    )
    return ranked(totals, {"rank_volume": ("nr_total_geral", True)})
