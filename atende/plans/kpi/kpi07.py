"""Satisfaction in the digital channels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atende.functions.rules import half_up, pct, traffic_light
from atende.operators.lookup import with_dim
from atende.operators.ranks import ranked
from atende.plans.kpi.common import mean, n, n_if, optional, top, with_day, year_month


def _side(t, fact: str, key: str, complete: str, kind: str) -> DataFrame:
    f = t[fact].filter(F.col(complete) == 1)
    score = optional(f, "nr_satisfacao", "double").alias("nr_nota_satisfacao")
    f = f.select(F.col(key).alias("sk_chat"), "sk_cliente", "sk_operador", "sk_canal", "sk_data_inicio", score)
    f = with_dim(f, t["dim_canal"], fk="sk_canal", sk="sk_canal", take={"nm_canal": "ds_canal"})
    f = with_day(f, t, "sk_data_inicio", ["dt_completa", "nr_ano", "nr_mes"])
    f = with_dim(f, t["dim_operador"], fk="sk_operador", sk="sk_operador", take=["nm_operador"])
    return f.select(
        "sk_chat", "sk_cliente", "sk_operador", "sk_canal", F.lit(kind).alias("ds_tipo_canal"),
        "ds_canal", "nr_nota_satisfacao", "dt_completa", "nr_ano", "nr_mes",
        year_month().alias("ds_ano_mes"), "nm_operador",
    )


def kpi07_unified(t) -> DataFrame:
    """Completed sessions of both channels; the score is NULL where the facts have none."""
    return _side(t, "fato_chat", "sk_chat", "fl_chat_completo", "CHAT").unionByName(
        _side(t, "fato_whatsapp", "sk_whatsapp", "fl_atendimento_completo", "WHATSAPP")
    )


SCORES = range(1, 6)


def _promoters():
    return n_if(F.col("nr_nota_satisfacao") >= 4)


def _detractors():
    return n_if(F.col("nr_nota_satisfacao") <= 2)


def kpi07_csat_channel(t, limit: int | None = None) -> DataFrame:
    rows, score = n("sk_chat"), F.col("nr_nota_satisfacao")
    net = F.lit(100.0) * _promoters() / F.nullif(rows, F.lit(0)) - F.lit(100.0) * _detractors() / F.nullif(rows, F.lit(0))
    out = (
        kpi07_unified(t)
        .groupBy("ds_tipo_canal")
        .agg(
            rows.alias("nr_avaliacoes"),
            mean("nr_nota_satisfacao").alias("nr_csat_medio"),
            *[n_if(score == i).alias(f"nr_nota_{i}") for i in SCORES],
            *[pct(n_if(score == i), rows).alias(f"pct_nota_{i}") for i in SCORES],
            pct(_promoters(), rows).alias("pct_promotores"),
            pct(_detractors(), rows).alias("pct_detratores"),
            half_up(net, 2).alias("nr_nps_proxy"),
        )
        .withColumns(
            {
                "semaforo_csat": traffic_light("nr_csat_medio", (4.0, 3.0), ("VERDE_SATISFATORIO", "AMARELO_ATENCAO", "VERMELHO_CRITICO")),
                "semaforo_detratores": traffic_light("pct_detratores", (10, 20), higher_is_better=False),
            }
        )
    )
    return top(out, [("nr_csat_medio", True), ("ds_tipo_canal", False)], limit)


def kpi07_monthly_trend(t) -> DataFrame:
    rows = n("sk_chat")
    monthly = (
        kpi07_unified(t)
        .groupBy("ds_ano_mes", "nr_ano", "nr_mes", "ds_tipo_canal")
        .agg(
            rows.alias("nr_avaliacoes_mes"),
            mean("nr_nota_satisfacao").alias("nr_csat_medio_mes"),
            pct(_promoters(), rows).alias("pct_promotores_mes"),
            pct(_detractors(), rows).alias("pct_detratores_mes"),
        )
    )
    months = Window.partitionBy("ds_tipo_canal").orderBy("nr_ano", "nr_mes")
    previous = F.lag("nr_csat_medio_mes").over(months)
    return monthly.withColumn("nr_csat_mes_anterior", previous).withColumn(
        "nr_variacao_csat_mom", half_up(F.col("nr_csat_medio_mes") - F.col("nr_csat_mes_anterior"), 2)
    )


def kpi07_by_operator(t, min_sessions: int = 10) -> DataFrame:
    rows = n("sk_chat")
    out = (
        kpi07_unified(t)
        .filter(F.col("nm_operador").isNotNull())
        .groupBy("sk_operador", "nm_operador", "ds_tipo_canal")
        .agg(
            rows.alias("nr_avaliacoes"),
            mean("nr_nota_satisfacao").alias("nr_csat_medio"),
            pct(_promoters(), rows).alias("pct_promotores"),
            F.avg("nr_nota_satisfacao").alias("_media"),
        )
        .filter(F.col("nr_avaliacoes") >= min_sessions)
    )
    return ranked(out, {"rank_csat_canal": ("_media", True)}, partition=["ds_tipo_canal"]).drop("_media")
