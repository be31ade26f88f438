"""Queue occupancy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atende.functions.rules import pct, traffic_light
from atende.operators.lookup import with_dim
from atende.operators.ranks import ranked
from atende.plans.kpi.common import mean, mean_if, n, n_if, optional, top, year_month
from atende.sources.stage import staged
from atende.plans.kpi.kpi01 import DAY, calls

OPENING_HOURS = 8


def kpi11_base(t) -> DataFrame:
    """Calls with queue capacity, start hour and shift of day (NULL hour counts as 0)."""
    f = calls(t, None)
    queues = t["dim_fila"]
    capacity = queues.select("sk_fila", optional(queues, "nr_capacidade_max", "int").alias("nr_capacidade_maxima"))
    f = with_dim(f, capacity, fk="sk_fila", sk="sk_fila", take=["nr_capacidade_maxima"])
    hour = optional(f, "nr_hora_inicio", "int")
    at = F.coalesce(hour, F.lit(0))
    shift = (
        F.when(at.between(6, 11), "MANHA")
        .when(at.between(12, 17), "TARDE")
        .when(at.between(18, 21), "NOITE")
        .otherwise("MADRUGADA")
    )
    return f.select(
        "sk_chamada", "sk_fila", "sk_canal", "sk_data_inicio", "nr_duracao_segundos",
        "fl_chamada_completa", "fl_duracao_valida", "ds_fila", "nr_capacidade_maxima",
        "ds_canal", *DAY, year_month().alias("ds_ano_mes"), hour.alias("nr_hora_inicio"),
        shift.alias("ds_turno"), "ds_status_chamada", "fl_atendida", "fl_abandonada",
    )


def _daily(base: DataFrame) -> DataFrame:
    rows = n("sk_chamada")
    handled = (F.col("fl_duracao_valida") == 1) & (F.col("fl_atendida") == 1)
    return base.groupBy(*DAY, "sk_fila", "ds_fila", "ds_canal").agg(
        F.max("nr_capacidade_maxima").alias("nr_capacidade_maxima"),
        rows.alias("nr_chamadas_recebidas"),
        F.sum("fl_atendida").alias("nr_chamadas_atendidas"),
        F.sum("fl_abandonada").alias("nr_chamadas_abandonadas"),
        pct(rows, F.max("nr_capacidade_maxima") * OPENING_HOURS).alias("pct_ocupacao_fila"),
        pct(F.sum("fl_atendida"), rows).alias("pct_taxa_atendimento"),
        mean_if(handled, "nr_duracao_segundos").alias("nr_tma_segundos"),
    )


def kpi11_intraday(t) -> DataFrame:
    per_hour = (
        kpi11_base(t)
        .groupBy("ds_fila", "ds_canal", "nr_hora_inicio", "ds_turno")
        .agg(
            n("sk_chamada").alias("nr_chamadas_hora"),
            F.sum("fl_atendida").alias("nr_atendidas_hora"),
            F.sum("fl_abandonada").alias("nr_abandonadas_hora"),
            mean("nr_duracao_segundos").alias("nr_duracao_media_hora"),
        )
    )
    # At most 25 hours per queue and channel: the window groups stay small.
    queue = Window.partitionBy("ds_fila")
    return per_hour.withColumns(
        {
            "pct_volume_hora_vs_total": pct(F.col("nr_chamadas_hora"), F.sum("nr_chamadas_hora").over(queue)),
            "rank_horario_volume": F.rank().over(queue.orderBy(F.col("nr_chamadas_hora").desc())),
        }
    )


def _overload(daily: DataFrame, t) -> DataFrame:
    out = daily.groupBy("sk_fila", "ds_fila", "ds_canal").agg(
        mean("nr_chamadas_recebidas").alias("nr_media_chamadas_dia"),
        mean("pct_ocupacao_fila").alias("nr_ocupacao_media"),
        F.max("pct_ocupacao_fila").alias("nr_ocupacao_maxima"),
        F.min("pct_ocupacao_fila").alias("nr_ocupacao_minima"),
        mean("pct_taxa_atendimento").alias("nr_atendimento_medio"),
        mean("nr_tma_segundos").alias("nr_tma_medio"),
        n_if(F.col("pct_ocupacao_fila") > 85).alias("nr_dias_sobrecarga_critica"),
        F.round(F.avg("pct_ocupacao_fila"), 9).alias("_media"),
    )
    return ranked(out, {"rank_sobrecarga": ("_media", True)}).drop("_media")


def kpi11_overload_rank(t) -> DataFrame:
    return _overload(_daily(kpi11_base(t)), t)


def kpi11_weekly_pattern(t) -> DataFrame:
    return _daily(kpi11_base(t)).groupBy("ds_dia_semana", "ds_fila").agg(
        mean("nr_chamadas_recebidas").alias("nr_media_chamadas"),
        mean("pct_ocupacao_fila").alias("nr_ocupacao_media_semana"),
        mean("pct_taxa_atendimento").alias("nr_atendimento_medio_semana"),
    )


def kpi11_peak_hour(t) -> DataFrame:
    """Busiest hour per queue; equally busy hours are all kept."""
    return (
        kpi11_intraday(t)
        .filter("rank_horario_volume = 1")
        .select(
            "ds_fila", "nr_hora_inicio", "ds_turno", "nr_chamadas_hora",
            "pct_volume_hora_vs_total", "rank_horario_volume",
        )
    )


def kpi11_daily_occupancy(t, limit: int | None = None, keep_ties: bool = False) -> DataFrame:
    """Occupancy per day and queue with overload rank and peak hour.

    Of equally busy hours the earliest is attached, so that a tie does not repeat the row;
    ``keep_ties`` gives a row for each of them.
    """
    daily = staged(_daily(kpi11_base(t)))
    overload = _overload(daily, t).select(
        "sk_fila", "rank_sobrecarga", "nr_ocupacao_media", "nr_dias_sobrecarga_critica"
    )
    hours = ("nr_hora_inicio", "ds_turno", "nr_chamadas_hora", "pct_volume_hora_vs_total")
    busiest = kpi11_peak_hour(t).select("ds_fila", F.struct(*hours).alias("_pico"))
    if not keep_ties:
        busiest = busiest.groupBy("ds_fila").agg(F.min("_pico").alias("_pico"))
    peak = busiest.select(
        "ds_fila",
        F.col("_pico.nr_hora_inicio").alias("nr_hora_pico"),
        F.col("_pico.ds_turno").alias("ds_turno_pico"),
        F.col("_pico.nr_chamadas_hora").alias("nr_chamadas_hora_pico"),
        F.col("_pico.pct_volume_hora_vs_total").alias("pct_volume_hora_pico"),
    )
    load = F.col("pct_ocupacao_fila")
    out = (
        daily.join(overload, "sk_fila", "left")
        .join(peak, "ds_fila", "left")
        .withColumns(
            {
                "ds_situacao_ocupacao": F.when(load > 100, "SATURADA")
                .when(load > 85, "SOBRECARGA_CRITICA")
                .when(load > 70, "ATENCAO")
                .otherwise("NORMAL"),
                "semaforo_atendimento": traffic_light("pct_taxa_atendimento", (95, 85)),
            }
        )
    )
    order = [("dt_completa", True), ("pct_ocupacao_fila", True), ("sk_fila", False), ("ds_canal", False)]
    return top(out, order, limit).drop("sk_fila")
