"""Voice-menu (IVR) effectiveness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atende.functions.rules import half_up, ladder, pct, traffic_light
from atende.operators.ranks import ranked
from atende.operators.scalars import one_row
from atende.plans.kpi.common import mean, n, n_if, optional, top, with_day, year_month


def kpi12_base(t) -> DataFrame:
    f = with_day(t["fato_ura_navegacao"], t, "sk_data", ["dt_completa", "nr_ano", "nr_mes", "nr_dia", "ds_dia_semana"])
    gone = F.col("fl_abandonou_ura")
    return f.select(
        F.col("sk_ura").alias("sk_ura_navegacao"),
        "sk_chamada", "sk_data",
        F.col("ds_opcao_selecionada").alias("ds_fluxo_ura"),
        "ds_opcao_selecionada",
        optional(f, "nr_tentativas", "int").alias("nr_nivel_menu"),
        F.col("nr_duracao_segundos").alias("nr_tempo_navegacao_segundos"),
        optional(f, "fl_transferiu_humano", "int").alias("fl_transferiu_humano"),
        F.when(gone == 0, 1).otherwise(0).alias("fl_autoatendimento_concluido"),
        gone.alias("fl_abandono_ura"),
        F.when(gone == 0, "AUTO_ATENDIDO").when(gone == 1, "ABANDONO_URA").otherwise("OUTRO").alias("ds_resultado_ura"),
        "dt_completa", "nr_ano", "nr_mes", "nr_dia", "ds_dia_semana",
        year_month().alias("ds_ano_mes"),
    )


ROWS = "sk_ura_navegacao"
TIME = "nr_tempo_navegacao_segundos"


def _solved():
    return n_if(F.col("fl_autoatendimento_concluido") == 1)


def _moved():
    return n_if(F.col("fl_transferiu_humano") == 1)


def _gone():
    return n_if(F.col("fl_abandono_ura") == 1)


def kpi12_daily(t, limit: int | None = None) -> DataFrame:
    base = kpi12_base(t)
    daily = base.groupBy("dt_completa", "nr_ano", "nr_mes", "nr_dia", "ds_ano_mes").agg(
        n(ROWS).alias("nr_total_sessoes_ura"),
        _solved().alias("nr_auto_atendidos"),
        _moved().alias("nr_transferidos_humano"),
        _gone().alias("nr_abandonos_ura"),
        pct(_solved(), n(ROWS)).alias("pct_taxa_autoatendimento"),
        pct(_moved(), n(ROWS)).alias("pct_transferencia_humano"),
        pct(_gone(), n(ROWS)).alias("pct_abandono_ura"),
        mean(TIME).alias("nr_tempo_medio_navegacao_seg"),
        half_up(F.avg(TIME) / F.lit(60.0), 2).alias("nr_tempo_medio_navegacao_min"),
        mean("nr_nivel_menu").alias("nr_nivel_medio_menu"),
        F.max(TIME).alias("nr_tempo_max_navegacao_seg"),
    )
    overall = one_row(kpi12_global(t).drop("nr_total_sessoes"))
    seconds = F.col("nr_tempo_medio_navegacao_seg")
    out = daily.withColumns(overall).withColumns(
        {
            "desvio_autoatendimento_vs_global": half_up(
                F.col("pct_taxa_autoatendimento") - F.col("pct_autoatendimento_global"), 2
            ),
            "semaforo_autoatendimento": traffic_light(
                "pct_taxa_autoatendimento", (50, 35, 20), ("VERDE_EXCELENTE", "VERDE", "AMARELO", "VERMELHO_CRITICO")
            ),
            "semaforo_abandono": traffic_light("pct_abandono_ura", (5, 10), higher_is_better=False),
            "ds_classificacao_tempo": ladder(seconds, [(60, "RAPIDO"), (120, "NORMAL"), (180, "LENTO")], "<=", "MUITO_LENTO"),
        }
    )
    return top(out, [("dt_completa", True), ("nr_total_sessoes_ura", True)], limit)


def kpi12_top_flows(t) -> DataFrame:
    base = kpi12_base(t)
    whole = base.agg(F.count(F.lit(1))).scalar()
    out = (
        base.groupBy("ds_fluxo_ura", "ds_opcao_selecionada")
        .agg(
            n(ROWS).alias("nr_acessos"),
            pct(_solved(), n(ROWS)).alias("pct_autoatendimento_fluxo"),
            pct(_gone(), n(ROWS)).alias("pct_abandono_fluxo"),
            pct(_moved(), n(ROWS)).alias("pct_transferencia_fluxo"),
            mean(TIME).alias("nr_tempo_medio_seg"),
        )
        .withColumn("pct_acessos_total", pct(F.col("nr_acessos"), whole))
    )
    return ranked(out, {"rank_acesso": ("nr_acessos", True)})


def kpi12_abandon_points(t, min_visits: int = 10) -> DataFrame:
    out = (
        kpi12_base(t)
        .groupBy("ds_fluxo_ura", "ds_opcao_selecionada", "nr_nivel_menu")
        .agg(
            n(ROWS).alias("nr_total_chegadas"),
            _gone().alias("nr_abandonos"),
            pct(_gone(), n(ROWS)).alias("pct_abandono_ponto"),
            (F.lit(100.0) * _gone() / F.nullif(n(ROWS), F.lit(0))).alias("_taxa"),
        )
        .filter(F.col("nr_total_chegadas") >= min_visits)
    )
    return ranked(out, {"rank_abandono": ("_taxa", True)}).drop("_taxa")


def kpi12_monthly_trend(t) -> DataFrame:
    monthly = kpi12_base(t).groupBy("ds_ano_mes", "nr_ano", "nr_mes").agg(
        n(ROWS).alias("nr_sessoes_mes"),
        pct(_solved(), n(ROWS)).alias("pct_autoatendimento_mes"),
        pct(_gone(), n(ROWS)).alias("pct_abandono_mes"),
        mean(TIME).alias("nr_tempo_medio_mes_seg"),
    )
    # One row per month of the calendar, so one ordered window is small.
    months = Window.orderBy("nr_ano", "nr_mes")
    return monthly.withColumn("pct_autoatendimento_mes_anterior", F.lag("pct_autoatendimento_mes").over(months))


def kpi12_global(t) -> DataFrame:
    return kpi12_base(t).agg(
        n(ROWS).alias("nr_total_sessoes"),
        pct(_solved(), n(ROWS)).alias("pct_autoatendimento_global"),
        pct(_gone(), n(ROWS)).alias("pct_abandono_global"),
        mean(TIME).alias("nr_tempo_medio_global_seg"),
    )
