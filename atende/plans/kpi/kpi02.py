"""Operator performance and ranking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import half_up, pct
from atende.operators.scalars import one_row
from atende.operators.ranks import ranked
from atende.plans.kpi.common import mean, mean_if, n, n_if, optional, top, with_day
from atende.sources.stage import staged

WEIGHTS = {"rank_volume": 0.30, "rank_qualidade": 0.40, "rank_produtividade": 0.30}


def active_operators(t) -> DataFrame:
    return t["dim_operador"].filter("fl_operador_ativo = 1")


def _of_active(fact: DataFrame, t, fk: str) -> DataFrame:
    """Rows of active operators only (the operator adds no column, so a semi join will do)."""
    keep = active_operators(t).select(F.col("sk_operador").alias("_keep"))
    return fact.join(keep, F.col(fk) == F.col("_keep"), "left_semi")


def kpi02_calls_by_operator_month(t) -> DataFrame:
    calls = with_day(_of_active(t["fato_chamada"], t, "sk_operador"), t, "sk_data_inicio", ["nr_ano", "nr_mes"])
    rows, valid = n("sk_chamada"), F.col("fl_duracao_valida") == 1
    return calls.groupBy("sk_operador", "nr_ano", "nr_mes").agg(
        rows.alias("nr_total_chamadas"),
        n_if(valid).alias("nr_chamadas_validas"),
        mean_if(valid, "nr_duracao_segundos").alias("nr_tma_segundos"),
        mean_if(valid, "nr_duracao_minutos").alias("nr_tma_minutos"),
        F.sum("fl_chamada_completa").alias("nr_chamadas_completas"),
        pct(F.sum("fl_chamada_completa"), rows).alias("pct_chamadas_completas"),
    )


def kpi02_quality_by_operator(t) -> DataFrame:
    scores = _of_active(t["fato_qualidade"], t, "sk_operador_avaliado")
    rows = n("sk_avaliacao")
    return scores.groupBy(F.col("sk_operador_avaliado").alias("sk_operador")).agg(
        rows.alias("nr_avaliacoes"),
        mean("nr_nota").alias("nr_nota_geral_media"),
        mean(optional(scores, "nr_nota_comunicacao", "double")).alias("nr_nota_comunicacao_media"),
        mean(optional(scores, "nr_nota_resolucao", "double")).alias("nr_nota_resolucao_media"),
        pct(n_if(F.col("nr_nota") == 10), rows).alias("pct_excelentes"),
        pct(n_if(F.col("nr_nota") < 6), rows).alias("pct_criticas"),
    )


def kpi02_attendance(t) -> DataFrame:
    shifts = _of_active(t["fato_jornada_operador"], t, "sk_operador")
    rows, present = n("sk_jornada"), n_if(F.col("st_presenca") == "PRESENTE")
    return shifts.groupBy("sk_operador").agg(
        F.sum("nr_horas_trabalhadas").alias("nr_horas_total"),
        F.sum("nr_chamadas_atendidas").alias("nr_chamadas_jornada"),
        F.sum("nr_tickets_resolvidos").alias("nr_tickets_resolvidos"),
        present.alias("nr_dias_presente"),
        rows.alias("nr_dias_total"),
        pct(present, rows).alias("pct_presenca"),
    )


def kpi02_consolidated(t) -> DataFrame:
    """Active operators with calls (mean of the monthly means), quality and attendance."""
    calls = kpi02_calls_by_operator_month(t).groupBy("sk_operador").agg(
        F.sum("nr_total_chamadas").alias("nr_total_chamadas"),
        F.sum("nr_chamadas_validas").alias("nr_chamadas_validas"),
        mean("nr_tma_segundos").alias("nr_tma_segundos"),
        mean("nr_tma_minutos").alias("nr_tma_minutos"),
        mean("pct_chamadas_completas").alias("pct_chamadas_completas"),
    )
    shifts = kpi02_attendance(t).select(
        "sk_operador", F.col("nr_horas_total").alias("_horas"), "pct_presenca"
    )
    joined = (
        active_operators(t)
        .select("sk_operador", "nm_operador", F.col("ds_faixa_tempo_casa").alias("ds_cargo"))
        .join(calls, "sk_operador", "left")
        .join(kpi02_quality_by_operator(t), "sk_operador", "left")
        .join(shifts, "sk_operador", "left")
    )
    zero = [
        "nr_total_chamadas", "nr_chamadas_validas", "nr_tma_segundos", "nr_tma_minutos",
        "pct_chamadas_completas", "nr_avaliacoes", "nr_nota_geral_media",
        "nr_nota_comunicacao_media", "nr_nota_resolucao_media", "pct_excelentes", "pct_criticas",
    ]
    return joined.select(
        "sk_operador", "nm_operador", "ds_cargo",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in zero],
        F.coalesce("_horas", F.lit(0.0)).alias("nr_horas_trabalhadas"),
        F.coalesce("pct_presenca", F.lit(0.0)).alias("pct_presenca"),
        half_up(
            F.coalesce("nr_total_chamadas", F.lit(0)) / F.nullif("_horas", F.lit(0.0)), 2
        ).alias("nr_calls_por_hora"),
    )


def kpi02_ranking(t, weights: dict[str, float] = WEIGHTS, limit: int | None = None) -> DataFrame:
    """Operators against the team mean, three ranks and their weighted sum."""
    people = staged(kpi02_consolidated(t).filter("nr_total_chamadas > 0"))
    team = one_row(people.agg(F.avg("nr_tma_segundos").alias("tma"), F.avg("nr_nota_geral_media").alias("nota")))
    rows = ranked(
        people,
        {
            "rank_volume": ("nr_total_chamadas", True),
            "rank_qualidade": ("nr_nota_geral_media", True),
            "rank_produtividade": ("nr_calls_por_hora", True),
        },
        stored=True,
    )
    score = reduce(lambda a, b: a + b, [F.col(r) * F.lit(w) for r, w in weights.items()])
    out = rows.select(
        "sk_operador", "nm_operador", "ds_cargo", "nr_total_chamadas", "nr_tma_segundos",
        "nr_tma_minutos", "nr_nota_geral_media", "nr_nota_comunicacao_media",
        "nr_nota_resolucao_media", "nr_avaliacoes", "pct_excelentes", "pct_criticas",
        "nr_horas_trabalhadas", "pct_presenca", "nr_calls_por_hora", "pct_chamadas_completas",
        pct(F.col("nr_tma_segundos") - team["tma"], team["tma"]).alias("pct_desvio_tma"),
        pct(F.col("nr_nota_geral_media") - team["nota"], team["nota"]).alias("pct_desvio_nota"),
        *weights,
        half_up(score, 2).alias("score_ranking_composto"),
    )
    return top(out, [("rank_qualidade", False), ("nr_total_chamadas", True), ("sk_operador", False)], limit)
