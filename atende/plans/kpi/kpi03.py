"""Service quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import half_up, pct
from atende.operators.lookup import with_dim
from atende.operators.scalars import one_row
from atende.operators.ranks import ranked
from atende.plans.kpi.common import (
    mean, n, n_if, one_if, optional, top, with_day, year_month,
)
from atende.sources.stage import staged

BANDS = ("EXCELENTE", "BOM", "REGULAR", "RUIM")


def _band(score):
    return (
        F.when(score < 6, "RUIM")
        .when(score.between(6, 7.99), "REGULAR")
        .when(score.between(8, 9.99), "BOM")
        .when(score == 10, "EXCELENTE")
        .otherwise("NAO_CLASSIFICADO")
    )


def kpi03_base(t) -> DataFrame:
    """Reviews of active operators with band, evaluator and the day of the reviewed call."""
    f = t["fato_qualidade"]
    f = with_dim(
        f, t["dim_operador"].filter("fl_operador_ativo = 1"), fk="sk_operador_avaliado",
        sk="sk_operador", take={"nm_operador": "nm_operador", "ds_faixa_tempo_casa": "ds_cargo"},
    )
    f = with_dim(
        f, t["dim_supervisor"], fk="sk_avaliador", sk="sk_supervisor", take=["nm_supervisor"], how="left"
    )
    f = with_dim(f, t["fato_chamada"], fk="sk_chamada", sk="sk_chamada", take={"sk_data_inicio": "_dia"})
    f = with_day(f, t, "_dia", ["dt_completa", "nr_ano", "nr_mes", "nr_dia"])
    score = F.col("nr_nota")
    return f.select(
        F.col("sk_avaliacao").alias("sk_qualidade"),
        "sk_chamada",
        F.col("sk_operador_avaliado").alias("sk_operador"),
        F.col("sk_avaliador").alias("sk_supervisor"),
        score.alias("nr_nota_geral"),
        optional(f, "nr_nota_comunicacao", "double").alias("nr_nota_comunicacao"),
        optional(f, "nr_nota_resolucao", "double").alias("nr_nota_resolucao"),
        _band(score).alias("ds_banda_qualidade"),
        one_if(score >= 7).alias("fl_conforme"),
        "nm_operador", "ds_cargo", "nm_supervisor", "dt_completa", "nr_ano", "nr_mes", "nr_dia",
        year_month().alias("ds_ano_mes"),
    )


def _is(band: str):
    return n_if(F.col("ds_banda_qualidade") == band)


def kpi03_by_operator(t, limit: int | None = None) -> DataFrame:
    base, rows = kpi03_base(t), n("sk_qualidade")
    grouped = base.groupBy("sk_operador", "nm_operador", "ds_cargo", "nm_supervisor").agg(
        rows.alias("nr_total_avaliacoes"),
        mean("nr_nota_geral").alias("nr_nota_geral_media"),
        mean("nr_nota_comunicacao").alias("nr_nota_comunicacao_media"),
        mean("nr_nota_resolucao").alias("nr_nota_resolucao_media"),
        *[_is(b).alias(f"nr_{b.lower()}") for b in BANDS],
        *[pct(_is(b), rows).alias(f"pct_{b.lower()}") for b in BANDS],
        pct(F.sum("fl_conforme"), rows).alias("pct_conformidade"),
        F.min("nr_nota_geral").alias("nr_nota_minima"),
        F.max("nr_nota_geral").alias("nr_nota_maxima"),
        F.sum("nr_nota_geral").alias("_soma"), n("nr_nota_geral").alias("_notas"),
    )
    # The team's mean comes from the sums of the groups, so the base is read once.
    stored = staged(grouped)
    overall = one_row(stored.agg(half_up(F.sum("_soma") / F.nullif(F.sum("_notas"), F.lit(0)), 2).alias("media_equipe_geral")))
    per_operator = stored.drop("_soma", "_notas")
    score, team = F.col("nr_nota_geral_media"), F.col("media_equipe_geral")
    profile = F.lit("MISTO")
    for band in reversed(BANDS):
        profile = F.when(F.col(f"pct_{band.lower()}") >= 50, f"PREDOMINANTEMENTE_{band}").otherwise(profile)
    rows = per_operator.withColumns(overall).withColumns(
        {
            "desvio_vs_media": half_up(score - team, 2),
            "ds_situacao_vs_media": F.when(score < team, "ABAIXO_DA_MEDIA").otherwise("NA_MEDIA_OU_ACIMA"),
            "ds_perfil_qualidade": profile,
        }
    )
    rows = ranked(rows, {"rank_qualidade": ("nr_nota_geral_media", True)}, stored=True)
    order = [("nr_nota_geral_media", True), ("nr_total_avaliacoes", True), ("sk_operador", False), ("nm_supervisor", False)]
    return top(rows, order, limit)


def kpi03_by_supervisor(t) -> DataFrame:
    rows = n("sk_qualidade")
    return (
        kpi03_base(t)
        .filter(F.col("nm_supervisor").isNotNull())
        .groupBy("nm_supervisor")
        .agg(
            F.countDistinct("sk_operador").alias("nr_agentes_equipe"),
            rows.alias("nr_total_avaliacoes_equipe"),
            mean("nr_nota_geral").alias("nr_nota_media_equipe"),
            mean("nr_nota_comunicacao").alias("nr_nota_comunicacao_equipe"),
            mean("nr_nota_resolucao").alias("nr_nota_resolucao_equipe"),
            pct(F.sum("fl_conforme"), rows).alias("pct_conformidade_equipe"),
            _is("RUIM").alias("nr_avaliacoes_ruins"),
            pct(_is("RUIM"), rows).alias("pct_ruins_equipe"),
        )
    )


def kpi03_monthly_trend(t) -> DataFrame:
    rows = n("sk_qualidade")
    return kpi03_base(t).groupBy("ds_ano_mes", "nr_ano", "nr_mes").agg(
        rows.alias("nr_avaliacoes_mes"),
        mean("nr_nota_geral").alias("nr_nota_media_mes"),
        mean("nr_nota_comunicacao").alias("nr_nota_comunicacao_mes"),
        mean("nr_nota_resolucao").alias("nr_nota_resolucao_mes"),
        pct(F.sum("fl_conforme"), rows).alias("pct_conformidade_mes"),
        _is("EXCELENTE").alias("nr_excelente_mes"),
        _is("RUIM").alias("nr_ruim_mes"),
    )
