"""Return on campaigns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import pct, ratio, traffic_light
from atende.operators.ranks import ntile_over_all, ranked
from atende.plans.kpi.common import mean, n, top
from atende.sources.stage import staged
from atende.plans.kpi.kpi08 import dials

# Campaign states that count as running or finished.
SITUATIONS = {
    "ATIVA": ("ATIVA", "EM_ANDAMENTO", "RUNNING"),
    "ENCERRADA": ("ENCERRADA", "FINALIZADA", "CONCLUIDA"),
}
QUARTILES = ("TOP_25_PCT", "SEGUNDO_QUARTIL", "TERCEIRO_QUARTIL", "BOTTOM_25_PCT")


def _per_campaign(t, situations: dict[str, tuple[str, ...]] = SITUATIONS) -> DataFrame:
    situation = F.lit("OUTRO")
    for label, states in situations.items():
        situation = F.when(F.upper("ds_status_campanha").isin(*states), label).otherwise(situation)
    rows, contacts, sales = n("sk_discagem"), F.sum("fl_contato_realizado"), F.sum("fl_convertido")
    goal, tries = F.max("nr_meta_contatos"), F.sum("nr_tentativas")
    return (
        dials(t)
        .withColumn("ds_situacao_campanha", situation)
        .filter(F.col("ds_situacao_campanha").isin(*situations))
        .groupBy(
            "sk_campanha", "nm_campanha", "ds_tipo_campanha", "ds_status_campanha",
            "ds_situacao_campanha", "dt_inicio_campanha", "dt_fim_campanha",
        )
        .agg(
            goal.alias("nr_meta_contatos"),
            rows.alias("nr_total_discagens"),
            contacts.alias("nr_contatos_realizados"),
            sales.alias("nr_conversoes"),
            tries.alias("nr_total_tentativas"),
            pct(contacts, rows).alias("pct_taxa_contato"),
            pct(sales, goal).alias("pct_efetividade_meta"),
            pct(sales, contacts).alias("pct_aproveitamento_contato"),
            ratio(tries, sales).alias("nr_tentativas_por_conversao"),
            ratio(tries, contacts).alias("nr_tentativas_por_contato"),
            (sales - goal).alias("nr_gap_meta"),
            pct(sales - goal, goal).alias("pct_superacao_meta"),
        )
    )


def kpi09_roi(t, situations: dict[str, tuple[str, ...]] = SITUATIONS, limit: int | None = None) -> DataFrame:
    campaigns = staged(_per_campaign(t, situations))
    classes = _quartiles(campaigns, stored=True).select(
        "sk_campanha", "rank_geral_efetividade", "rank_geral_volume", "rank_eficiencia_custo",
        "quartil_efetividade", "ds_quartil_efetividade",
    )
    goal = F.col("pct_efetividade_meta")
    out = campaigns.join(classes, "sk_campanha", "left").withColumns(
        {
            "semaforo_efetividade": traffic_light(goal, (100, 80, 60), ("META_SUPERADA", "VERDE", "AMARELO", "VERMELHO")),
            "ds_eficiencia_operacional": traffic_light(
                "nr_tentativas_por_conversao", (5, 10), ("EFICIENTE", "MODERADO", "INEFICIENTE"), higher_is_better=False
            ),
        }
    )
    return top(out, [("pct_efetividade_meta", True), ("nr_conversoes", True), ("sk_campanha", False)], limit)


def kpi09_by_situation(t, situations: dict[str, tuple[str, ...]] = SITUATIONS) -> DataFrame:
    sales, goal = F.sum("nr_conversoes"), F.sum("nr_meta_contatos")
    return _per_campaign(t, situations).groupBy("ds_situacao_campanha").agg(
        n("sk_campanha").alias("nr_campanhas"),
        mean("pct_efetividade_meta").alias("nr_efetividade_media"),
        mean("pct_aproveitamento_contato").alias("nr_aproveitamento_medio"),
        mean("pct_taxa_contato").alias("nr_taxa_contato_media"),
        mean("nr_tentativas_por_conversao").alias("nr_custo_medio_conversao"),
        sales.alias("nr_total_conversoes_grupo"),
        goal.alias("nr_total_meta_grupo"),
        pct(sales, goal).alias("pct_efetividade_grupo"),
    )


def kpi09_rank_by_type(t, situations: dict[str, tuple[str, ...]] = SITUATIONS) -> DataFrame:
    rows = _per_campaign(t, situations).select(
        "sk_campanha", "nm_campanha", F.coalesce("ds_tipo_campanha", F.lit("")).alias("ds_tipo_campanha"),
        "ds_situacao_campanha", "nr_conversoes", "pct_efetividade_meta",
        "pct_aproveitamento_contato", "nr_tentativas_por_conversao",
    )
    return ranked(
        rows,
        {
            "rank_efetividade_tipo": ("pct_efetividade_meta", True),
            "rank_volume_tipo": ("nr_conversoes", True),
        },
        partition=["ds_tipo_campanha"],
    )


def kpi09_quartiles(t, situations: dict[str, tuple[str, ...]] = SITUATIONS) -> DataFrame:
    return _quartiles(_per_campaign(t, situations))


def _quartiles(campaigns: DataFrame, stored: bool = False) -> DataFrame:
    rows = campaigns.filter("nr_conversoes > 0").select(
        "sk_campanha", "nm_campanha", "ds_situacao_campanha", "pct_efetividade_meta",
        "nr_conversoes", "nr_tentativas_por_conversao",
    )
    rows = ranked(
        rows,
        {
            "rank_geral_efetividade": ("pct_efetividade_meta", True),
            "rank_geral_volume": ("nr_conversoes", True),
            "rank_eficiencia_custo": ("nr_tentativas_por_conversao", False),
        },
        stored=stored,
    )
    rows = ntile_over_all(rows, by="pct_efetividade_meta", tie="sk_campanha", name="quartil_efetividade")
    labels = F.array(*[F.lit(q) for q in QUARTILES])
    return rows.withColumn("ds_quartil_efetividade", F.try_element_at(labels, "quartil_efetividade"))
