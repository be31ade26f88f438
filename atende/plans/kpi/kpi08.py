"""Outbound campaign performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import half_up, pct, traffic_light
from atende.operators.lookup import with_dim
from atende.operators.ranks import rank_within, ranked
from atende.plans.kpi.common import mean, mean_if, n, optional, top

WEIGHTS = {"rank_taxa_contato": 0.35, "rank_taxa_conversao": 0.50, "_rank_tentativas": 0.15}


def dials(t) -> DataFrame:
    """Dials with their campaign; goal, attempts and conversions where the tables have them."""
    f, camp = t["fato_discagem"], t["dim_campanha"]
    f = f.select(
        "sk_discagem", "sk_campanha", "sk_cliente",
        F.coalesce(optional(f, "nr_tentativas", "int"), F.lit(1)).alias("nr_tentativas"),
        F.col("fl_discagem_atendida").alias("fl_contato_realizado"),
        F.coalesce(optional(f, "fl_convertido", "int"), F.lit(0)).alias("fl_convertido"),
    )
    dim = camp.select(
        "sk_campanha", "nm_campanha",
        optional(camp, "ds_objetivo", "string").alias("ds_tipo_campanha"),
        F.col("st_campanha").alias("ds_status_campanha"),
        F.col("dt_inicio").alias("dt_inicio_campanha"),
        F.col("dt_fim").alias("dt_fim_campanha"),
        optional(camp, "nr_meta_contatos", "int").alias("nr_meta_contatos"),
    )
    return with_dim(f, dim, fk="sk_campanha", sk="sk_campanha", take=dim.columns[1:])


def kpi08_base(t) -> DataFrame:
    return dials(t).drop("ds_tipo_campanha")


def kpi08_campaign(t, limit: int | None = None) -> DataFrame:
    rows, contacts, sales = n("sk_discagem"), F.sum("fl_contato_realizado"), F.sum("fl_convertido")
    out = (
        dials(t)
        .groupBy(
            "sk_campanha", "nm_campanha", "ds_tipo_campanha", "ds_status_campanha",
            "dt_inicio_campanha", "dt_fim_campanha",
        )
        .agg(
            F.max("nr_meta_contatos").alias("nr_meta_contatos"),
            rows.alias("nr_total_discagens"),
            contacts.alias("nr_contatos_realizados"),
            sales.alias("nr_conversoes"),
            (rows - contacts).alias("nr_sem_contato"),
            (contacts - sales).alias("nr_contatos_sem_conversao"),
            F.sum("nr_tentativas").alias("nr_total_tentativas"),
            mean("nr_tentativas").alias("nr_media_tentativas"),
            mean_if(F.col("fl_contato_realizado") == 1, "nr_tentativas").alias("nr_tentativas_ate_contato"),
            pct(contacts, rows).alias("pct_taxa_contato"),
            pct(sales, contacts).alias("pct_taxa_conversao_sobre_contato"),
            pct(sales, rows).alias("pct_taxa_conversao_sobre_discagens"),
        )
    )
    out = ranked(
        out,
        {
            "rank_taxa_contato": ("pct_taxa_contato", True),
            "rank_taxa_conversao": ("pct_taxa_conversao_sobre_contato", True),
            "rank_volume_conversao": ("nr_conversoes", True),
            "_rank_tentativas": ("nr_media_tentativas", False),
        },
    )
    score = sum((F.col(r) * F.lit(w) for r, w in WEIGHTS.items()), F.lit(0.0))
    out = out.withColumns(
        {
            "pct_atingimento_meta": pct(F.col("nr_contatos_realizados"), F.col("nr_meta_contatos")),
            "score_efetividade_campanha": half_up(score, 2),
            "semaforo_contato": traffic_light("pct_taxa_contato", (50, 30)),
            "semaforo_conversao": traffic_light("pct_taxa_conversao_sobre_contato", (15, 8)),
        }
    ).drop("_rank_tentativas")
    order = [("pct_taxa_conversao_sobre_contato", True), ("nr_conversoes", True), ("sk_campanha", False)]
    return top(out, order, limit)


def kpi08_client_campaign(t) -> DataFrame:
    """Per campaign and customer; the rank inside a campaign survives a campaign of any size."""
    rows, contacts, sales = n("sk_discagem"), F.sum("fl_contato_realizado"), F.sum("fl_convertido")
    out = (
        dials(t)
        .groupBy("sk_campanha", "nm_campanha", "sk_cliente")
        .agg(
            rows.alias("nr_discagens_operador"),
            contacts.alias("nr_contatos_operador"),
            sales.alias("nr_conversoes_operador"),
            pct(contacts, rows).alias("pct_contato_operador"),
            pct(sales, contacts).alias("pct_conversao_operador"),
            mean("nr_tentativas").alias("nr_media_tentativas_operador"),
        )
    )
    return rank_within(out, partition=["sk_campanha"], by="nr_conversoes_operador", name="rank_conversao_campanha")


def kpi08_attempt_bands(t) -> DataFrame:
    tries = F.col("nr_tentativas")
    band = (
        F.when(tries == 1, "1_TENTATIVA")
        .when(tries == 2, "2_TENTATIVAS")
        .when(tries.between(3, 5), "3_A_5_TENTATIVAS")
        .when(tries > 5, "MAIS_DE_5")
        .otherwise("INDEFINIDO")
    )
    rows, contacts = n("sk_discagem"), F.sum("fl_contato_realizado")
    return (
        dials(t)
        .groupBy("sk_campanha", "nm_campanha", band.alias("ds_faixa_tentativas"))
        .agg(rows.alias("nr_discagens"), contacts.alias("nr_contatos"), pct(contacts, rows).alias("pct_contato_faixa"))
    )
