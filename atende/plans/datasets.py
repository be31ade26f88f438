"""Dashboard datasets: wide aggregates that a BI tool reads directly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import half_up, pct, ratio, traffic_light
from atende.operators.lookup import with_dim
from atende.plans.kpi.common import mean, mean_if, n, optional, since_year, with_day
from atende.plans.kpi.kpi01 import DAY, calls


def dataset_calls(t, min_year: int | None = 2025) -> DataFrame:
    handled = (F.col("fl_duracao_valida") == 1) & (F.col("fl_atendida") == 1)
    rows = n("sk_chamada")
    return (
        calls(t, min_year)
        .groupBy(*DAY, "ds_canal", "ds_fila", "ds_status_chamada")
        .agg(
            rows.alias("nr_total_chamadas"),
            F.sum("fl_atendida").alias("nr_chamadas_atendidas"),
            F.sum("fl_abandonada").alias("nr_chamadas_abandonadas"),
            mean_if(handled, "nr_duracao_segundos").alias("nr_tma_segundos"),
            mean_if(handled, "nr_duracao_minutos").alias("nr_tma_minutos"),
            pct(F.sum("fl_atendida"), rows).alias("pct_taxa_atendimento"),
            pct(F.sum("fl_abandonada"), rows).alias("pct_taxa_abandono"),
        )
        .withColumn("semaforo_atendimento", traffic_light("pct_taxa_atendimento", (95, 85)))
    )


def _operator_calls(t, min_year: int | None) -> tuple[DataFrame, list[str]]:
    people = t["dim_operador"].filter("fl_operador_ativo = 1")
    who = ["nm_operador", "ds_equipe", "ds_faixa_tempo_casa", "fl_operador_ativo"]
    people = people.withColumn("ds_equipe", optional(people, "ds_equipe", "string"))
    f = calls(t, min_year, ["dt_completa", "nr_ano", "nr_mes"])
    f = with_dim(f, people, fk="sk_operador", sk="sk_operador", take=who)
    return f, [*who, "dt_completa", "nr_ano", "nr_mes", "ds_canal", "ds_fila"]


def dataset_operators(t, min_year: int | None = 2025, prejoined: bool = True) -> DataFrame:
    """Calls with the reviews of the same operator and day.

    With ``prejoined`` every call meets every review of its operator and day, so the call
    count is inflated as in the dashboard it replaces. The pairs are not built: a call
    counts max(reviews, 1) times, which gives the same sums from one row per
    operator and day. ``prejoined=False`` counts each call once.
    """
    f, by = _operator_calls(t, min_year)
    reviews = (
        t["fato_qualidade"]
        .groupBy(F.col("sk_operador_avaliado").alias("_op"), F.col("sk_data").alias("_day"))
        .agg(n("sk_avaliacao").alias("_n"), F.sum("nr_nota").alias("_notas"))
    )
    valid = F.col("fl_duracao_valida") == 1
    on = (F.col("sk_operador") == F.col("_op")) & (F.col("sk_data_inicio") == F.col("_day"))
    # Calls of one operator, day and queue share their reviews: aggregate before the join.
    groups = f.groupBy("sk_operador", "sk_data_inicio", *by).agg(
        n("sk_chamada").alias("_calls"),
        F.sum(F.when(valid, F.col("nr_duracao_segundos"))).alias("_secs"),
        F.count(F.when(valid, 1)).alias("_valid"),
    )
    joined = groups.join(reviews, on, "left")
    times = F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1)) if prejoined else F.lit(1)
    weight = F.col("_calls") if prejoined else F.lit(1)
    return joined.groupBy(*by).agg(
        F.sum(F.col("_calls") * times).alias("nr_chamadas"),
        half_up(F.sum(F.col("_secs") * times) / F.nullif(F.sum(F.col("_valid") * times), F.lit(0))).alias("nr_tma_segundos"),
        half_up(F.sum(F.col("_notas") * weight) / F.nullif(F.sum(F.col("_n") * weight), F.lit(0))).alias("nr_nota_qualidade_media"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("nr_avaliacoes"),
    )


def dataset_tickets(t, min_year: int | None = 2025) -> DataFrame:
    """Tickets by opening day, status and operator; tickets arrive by e-mail (channel EMAIL)."""
    f = since_year(t["fato_ticket"], "sk_data_abertura", min_year).withColumn("_canal", F.lit(4))
    f = with_day(f, t, "sk_data_abertura", {"dt_completa": "dt_abertura", "nr_ano": "nr_ano", "nr_mes": "nr_mes", "ds_dia_semana": "ds_dia_semana"})
    f = with_dim(f, t["dim_canal"], fk="_canal", sk="sk_canal", take={"nm_canal": "ds_canal"})
    f = with_dim(f, t["dim_status_ticket"], fk="sk_status_ticket", sk="sk_status", take={"ds_status": "ds_status_ticket"}, how="left")
    people = t["dim_operador"]
    people = people.withColumn("ds_equipe", optional(people, "ds_equipe", "string"))
    f = with_dim(f, people, fk="sk_operador_abertura", sk="sk_operador", take=["nm_operador", "ds_equipe"], how="left")
    share = pct(F.sum("fl_dentro_sla"), n("sk_ticket"))
    return (
        f.groupBy(
            "dt_abertura", "nr_ano", "nr_mes", "ds_dia_semana", "ds_canal", "ds_status_ticket",
            "nm_operador", "ds_equipe",
        )
        .agg(
            n("sk_ticket").alias("nr_total_tickets"),
            mean("nr_tempo_resolucao_min").alias("nr_tma_resolucao_min"),
            half_up(F.avg("nr_tempo_resolucao_min") / F.lit(60.0)).alias("nr_tma_resolucao_horas"),
            F.sum("fl_dentro_sla").alias("nr_tickets_sla_ok"),
            share.alias("pct_sla_cumprido"),
        )
        .withColumn("semaforo_sla", traffic_light("pct_sla_cumprido", (90, 75)))
    )


def dataset_digital(t, min_year: int | None = 2025) -> DataFrame:
    """Both digital channels by day, queue and operator; resolved = closed by that status."""
    def side(fact: str, key: str, resolved, kind: str) -> DataFrame:
        f = since_year(t[fact], "sk_data_inicio", min_year)
        f = f.withColumn("_fila", optional(f, "id_fila", "bigint"))
        f = with_day(f, t, "sk_data_inicio", ["dt_completa", "nr_ano", "nr_mes", "ds_dia_semana"])
        f = with_dim(f, t["dim_fila"], fk="_fila", sk="nk_fila", take={"nm_fila": "ds_fila"}, how="left")
        f = with_dim(f, t["dim_operador"], fk="sk_operador", sk="sk_operador", take=["nm_operador"], how="left")
        done = F.count(F.when(resolved, 1))
        return (
            f.groupBy("dt_completa", "nr_ano", "nr_mes", "ds_dia_semana", "ds_fila", "nm_operador")
            .agg(
                n(key).alias("nr_total_interacoes"),
                mean("nr_duracao_minutos").alias("nr_duracao_media_min"),
                done.alias("nr_resolvidos"),
                pct(done, n(key)).alias("pct_resolucao"),
            )
            .withColumn("ds_tipo_digital", F.lit(kind))
        )

    return side("fato_chat", "sk_chat", F.col("st_chat") == "ENCERRADO", "CHAT").unionByName(
        side("fato_whatsapp", "sk_whatsapp", F.col("st_atendimento") == "RESOLVIDO", "WHATSAPP")
    )


def dataset_campaign_roi(t, min_year: int | None = 2025) -> DataFrame:
    """Dials by day and campaign objective with conversions, value, cost and return."""
    f = since_year(t["fato_discagem"], "sk_data", min_year)
    f = f.withColumns(
        {
            "fl_convertido": F.coalesce(optional(f, "fl_convertido", "int"), F.lit(0)),
            "nr_valor_convertido": F.when(
                optional(f, "fl_convertido", "int") == 1, optional(f, "nr_valor_convertido", "double")
            ).otherwise(0.0),
            "nr_custo_discagem": optional(f, "nr_custo_discagem", "double"),
            "_canal": F.lit(1),
        }
    )
    f = with_day(f, t, "sk_data", ["dt_completa", "nr_ano", "nr_mes", "ds_dia_semana"])
    f = with_dim(f, t["dim_canal"], fk="_canal", sk="sk_canal", take={"nm_canal": "ds_canal"})
    camp = t["dim_campanha"]
    camp = camp.select("sk_campanha", optional(camp, "ds_objetivo", "string").alias("ds_objetivo"))
    f = with_dim(f, camp, fk="sk_campanha", sk="sk_campanha", take=["ds_objetivo"])
    rows, answered, sales = n("sk_discagem"), F.sum("fl_discagem_atendida"), F.sum("fl_convertido")
    value, cost = F.sum("nr_valor_convertido"), F.sum("nr_custo_discagem")
    return f.groupBy("dt_completa", "nr_ano", "nr_mes", "ds_dia_semana", "ds_canal", "ds_objetivo").agg(
        rows.alias("nr_total_discagens"),
        answered.alias("nr_discagens_atendidas"),
        pct(answered, rows).alias("pct_taxa_atendimento_discagem"),
        sales.alias("nr_conversoes"),
        pct(sales, answered).alias("pct_taxa_conversao"),
        half_up(value).alias("nr_valor_total_convertido"),
        mean("nr_custo_discagem", 4).alias("nr_custo_medio_discagem"),
        ratio(value, cost).alias("nr_roi_campanha"),
    )
