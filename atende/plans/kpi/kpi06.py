"""Digital channel volume (chat and WhatsApp)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import minutes_from_seconds, pct, ratio
from atende.operators.lookup import with_dim
from atende.plans.kpi.common import mean, mean_if, n, n_if, optional, top, with_day, year_month

DAY = ["dt_completa", "nr_ano", "nr_mes", "nr_dia", "ds_dia_semana", "fl_fim_de_semana"]
SESSION = [
    "sk_chat", "ds_canal", "ds_tipo_canal_digital", *DAY, "ds_ano_mes", "nr_duracao_segundos",
    "nr_duracao_minutos",
]


def _sessions(t, fact: str) -> DataFrame:
    f = with_dim(t[fact], t["dim_canal"], fk="sk_canal", sk="sk_canal", take={"nm_canal": "ds_canal"})
    return with_day(f, t, "sk_data_inicio", DAY).withColumns(
        {"ds_ano_mes": year_month(), "nr_duracao_minutos": minutes_from_seconds("nr_duracao_segundos")}
    )


def kpi06_chat_base(t) -> DataFrame:
    name = F.upper("ds_canal")
    digital = F.contains(name, F.lit("CHAT")) | F.contains(name, F.lit("WHATSAPP"))
    kind = (
        F.when(F.contains(name, F.lit("WHATSAPP")), "WHATSAPP")
        .when(F.contains(name, F.lit("CHAT")), "CHAT")
        .otherwise("OUTRO_DIGITAL")
    )
    return (
        _sessions(t, "fato_chat")
        .filter(digital)
        .withColumn("ds_tipo_canal_digital", kind)
        .select("sk_chat", "sk_cliente", "sk_operador", "sk_canal", *SESSION[1:])
    )


def kpi06_whatsapp_base(t) -> DataFrame:
    return (
        _sessions(t, "fato_whatsapp")
        .withColumn("ds_tipo_canal_digital", F.lit("WHATSAPP"))
        .select("sk_whatsapp", "sk_cliente", "sk_operador", "sk_canal", *SESSION[1:])
    )


def kpi06_messages_per_session(t, agent: str = "AGENTE") -> DataFrame:
    """Message counts per chat; response times are used where the fact has them."""
    f = t["fato_mensagem_chat"]
    return f.groupBy("sk_chat").agg(
        n("sk_mensagem").alias("nr_total_mensagens"),
        n_if(F.col("ds_remetente") == "CLIENTE").alias("nr_mensagens_cliente"),
        n_if(F.col("ds_remetente") == agent).alias("nr_mensagens_agente"),
        F.avg(optional(f, "nr_tempo_resposta_seg", "double")).alias("nr_tempo_medio_resposta_seg"),
    )


def kpi06_unified(t, agent: str = "AGENTE") -> DataFrame:
    counts = ["nr_total_mensagens", "nr_mensagens_cliente", "nr_mensagens_agente"]
    chats = (
        kpi06_chat_base(t)
        .join(kpi06_messages_per_session(t, agent), "sk_chat", "left")
        .select(
            *SESSION,
            *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
            F.coalesce("nr_tempo_medio_resposta_seg", F.lit(0.0)).alias("nr_tempo_resposta_seg"),
        )
    )
    whatsapp = kpi06_whatsapp_base(t).select(
        F.col("sk_whatsapp").alias("sk_chat"),
        *SESSION[1:],
        *[F.lit(0).cast("bigint").alias(c) for c in counts],
        F.lit(0.0).alias("nr_tempo_resposta_seg"),
    )
    return chats.unionByName(whatsapp)


def _daily(t, agent: str) -> DataFrame:
    rows, long = n("sk_chat"), n_if(F.col("nr_duracao_segundos") > 1800)
    return (
        kpi06_unified(t, agent)
        .groupBy(*DAY, "ds_ano_mes", "ds_tipo_canal_digital")
        .agg(
            rows.alias("nr_total_sessoes"),
            mean("nr_duracao_minutos").alias("nr_duracao_media_minutos"),
            mean("nr_duracao_segundos").alias("nr_duracao_media_segundos"),
            F.max("nr_duracao_segundos").alias("nr_duracao_maxima_seg"),
            F.min("nr_duracao_segundos").alias("nr_duracao_minima_seg"),
            mean("nr_total_mensagens").alias("nr_media_mensagens_sessao"),
            mean("nr_mensagens_cliente").alias("nr_media_msg_cliente"),
            mean("nr_mensagens_agente").alias("nr_media_msg_agente"),
            F.sum("nr_total_mensagens").alias("nr_total_mensagens_dia"),
            mean_if(F.col("nr_tempo_resposta_seg") > 0, "nr_tempo_resposta_seg").alias("nr_tma_resposta_seg"),
            long.alias("nr_sessoes_longas"),
            pct(long, rows).alias("pct_sessoes_longas"),
        )
    )


def kpi06_daily_channel(t, agent: str = "AGENTE", limit: int | None = None) -> DataFrame:
    sessions = F.col("nr_total_sessoes")
    out = (
        _daily(t, agent)
        .drop("ds_ano_mes", "nr_duracao_minima_seg")
        .withColumns(
            {
                "ds_classificacao_volume": F.when(sessions > 500, "ALTO_VOLUME").when(sessions > 200, "VOLUME_NORMAL").otherwise("BAIXO_VOLUME"),
                "nr_mensagens_por_minuto": ratio(F.col("nr_media_mensagens_sessao"), F.col("nr_duracao_media_minutos")),
            }
        )
    )
    return top(out, [("dt_completa", True), ("nr_total_sessoes", True), ("ds_tipo_canal_digital", False)], limit)


def kpi06_monthly_trend(t, agent: str = "AGENTE") -> DataFrame:
    return _daily(t, agent).groupBy("ds_ano_mes", "nr_ano", "nr_mes", "ds_tipo_canal_digital").agg(
        F.sum("nr_total_sessoes").alias("nr_sessoes_mes"),
        mean("nr_duracao_media_minutos").alias("nr_duracao_media_mes"),
        mean("nr_media_mensagens_sessao").alias("nr_media_msg_mes"),
    )
