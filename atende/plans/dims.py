"""Dimensions of the star schema. Each builder takes a mapping of current-state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atende.functions import rules as R
from atende.operators.cdc import cdc_dedup_latest, drop_tombstones
from atende.operators.keys import (
    UNKNOWN_KEY,
    distinct_value_dim,
    keyed,
    unknown_member,
)
from atende.sources.stage import staged

NOT_GIVEN = "NAO_INFORMADO"

# The channel list and its keys.
CHANNELS = [
    (1, "TELEFONE", "VOZ", "Atendimento via chamada telefônica", 1, 1),
    (2, "CHAT", "DIGITAL", "Atendimento via chat web", 1, 1),
    (3, "WHATSAPP", "DIGITAL", "Atendimento via WhatsApp", 1, 1),
    (4, "EMAIL", "DIGITAL", "Atendimento via e-mail", 1, 0),
    (5, "URA", "VOZ", "Atendimento automatizado via URA/IVR", 1, 0),
    (6, "DESCONHECIDO", "OUTROS", "Canal não identificado", 0, 0),
]


def dim_data(spark: SparkSession, start: str = "2015-01-01", end: str = "2030-12-31") -> DataFrame:
    """One row per day of the range, plus the unknown row."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("dt_completa")
    )
    attributes = R.calendar_attributes("dt_completa")
    dim = days.select(
        R.date_key("dt_completa").alias("sk_data"),
        "dt_completa",
        *[c.alias(n) for n, c in attributes.items()],
    )
    values = {n: UNKNOWN_KEY for n in attributes if n.startswith("nr_")}
    values |= {n: R.UNKNOWN for n in attributes if n.startswith("ds_")}
    values |= {n: 0 for n in attributes if n.startswith("fl_")}
    return unknown_member(dim, {"sk_data": UNKNOWN_KEY, **values})


def dim_canal(spark: SparkSession) -> DataFrame:
    names = ("sk_canal", "nm_canal", "ds_tipo_canal", "ds_descricao", "fl_canal_ativo", "fl_canal_digital")
    rows = [
        F.struct(
            *[
                F.lit(v).cast("smallint" if n.startswith("fl_") else "int").alias(n)
                if isinstance(v, int) else F.lit(v).alias(n)
                for n, v in zip(names, channel)
            ]
        )
        for channel in CHANNELS
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def dim_cliente(s) -> DataFrame:
    """Customers with the latest address of each, keyed by natural key."""
    customers = drop_tombstones(s["cliente"]).select(
        F.col("id_cliente").alias("nk_cliente"),
        "nm_cliente", "nr_documento_mascarado", "ds_email_mascarado",
        "nr_telefone_mascarado", "dt_cadastro", "st_cliente", "fl_cliente_ativo",
    )
    place = ["ds_cidade", "ds_estado", "ds_bairro", "nr_cep_mascarado"]
    addresses = cdc_dedup_latest(
        drop_tombstones(s["endereco_cliente"]), keys=["id_cliente"], order=["dt_cdc_evento", "id_endereco"]
    ).select("id_cliente", *place)
    members = keyed(customers, s, "dim_cliente", order=["nk_cliente"], name="sk_cliente")
    joined = members.join(addresses, F.col("nk_cliente") == F.col("id_cliente"), "left").drop("id_cliente")
    filled = joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit("" if c.startswith("nr_") else NOT_GIVEN)) for c in place}
    )
    dim = filled.select("sk_cliente", *customers.columns, *place)
    return unknown_member(
        dim,
        {
            "sk_cliente": UNKNOWN_KEY, "nk_cliente": UNKNOWN_KEY, "nm_cliente": R.UNKNOWN,
            "nr_documento_mascarado": "", "ds_email_mascarado": "", "nr_telefone_mascarado": "",
            "st_cliente": "D", "fl_cliente_ativo": 0, "ds_cidade": NOT_GIVEN,
            "ds_estado": NOT_GIVEN, "ds_bairro": NOT_GIVEN, "nr_cep_mascarado": "",
        },
    )


def dim_operador(s) -> DataFrame:
    """Operators; the supervisor is resolved to the key of another operator."""
    silver = s["operador"]
    team = ["ds_equipe"] if "ds_equipe" in silver.columns else []
    rows = drop_tombstones(silver).select(
        F.col("id_operador").alias("nk_operador"),
        "nm_operador", "ds_login_mascarado", "ds_email_mascarado", "dt_admissao",
        "st_operador", "fl_operador_ativo", "nr_dias_casa", "ds_faixa_tempo_casa",
        F.col("id_supervisor").alias("nk_supervisor"), *team,
    )
    members = keyed(rows, s, "dim_operador", order=["nk_operador"], name="sk_operador")
    bosses = members.select(
        F.col("nk_operador").alias("_boss"), F.col("sk_operador").alias("_sk_boss")
    )
    dim = (
        members.join(bosses, F.col("nk_supervisor") == F.col("_boss"), "left")
        .withColumn("sk_supervisor", F.coalesce("_sk_boss", F.lit(UNKNOWN_KEY)))
        .select(
            "sk_operador", "nk_operador", "nm_operador", "ds_login_mascarado",
            "ds_email_mascarado", "dt_admissao", "st_operador", "fl_operador_ativo",
            "nr_dias_casa", "ds_faixa_tempo_casa", "sk_supervisor", "nk_supervisor", *team,
        )
    )
    return unknown_member(
        dim,
        {
            "sk_operador": UNKNOWN_KEY, "nk_operador": UNKNOWN_KEY, "nm_operador": R.UNKNOWN,
            "ds_login_mascarado": "", "ds_email_mascarado": "", "st_operador": "D",
            "fl_operador_ativo": 0, "nr_dias_casa": 0, "ds_faixa_tempo_casa": R.UNKNOWN,
            "sk_supervisor": UNKNOWN_KEY, "nk_supervisor": UNKNOWN_KEY,
            **({"ds_equipe": R.UNKNOWN} if team else {}),
        },
    )


def dim_supervisor(operators: DataFrame) -> DataFrame:
    """Operators that appear as somebody's supervisor."""
    used = operators.filter(F.col("sk_supervisor") != UNKNOWN_KEY).select(
        F.col("sk_supervisor").alias("_used")
    )
    dim = operators.join(used, F.col("sk_operador") == F.col("_used"), "left_semi").select(
        F.col("sk_operador").alias("sk_supervisor"),
        F.col("nk_operador").alias("nk_supervisor"),
        F.col("nm_operador").alias("nm_supervisor"),
        "ds_email_mascarado", "dt_admissao", "st_operador", "fl_operador_ativo",
        "nr_dias_casa", "ds_faixa_tempo_casa",
    )
    return unknown_member(
        dim,
        {
            "sk_supervisor": UNKNOWN_KEY, "nk_supervisor": UNKNOWN_KEY,
            "nm_supervisor": R.UNKNOWN, "ds_email_mascarado": "", "st_operador": "D",
            "fl_operador_ativo": 0, "nr_dias_casa": 0, "ds_faixa_tempo_casa": R.UNKNOWN,
        },
    )


def dim_status_chamada(s) -> DataFrame:
    label = F.col("ds_status")
    return distinct_value_dim(
        s["chamada"], tables=s, dim="dim_status_chamada", column="st_chamada", label="ds_status", key="sk_status",
        flags={
            "fl_chamada_concluida": R.flag(label.isin("ATENDIDA", "CONCLUIDA")),
            "fl_chamada_abandonada": R.flag(label.isin("ABANDONADA", "ABANDONO")),
        },
        unknown={"fl_chamada_concluida": 0, "fl_chamada_abandonada": 0},
    )


def dim_status_ticket(s) -> DataFrame:
    label = F.col("ds_status")
    flags = {
        "fl_ticket_aberto": R.flag(label == "ABERTO"),
        "fl_ticket_resolvido": R.flag_resolved(label),
        "fl_ticket_cancelado": R.flag(label == "CANCELADO"),
    }
    return distinct_value_dim(
        s["ticket"], tables=s, dim="dim_status_ticket", column="st_ticket", label="ds_status", key="sk_status",
        flags=flags, unknown=dict.fromkeys(flags, 0),
    )


def dim_categoria_ticket(s) -> DataFrame:
    return distinct_value_dim(
        s["ticket"], tables=s, dim="dim_categoria_ticket", column="ds_categoria", label="nm_categoria", key="sk_categoria"
    )


def dim_prioridade_ticket(s, order: tuple[str, ...] = ("CRITICA", "ALTA", "MEDIA", "BAIXA")) -> DataFrame:
    label = F.col("nm_prioridade")
    position = F.lit(99)
    for i, name in enumerate(order, 1):
        position = F.when(label == name, i).otherwise(position)
    return distinct_value_dim(
        s["ticket"], tables=s, dim="dim_prioridade_ticket", column="ds_prioridade", label="nm_prioridade", key="sk_prioridade",
        flags={
            "nr_ordem_prioridade": position,
            "fl_prioridade_critica": R.flag(label == order[0]),
        },
        unknown={"nr_ordem_prioridade": 99, "fl_prioridade_critica": 0},
    )


def dim_skill(s) -> DataFrame:
    rows = staged(
        drop_tombstones(s["skill_operador"])
        .filter(F.col("ds_skill") != R.UNKNOWN)
        .select("ds_skill", "nr_nivel", "ds_faixa_nivel")
        .distinct()
    )
    members = keyed(rows, s, "dim_skill", order=["ds_skill", "nr_nivel"], name="sk_skill")
    dim = members.select("sk_skill", "ds_skill", "nr_nivel", "ds_faixa_nivel")
    return unknown_member(
        dim,
        {"sk_skill": UNKNOWN_KEY, "ds_skill": R.UNKNOWN, "nr_nivel": 0, "ds_faixa_nivel": R.UNKNOWN},
    )


def dim_campanha(s) -> DataFrame:
    silver = s["campanha"]
    extras = [
        c for c in ("ds_objetivo", "nr_meta_contatos", "nr_contatos_realizados", "nr_conversoes")
        if c in silver.columns
    ]
    rows = drop_tombstones(silver).select(
        F.col("id_campanha").alias("nk_campanha"),
        "nm_campanha", "dt_inicio", "dt_fim", "st_campanha", "nr_duracao_dias",
        "fl_campanha_ativa", "fl_campanha_vigente", *extras,
    )
    dim = keyed(rows, s, "dim_campanha", order=["nk_campanha"], name="sk_campanha").select(
        "sk_campanha", *rows.columns
    )
    return unknown_member(
        dim,
        {
            "sk_campanha": UNKNOWN_KEY, "nk_campanha": UNKNOWN_KEY, "nm_campanha": R.UNKNOWN,
            "st_campanha": R.UNKNOWN, "fl_campanha_ativa": 0, "fl_campanha_vigente": 0,
        },
    )


def dim_fila(
    s, voice: tuple[str, ...] = ("TELEFONE",), digital: tuple[str, ...] = ("CHAT", "WHATSAPP", "EMAIL")
) -> DataFrame:
    silver = s["fila_atendimento"]
    extras = [c for c in ("nr_capacidade_max",) if c in silver.columns]
    rows = drop_tombstones(silver).select(
        F.col("id_fila").alias("nk_fila"),
        "nm_fila",
        F.col("ds_tipo_fila").alias("ds_tipo_canal"),
        "nr_sla_segundos",
        "nr_sla_minutos",
        R.flag(F.col("ds_tipo_fila").isin(*voice)).alias("fl_fila_voz"),
        R.flag(F.col("ds_tipo_fila").isin(*digital)).alias("fl_fila_digital"),
        *extras,
    )
    dim = keyed(rows, s, "dim_fila", order=["nk_fila"], name="sk_fila").select("sk_fila", *rows.columns)
    return unknown_member(
        dim,
        {
            "sk_fila": UNKNOWN_KEY, "nk_fila": UNKNOWN_KEY, "nm_fila": R.UNKNOWN,
            "ds_tipo_canal": R.UNKNOWN, "nr_sla_segundos": 0, "nr_sla_minutos": 0.0,
            "fl_fila_voz": 0, "fl_fila_digital": 0,
        },
    )
