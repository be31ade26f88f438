"""Facts of the star schema: key resolution specs over the current-state tables.

``t`` maps names to DataFrames: current-state tables under their entity name, dimensions
and parent facts under ``dim_*`` / ``fato_*``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atende.operators.cdc import drop_tombstones
from atende.operators.keys import fact_key
from atende.operators.lookup import Lookup, resolve_keys

SK_CHAT, SK_WHATSAPP = 2, 3


@dataclass(frozen=True)
class FactSpec:
    source: str
    key: tuple[str, str, str]  # (natural column of the source, nk name, sk name)
    lookups: Callable[[], list[Lookup]]
    columns: tuple[str, ...]
    date_key: str
    computed: Callable[[], dict[str, Column]] = dict
    channel: int | str | None = None
    # Source columns kept when the current-state table was built with its extras.
    extras: tuple[str, ...] = ()


def _customer(on: str = "id_cliente") -> Lookup:
    return Lookup("dim_cliente", F.col(on), "nk_cliente", {"sk_cliente": "sk_cliente"})


def _operator(on: str = "id_operador", alias: str = "sk_operador") -> Lookup:
    return Lookup("dim_operador", F.col(on), "nk_operador", {"sk_operador": alias})


def _queue() -> Lookup:
    return Lookup("dim_fila", F.col("id_fila"), "nk_fila", {"sk_fila": "sk_fila"})


def _day(on: str, alias: str = "sk_data") -> Lookup:
    return Lookup("dim_data", F.to_date(F.col(on)), "dt_completa", {"sk_data": alias})


def _label(dim: str, on: str, natural: str, sk: str, alias: str) -> Lookup:
    return Lookup(dim, F.upper(F.col(on)), natural, {sk: alias})


FACTS: dict[str, FactSpec] = {
    "fato_chamada": FactSpec(
        source="chamada",
        key=("id_chamada", "nk_chamada", "sk_chamada"),
        lookups=lambda: [
            _customer(),
            _operator(),
            _queue(),
            _label("dim_status_chamada", "st_chamada", "ds_status", "sk_status", "sk_status_chamada"),
            _day("dt_inicio", "sk_data_inicio"),
            _day("dt_fim", "sk_data_fim"),
        ],
        channel="TELEFONE",
        columns=(
            "sk_chamada", "nk_chamada", "sk_cliente", "sk_operador", "sk_fila", "sk_canal",
            "sk_status_chamada", "sk_data_inicio", "sk_data_fim", "tp_chamada",
            "nr_duracao_segundos", "nr_duracao_minutos", "fl_duracao_valida",
            "fl_chamada_completa",
        ),
        date_key="sk_data_inicio",
        extras=("nr_espera_segundos", "nr_hora_inicio"),
        computed=lambda: {"nr_hora_inicio": F.hour("dt_inicio")},
    ),
    "fato_ticket": FactSpec(
        source="ticket",
        key=("id_ticket", "nk_ticket", "sk_ticket"),
        lookups=lambda: [
            _customer(),
            _operator(alias="sk_operador_abertura"),
            _label("dim_status_ticket", "st_ticket", "ds_status", "sk_status", "sk_status_ticket"),
            _label("dim_categoria_ticket", "ds_categoria", "nm_categoria", "sk_categoria", "sk_categoria"),
            _label("dim_prioridade_ticket", "ds_prioridade", "nm_prioridade", "sk_prioridade", "sk_prioridade"),
            _day("dt_abertura", "sk_data_abertura"),
            _day("dt_resolucao", "sk_data_fechamento"),
        ],
        columns=(
            "sk_ticket", "nk_ticket", "nr_protocolo", "sk_cliente", "sk_operador_abertura",
            "sk_status_ticket", "sk_categoria", "sk_prioridade", "sk_data_abertura",
            "sk_data_fechamento", "nr_tempo_resolucao_min", "fl_ticket_resolvido",
            "fl_dentro_sla",
        ),
        date_key="sk_data_abertura",
    ),
    "fato_chat": FactSpec(
        source="chat",
        key=("id_chat", "nk_chat", "sk_chat"),
        lookups=lambda: [
            _customer(), _operator(), _day("dt_inicio", "sk_data_inicio"), _day("dt_fim", "sk_data_fim"),
        ],
        channel=SK_CHAT,
        columns=(
            "sk_chat", "nk_chat", "sk_cliente", "sk_operador", "sk_canal", "sk_data_inicio",
            "sk_data_fim", "nr_duracao_segundos", "nr_duracao_minutos", "fl_chat_completo",
            "st_chat",
        ),
        date_key="sk_data_inicio",
        extras=("nr_satisfacao", "id_fila"),
    ),
    "fato_whatsapp": FactSpec(
        source="whatsapp_atendimento",
        key=("id_whatsapp", "nk_whatsapp", "sk_whatsapp"),
        lookups=lambda: [
            _customer(), _operator(), _day("dt_inicio", "sk_data_inicio"), _day("dt_fim", "sk_data_fim"),
        ],
        channel=SK_WHATSAPP,
        columns=(
            "sk_whatsapp", "nk_whatsapp", "sk_cliente", "sk_operador", "sk_canal",
            "sk_data_inicio", "sk_data_fim", "nr_telefone_mascarado", "nr_duracao_segundos",
            "nr_duracao_minutos", "fl_atendimento_completo", "st_atendimento",
        ),
        date_key="sk_data_inicio",
        extras=("nr_satisfacao",),
    ),
    "fato_discagem": FactSpec(
        source="discagem",
        key=("id_discagem", "nk_discagem", "sk_discagem"),
        lookups=lambda: [
            Lookup("dim_campanha", F.col("id_campanha"), "nk_campanha", {"sk_campanha": "sk_campanha"}),
            _customer(),
            _day("dt_ultima_tentativa"),
        ],
        columns=(
            "sk_discagem", "nk_discagem", "sk_campanha", "sk_cliente", "sk_data",
            "nr_telefone_mascarado", "st_discagem", "fl_discagem_atendida",
            "fl_discagem_nao_atendida",
        ),
        date_key="sk_data",
        extras=("nr_tentativas", "fl_convertido", "nr_valor_convertido", "nr_custo_discagem"),
    ),
    "fato_jornada_operador": FactSpec(
        source="jornada_operador",
        key=("id_jornada", "nk_jornada", "sk_jornada"),
        lookups=lambda: [_operator(), _day("dt_jornada")],
        columns=(
            "sk_jornada", "nk_jornada", "sk_operador", "sk_data", "nr_horas_trabalhadas",
            "nr_chamadas_atendidas", "nr_tickets_resolvidos", "st_presenca", "fl_presente",
        ),
        date_key="sk_data",
    ),
    "fato_metricas_operacionais": FactSpec(
        source="metricas_operacionais",
        key=("id_metrica", "nk_metrica", "sk_metrica"),
        lookups=lambda: [_queue(), _day("dt_referencia")],
        computed=lambda: {
            "nr_chamadas_recebidas": F.col("nr_chamadas_atendidas") + F.col("nr_chamadas_abandonadas")
        },
        columns=(
            "sk_metrica", "nk_metrica", "sk_fila", "sk_data", "nr_chamadas_recebidas",
            "nr_chamadas_atendidas", "nr_chamadas_abandonadas", "nr_tma_segundos",
            "nr_tma_minutos", "nr_tme_segundos", "nr_tme_minutos", "nr_nivel_servico",
            "nr_taxa_atendimento", "nr_taxa_abandono", "fl_meta_nivel_servico",
            "fl_alto_abandono",
        ),
        date_key="sk_data",
    ),
    "fato_qualidade": FactSpec(
        source="avaliacao_qualidade",
        key=("id_avaliacao", "nk_avaliacao", "sk_avaliacao"),
        lookups=lambda: [
            Lookup(
                "fato_chamada", F.col("id_chamada"), "nk_chamada",
                {"sk_chamada": "sk_chamada", "sk_operador": "sk_operador_avaliado"},
            ),
            _operator("id_supervisor", "sk_avaliador"),
            _day("dt_avaliacao"),
        ],
        computed=lambda: {"nr_nota": F.col("nr_nota_geral")},
        columns=(
            "sk_avaliacao", "nk_avaliacao", "sk_chamada", "sk_operador_avaliado",
            "sk_avaliador", "sk_data", "nr_nota", "ds_faixa_nota", "fl_aprovado",
            "fl_critico", "fl_tem_feedback", "nr_tamanho_feedback_chars",
        ),
        date_key="sk_data",
        extras=("nr_nota_comunicacao", "nr_nota_resolucao"),
    ),
    "fato_interacao_ticket": FactSpec(
        source="interacao_ticket",
        key=("id_interacao", "nk_interacao", "sk_interacao"),
        lookups=lambda: [
            Lookup("fato_ticket", F.col("id_ticket"), "nk_ticket", {"sk_ticket": "sk_ticket"}),
            _operator(),
            _day("dt_interacao"),
        ],
        computed=lambda: {"ds_canal": F.col("ds_tipo_interacao")},
        columns=(
            "sk_interacao", "nk_interacao", "sk_ticket", "sk_operador", "sk_data", "ds_canal",
            "nr_tamanho_observacao_chars", "fl_tem_observacao",
        ),
        date_key="sk_data",
    ),
    "fato_mensagem_chat": FactSpec(
        source="mensagem_chat",
        key=("id_mensagem", "nk_mensagem", "sk_mensagem"),
        lookups=lambda: [
            Lookup("fato_chat", F.col("id_chat"), "nk_chat", {"sk_chat": "sk_chat"}),
            _day("dt_mensagem"),
        ],
        columns=(
            "sk_mensagem", "nk_mensagem", "sk_chat", "sk_data", "ds_remetente",
            "nr_tamanho_chars", "fl_mensagem_cliente", "fl_mensagem_operador",
        ),
        date_key="sk_data",
    ),
    "fato_ura_navegacao": FactSpec(
        source="ura_navegacao",
        key=("id_ura", "nk_ura", "sk_ura"),
        lookups=lambda: [
            Lookup("fato_chamada", F.col("id_chamada"), "nk_chamada", {"sk_chamada": "sk_chamada"}),
            _day("dt_navegacao"),
        ],
        columns=(
            "sk_ura", "nk_ura", "sk_chamada", "sk_data", "ds_opcao_selecionada",
            "nr_duracao_segundos", "fl_abandonou_ura", "ds_faixa_espera",
        ),
        date_key="sk_data",
        extras=("fl_transferiu_humano", "nr_tentativas"),
    ),
}


def _with_channel(df: DataFrame, dims, channel: int | str) -> DataFrame:
    """Constant channel key; a channel name is looked up once (fallback 1)."""
    if isinstance(channel, int):
        return df.withColumn("sk_canal", F.lit(channel))
    found = dims["dim_canal"].filter(F.upper("nm_canal") == channel).agg(F.min("sk_canal")).scalar()
    return df.withColumn("sk_canal", F.coalesce(found, F.lit(1)))


def build_fact(name: str, t, *, extended: bool = False) -> DataFrame:
    """Resolve all keys of one fact. ``extended`` keeps the optional source columns."""
    spec = FACTS[name]
    natural, nk, sk = spec.key
    rows = drop_tombstones(t[spec.source]).withColumns(spec.computed())
    extras = [c for c in spec.extras if extended and c in rows.columns]
    out = resolve_keys(rows, t, spec.lookups())
    if spec.channel is not None:
        out = _with_channel(out, t, spec.channel)
    # The keys of the row itself come last, so that the joins carry the natural key once.
    return out.withColumns({sk: fact_key(natural), nk: F.col(natural)}).select(*spec.columns, *extras)
