"""Current-state tables: one builder, one spec per entity.

A spec names the key, the cleaning of the raw string columns, the derived columns, the
columns that enter the row hash and the ordered rejection rules. ``build_silver`` runs the
same steps for each: decode -> latest event per key -> clean -> derive -> hash -> split.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atende.functions import privacy as P
from atende.functions import rules as R
from atende.functions.casts import digits, lower_text, safe_cast, upper_text
from atende.operators import cdc

CDC = ("dt_cdc_evento", "op_cdc", "hash_registro")


@dataclass(frozen=True)
class SilverSpec:
    key: tuple[str, ...]
    columns: tuple[str, ...]
    clean: dict[str, Column]
    hashed: tuple[str, ...]
    rules: tuple[tuple[Column, str], ...]
    derive: tuple[dict[str, Column], ...] = ()
    partition: tuple[str, tuple[str, ...]] | None = None
    # Columns beyond the base schema that the KPI queries can use when they are present.
    extras: dict[str, Column] = field(default_factory=dict)
    # Columns taken from the source when it has them, else a typed NULL.
    optional: dict[str, str] = field(default_factory=dict)
    # Derived columns that read what is not stored; all others follow from stored columns.
    early: tuple[str, ...] = ()


def _long(name: str, default: int | None = None) -> Column:
    c = safe_cast(name, "bigint")
    return c if default is None else F.coalesce(c, F.lit(default).cast("bigint"))


def _int(name: str, default: int | None = None) -> Column:
    c = safe_cast(name, "int")
    return c if default is None else F.coalesce(c, F.lit(default))


def _double(name: str, default: float | None = None) -> Column:
    c = safe_cast(name, "double")
    return c if default is None else F.coalesce(c, F.lit(default))


def _ts(name: str) -> Column:
    return safe_cast(name, "timestamp")


def _date(name: str) -> Column:
    return safe_cast(name, "date")


def _null(name: str, reason: str | None = None) -> tuple[Column, str]:
    return F.col(name).isNull(), reason or f"{name}_nulo"


YMD = ("ano", "mes", "dia")


def _chamada(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_chamada",),
        clean={
            "id_chamada": _long("id_chamada"),
            "id_cliente": _long("id_cliente"),
            "id_operador": _long("id_operador", -1),
            "id_fila": _long("id_fila", -1),
            "nr_telefone_origem": digits("nr_telefone_origem", keep_plus=True),
            "nr_telefone_destino": digits("nr_telefone_destino", keep_plus=True),
            "dt_inicio": _ts("dt_inicio"),
            "dt_fim": _ts("dt_fim"),
            "nr_duracao_segundos": _int("nr_duracao_segundos", 0),
            "st_chamada": upper_text("st_chamada", R.UNKNOWN),
            "tp_chamada": upper_text("tp_chamada", R.UNKNOWN),
        },
        derive=(
            {
                "fl_duracao_valida": R.flag_valid_duration("nr_duracao_segundos", "dt_inicio", "dt_fim"),
                "fl_chamada_completa": R.flag_complete("dt_inicio", "dt_fim"),
                "nr_duracao_minutos": R.minutes_from_seconds("nr_duracao_segundos"),
            },
        ),
        columns=(
            "id_chamada", "id_cliente", "id_operador", "id_fila", "nr_telefone_origem",
            "nr_telefone_destino", "dt_inicio", "dt_fim", "nr_duracao_segundos", "st_chamada",
            "tp_chamada", "fl_duracao_valida", "fl_chamada_completa", "nr_duracao_minutos",
        ),
        hashed=(
            "id_chamada", "id_cliente", "id_operador", "id_fila", "dt_inicio", "dt_fim",
            "nr_duracao_segundos", "st_chamada", "tp_chamada",
        ),
        rules=(
            _null("id_chamada"),
            _null("id_cliente"),
            _null("dt_inicio"),
            (F.col("nr_duracao_segundos") < 0, "duracao_negativa"),
        ),
        partition=("dt_inicio", YMD),
        extras={"nr_espera_segundos": _int("nr_espera_segundos")},
    )


def _cliente(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_cliente",),
        clean={
            "id_cliente": _long("id_cliente"),
            "nm_cliente": upper_text("nm_cliente"),
            "dt_cadastro": safe_cast("dt_cadastro", "timestamp", "yyyy-MM-dd"),
            "st_cliente": upper_text("st_cliente", "A"),
            "_email": lower_text("ds_email", ""),
            "_documento": digits("nr_documento"),
            "_telefone": digits("nr_telefone", keep_plus=True),
        },
        derive=(
            {
                "nr_documento_mascarado": P.mask_document("_documento"),
                "ds_email_mascarado": P.mask_email("_email"),
                "nr_telefone_mascarado": P.mask_phone("_telefone"),
                "fl_cliente_ativo": R.flag_active("st_cliente"),
                "fl_tem_email": R.flag_has("_email"),
                "fl_tem_telefone": R.flag_has("_telefone"),
                "fl_tem_documento": R.flag_has("_documento"),
            },
        ),
        columns=(
            "id_cliente", "nm_cliente", "nr_documento_mascarado", "ds_email_mascarado",
            "nr_telefone_mascarado", "dt_cadastro", "st_cliente", "fl_cliente_ativo",
            "fl_tem_email", "fl_tem_telefone", "fl_tem_documento",
        ),
        hashed=(
            "id_cliente", "nm_cliente", "nr_documento_mascarado", "ds_email_mascarado",
            "nr_telefone_mascarado", "st_cliente", "dt_cadastro",
        ),
        rules=(_null("id_cliente"), _null("nm_cliente"), _null("dt_cadastro")),
        partition=("dt_cadastro", ("ano", "mes")),
        early=(
            "nr_documento_mascarado", "ds_email_mascarado", "nr_telefone_mascarado", "fl_tem_email", "fl_tem_telefone",
            "fl_tem_documento",
        ),
    )


def _endereco_cliente(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_endereco",),
        clean={
            "id_endereco": _long("id_endereco"),
            "id_cliente": _long("id_cliente"),
            "ds_logradouro": upper_text("ds_logradouro", ""),
            "nr_numero": F.lit(""),
            "ds_bairro": upper_text("ds_bairro", ""),
            "ds_cidade": upper_text("ds_cidade", ""),
            "ds_estado": upper_text("ds_estado", ""),
            "nr_cep_mascarado": P.mask_postal_code(digits("nr_cep")),
        },
        columns=(
            "id_endereco", "id_cliente", "ds_logradouro", "nr_numero", "ds_bairro",
            "ds_cidade", "ds_estado", "nr_cep_mascarado",
        ),
        hashed=(
            "id_endereco", "id_cliente", "ds_logradouro", "nr_numero", "ds_bairro",
            "ds_cidade", "ds_estado", "nr_cep_mascarado",
        ),
        rules=(_null("id_endereco"), _null("id_cliente")),
    )


def _operador(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_operador",),
        clean={
            "id_operador": _long("id_operador"),
            "nm_operador": upper_text("nm_operador"),
            "ds_email_mascarado": P.mask_email(lower_text("ds_email", "")),
            # The e-mail doubles as the login.
            "ds_login_mascarado": P.mask_login(lower_text("ds_email", "")),
            "dt_admissao": _date("dt_admissao"),
            "st_operador": upper_text("st_operador", "A"),
            "fl_tem_supervisor": R.flag(safe_cast("fl_supervisor", "boolean")),
        },
        derive=(
            {
                "fl_operador_ativo": R.flag_active("st_operador"),
                "nr_dias_casa": R.tenure_days("dt_admissao", as_of),
                "ds_faixa_tempo_casa": R.band_tenure(R.tenure_days("dt_admissao", as_of)),
            },
        ),
        columns=(
            "id_operador", "nm_operador", "ds_email_mascarado", "ds_login_mascarado",
            "dt_admissao", "st_operador", "id_supervisor", "fl_operador_ativo",
            "fl_tem_supervisor", "nr_dias_casa", "ds_faixa_tempo_casa",
        ),
        hashed=(
            "id_operador", "nm_operador", "ds_email_mascarado", "ds_login_mascarado",
            "dt_admissao", "st_operador", "id_supervisor",
        ),
        rules=(
            _null("id_operador"),
            _null("nm_operador"),
            (F.col("ds_login_mascarado") == "", "ds_login_vazio"),
            _null("dt_admissao", "dt_admissao_nula"),
        ),
        partition=("dt_admissao", ("ano_admissao", "mes_admissao")),
        extras={"ds_equipe": upper_text("ds_equipe", R.UNKNOWN)},
        optional={"id_supervisor": "bigint"},
    )


def _skill_operador(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_skill", "id_operador"),
        clean={
            "id_skill": _long("id_skill"),
            "id_operador": _long("id_operador"),
            "ds_skill": upper_text("ds_skill", R.UNKNOWN),
            "nr_nivel": _int("nr_nivel", 0),
        },
        derive=({"ds_faixa_nivel": R.band_skill_level("nr_nivel")},),
        columns=("id_skill", "id_operador", "ds_skill", "nr_nivel", "ds_faixa_nivel"),
        hashed=("id_skill", "id_operador", "ds_skill", "nr_nivel"),
        rules=(_null("id_skill"), _null("id_operador"), _null("ds_skill")),
    )


def _fila_atendimento(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_fila",),
        clean={
            "id_fila": _long("id_fila"),
            "nm_fila": upper_text("nm_fila", R.UNKNOWN),
            "ds_tipo_fila": upper_text("ds_tipo_fila", R.UNKNOWN),
            # The source has no service-level target.
            "nr_sla_segundos": F.lit(None).cast("int"),
            "nr_sla_minutos": F.lit(None).cast("double"),
        },
        columns=("id_fila", "nm_fila", "ds_tipo_fila", "nr_sla_segundos", "nr_sla_minutos"),
        hashed=("id_fila", "nm_fila", "ds_tipo_fila", "nr_sla_segundos"),
        rules=(_null("id_fila"), _null("nm_fila")),
        extras={"nr_capacidade_max": _int("nr_capacidade_max")},
    )


def _gravacao_chamada(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_gravacao",),
        clean={
            "id_gravacao": _long("id_gravacao"),
            "id_chamada": _long("id_chamada"),
            "nr_tamanho_mb": _double("nr_tamanho_mb", 0.0),
            "dt_gravacao": _date("dt_gravacao"),
            "fl_tem_gravacao": P.has_text("ds_url_gravacao"),
        },
        derive=(
            {
                "fl_expirada": R.flag_expired("dt_gravacao", as_of),
                "nr_dias_para_expirar": R.days_to_expire("dt_gravacao", as_of),
            },
        ),
        columns=(
            "id_gravacao", "id_chamada", "nr_tamanho_mb", "dt_gravacao", "fl_tem_gravacao",
            "fl_expirada", "nr_dias_para_expirar",
        ),
        hashed=("id_gravacao", "id_chamada", "nr_tamanho_mb", "dt_gravacao"),
        rules=(_null("id_gravacao"), _null("id_chamada")),
    )


def _ticket(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_ticket",),
        clean={
            "id_ticket": _long("id_ticket"),
            "nr_protocolo": _long("id_ticket").cast("string"),
            "id_cliente": _long("id_cliente"),
            "id_operador": _long("id_operador", -1),
            "ds_titulo": F.col("ds_titulo"),
            "ds_categoria": upper_text("ds_categoria", R.UNKNOWN),
            "ds_prioridade": upper_text("ds_prioridade", R.UNKNOWN),
            "st_ticket": upper_text("st_ticket", R.UNKNOWN),
            "dt_abertura": _ts("dt_abertura"),
            "dt_resolucao": _ts("dt_resolucao"),
        },
        derive=(
            {
                "nr_tempo_resolucao_min": R.resolution_minutes("dt_abertura", "dt_resolucao"),
                "fl_ticket_resolvido": R.flag_resolved("st_ticket"),
            },
            {"fl_dentro_sla": R.flag_within_sla("nr_tempo_resolucao_min")},
        ),
        columns=(
            "id_ticket", "nr_protocolo", "id_cliente", "id_operador", "ds_titulo",
            "ds_categoria", "ds_prioridade", "st_ticket", "dt_abertura", "dt_resolucao",
            "nr_tempo_resolucao_min", "fl_ticket_resolvido", "fl_dentro_sla",
        ),
        hashed=(
            "id_ticket", "nr_protocolo", "id_cliente", "id_operador", "dt_abertura",
            "dt_resolucao", "ds_categoria", "ds_prioridade", "st_ticket",
        ),
        rules=(
            _null("id_ticket"),
            _null("nr_protocolo"),
            _null("id_cliente"),
            _null("dt_abertura", "dt_abertura_nula"),
        ),
        partition=("dt_abertura", YMD),
    )


def _interacao_ticket(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_interacao",),
        clean={
            "id_interacao": _long("id_interacao"),
            "id_ticket": _long("id_ticket"),
            "id_operador": _long("id_operador", -1),
            "dt_interacao": _ts("dt_interacao"),
            "ds_tipo_interacao": upper_text("ds_tipo_interacao", R.UNKNOWN),
            "nr_tamanho_observacao_chars": P.text_length("ds_descricao"),
            "fl_tem_observacao": P.has_text("ds_descricao"),
        },
        columns=(
            "id_interacao", "id_ticket", "id_operador", "dt_interacao", "ds_tipo_interacao",
            "nr_tamanho_observacao_chars", "fl_tem_observacao",
        ),
        hashed=("id_interacao", "id_ticket", "id_operador", "dt_interacao", "ds_tipo_interacao"),
        rules=(
            _null("id_interacao"),
            _null("id_ticket"),
            _null("dt_interacao", "dt_interacao_nula"),
        ),
        partition=("dt_interacao", YMD),
    )


def _avaliacao_qualidade(as_of: Column) -> SilverSpec:
    score = F.col("nr_nota_geral")
    return SilverSpec(
        key=("id_avaliacao",),
        clean={
            "id_avaliacao": _long("id_avaliacao"),
            "id_chamada": _long("id_chamada"),
            "id_operador": _long("id_operador"),
            "id_supervisor": _long("id_supervisor", -1),
            "nr_nota_geral": _double("nr_nota_geral", 0.0),
            "dt_avaliacao": _ts("dt_avaliacao"),
            "nr_tamanho_feedback_chars": P.text_length("ds_feedback"),
            "fl_tem_feedback": P.has_text("ds_feedback"),
        },
        derive=(
            {
                "ds_faixa_nota": R.band_score(score),
                "fl_aprovado": R.flag_passed(score),
                "fl_critico": R.flag_critical(score),
            },
        ),
        columns=(
            "id_avaliacao", "id_chamada", "id_operador", "id_supervisor", "nr_nota_geral",
            "dt_avaliacao", "nr_tamanho_feedback_chars", "fl_tem_feedback", "ds_faixa_nota",
            "fl_aprovado", "fl_critico",
        ),
        hashed=("id_avaliacao", "id_chamada", "id_supervisor", "nr_nota_geral", "dt_avaliacao"),
        rules=(
            _null("id_avaliacao"),
            _null("id_chamada"),
            _null("dt_avaliacao", "dt_avaliacao_nula"),
            ((score < 0) | (score > 10), "nr_nota_fora_do_range"),
        ),
        partition=("dt_avaliacao", YMD),
        extras={
            "nr_nota_comunicacao": _double("nr_nota_comunicacao"),
            "nr_nota_resolucao": _double("nr_nota_resolucao"),
        },
    )


def _jornada_operador(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_jornada",),
        clean={
            "id_jornada": _long("id_jornada"),
            "id_operador": _long("id_operador"),
            "dt_jornada": _date("dt_jornada"),
            "dt_entrada": _ts("dt_entrada"),
            "dt_saida": _ts("dt_saida"),
            "nr_horas_trabalhadas": _double("nr_horas_trabalhadas", 0.0),
            "nr_chamadas_atendidas": _int("nr_chamadas_atendidas", 0),
            "nr_tickets_resolvidos": _int("nr_tickets_resolvidos", 0),
            "st_presenca": upper_text("st_presenca", R.UNKNOWN),
        },
        derive=({"fl_presente": R.presence_flag("st_presenca")},),
        columns=(
            "id_jornada", "id_operador", "dt_jornada", "dt_entrada", "dt_saida",
            "nr_horas_trabalhadas", "nr_chamadas_atendidas", "nr_tickets_resolvidos",
            "st_presenca", "fl_presente",
        ),
        hashed=("id_jornada", "id_operador", "dt_jornada", "nr_horas_trabalhadas", "st_presenca"),
        rules=(_null("id_jornada"), _null("id_operador"), _null("dt_jornada")),
        partition=("dt_jornada", YMD),
    )


def _session(prefix: str, complete: str) -> tuple[dict[str, Column], ...]:
    return (
        {
            "nr_duracao_segundos": R.duration_seconds("dt_inicio", "dt_fim"),
            complete: R.flag_complete("dt_inicio", "dt_fim"),
        },
        {"nr_duracao_minutos": R.minutes_from_seconds("nr_duracao_segundos")},
    )


def _chat(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_chat",),
        clean={
            "id_chat": _long("id_chat"),
            "id_cliente": _long("id_cliente"),
            "id_operador": _long("id_operador", -1),
            "dt_inicio": _ts("dt_inicio"),
            "dt_fim": _ts("dt_fim"),
            "st_chat": upper_text("st_chat", R.UNKNOWN),
        },
        derive=_session("chat", "fl_chat_completo"),
        columns=(
            "id_chat", "id_cliente", "id_operador", "dt_inicio", "dt_fim", "st_chat",
            "nr_duracao_segundos", "nr_duracao_minutos", "fl_chat_completo",
        ),
        hashed=("id_chat", "id_cliente", "id_operador", "dt_inicio", "dt_fim", "st_chat"),
        rules=(_null("id_chat"), _null("id_cliente"), _null("dt_inicio", "dt_inicio_nula")),
        partition=("dt_inicio", YMD),
        extras={"id_fila": _long("id_fila", -1), "nr_satisfacao": _double("nr_satisfacao")},
    )


def _mensagem_chat(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_mensagem",),
        clean={
            "id_mensagem": _long("id_mensagem"),
            "id_chat": _long("id_chat"),
            "ds_remetente": upper_text("ds_remetente", R.UNKNOWN),
            "dt_mensagem": _ts("dt_mensagem"),
            "nr_tamanho_chars": P.text_length("ds_conteudo"),
        },
        derive=(
            {
                "fl_mensagem_cliente": R.flag_sender("ds_remetente", "CLIENTE"),
                "fl_mensagem_operador": R.flag_sender("ds_remetente", "OPERADOR"),
            },
        ),
        columns=(
            "id_mensagem", "id_chat", "ds_remetente", "dt_mensagem", "nr_tamanho_chars",
            "fl_mensagem_cliente", "fl_mensagem_operador",
        ),
        hashed=("id_mensagem", "id_chat", "ds_remetente", "dt_mensagem"),
        rules=(_null("id_mensagem"), _null("id_chat"), _null("dt_mensagem", "dt_envio_nula")),
        partition=("dt_mensagem", YMD),
    )


def _whatsapp(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_whatsapp",),
        clean={
            "id_whatsapp": _long("id_whatsapp"),
            "id_cliente": _long("id_cliente"),
            "id_operador": _long("id_operador", -1),
            "nr_telefone_mascarado": P.mask_phone(digits("nr_telefone_cliente", keep_plus=True)),
            "dt_inicio": _ts("dt_inicio"),
            "dt_fim": _ts("dt_fim"),
            "st_atendimento": upper_text("st_atendimento", R.UNKNOWN),
        },
        derive=_session("atendimento", "fl_atendimento_completo"),
        columns=(
            "id_whatsapp", "id_cliente", "id_operador", "nr_telefone_mascarado", "dt_inicio",
            "dt_fim", "st_atendimento", "nr_duracao_segundos", "nr_duracao_minutos",
            "fl_atendimento_completo",
        ),
        hashed=(
            "id_whatsapp", "id_cliente", "id_operador", "nr_telefone_mascarado", "dt_inicio",
            "dt_fim", "st_atendimento",
        ),
        rules=(_null("id_whatsapp"), _null("id_cliente"), _null("dt_inicio", "dt_inicio_nula")),
        partition=("dt_inicio", YMD),
        extras={"nr_satisfacao": _double("nr_satisfacao")},
    )


def _ura_navegacao(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_ura",),
        clean={
            "id_ura": _long("id_ura"),
            "id_cliente": _long("id_cliente"),
            "ds_opcao_selecionada": upper_text("ds_opcao_selecionada", R.UNKNOWN),
            "dt_navegacao": _ts("dt_navegacao"),
            "nr_duracao_segundos": _int("nr_duracao_segundos", 0),
        },
        derive=(
            {
                "fl_abandonou_ura": R.flag_ivr_abandon("ds_opcao_selecionada"),
                "ds_faixa_espera": R.band_wait("nr_duracao_segundos"),
            },
        ),
        columns=(
            "id_ura", "id_chamada", "id_cliente", "ds_opcao_selecionada", "dt_navegacao",
            "nr_duracao_segundos", "fl_abandonou_ura", "ds_faixa_espera",
        ),
        hashed=("id_ura", "ds_opcao_selecionada", "dt_navegacao", "nr_duracao_segundos"),
        rules=(_null("id_ura"), _null("dt_navegacao", "dt_evento_nula")),
        partition=("dt_navegacao", YMD),
        extras={
            "fl_transferiu_humano": _int("fl_transferiu_humano"),
            "nr_tentativas": _int("nr_tentativas"),
        },
        optional={"id_chamada": "bigint"},
    )


def _campanha(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_campanha",),
        clean={
            "id_campanha": _long("id_campanha"),
            "nm_campanha": upper_text("nm_campanha"),
            "dt_inicio": _date("dt_inicio"),
            "dt_fim": _date("dt_fim"),
            "st_campanha": R.campaign_status("fl_ativa"),
        },
        derive=(
            {
                "nr_duracao_dias": R.campaign_days("dt_inicio", "dt_fim"),
                "fl_campanha_ativa": R.flag(F.col("st_campanha") == "ATIVA"),
                "fl_campanha_vigente": R.flag_in_force("dt_inicio", "dt_fim", as_of),
            },
        ),
        columns=(
            "id_campanha", "nm_campanha", "dt_inicio", "dt_fim", "st_campanha",
            "nr_duracao_dias", "fl_campanha_ativa", "fl_campanha_vigente",
        ),
        hashed=("id_campanha", "nm_campanha", "st_campanha", "dt_inicio", "dt_fim"),
        rules=(_null("id_campanha"), _null("nm_campanha")),
        extras={
            "ds_objetivo": upper_text("ds_objetivo", R.UNKNOWN),
            "nr_meta_contatos": _int("nr_meta_contatos"),
            "nr_contatos_realizados": _int("nr_contatos_realizados"),
            "nr_conversoes": _int("nr_conversoes"),
        },
    )


def _discagem(as_of: Column) -> SilverSpec:
    return SilverSpec(
        key=("id_discagem",),
        clean={
            "id_discagem": _long("id_discagem"),
            "id_campanha": _long("id_campanha"),
            "id_cliente": _long("id_cliente"),
            # The source has no phone number.
            "nr_telefone_mascarado": F.lit(""),
            "dt_ultima_tentativa": _ts("dt_ultima_tentativa"),
            "st_discagem": upper_text("st_discagem", R.UNKNOWN),
            "fl_discagem_atendida": R.flag_answered("fl_contato_realizado"),
        },
        derive=({"fl_discagem_nao_atendida": R.complement("fl_discagem_atendida")},),
        columns=(
            "id_discagem", "id_campanha", "id_cliente", "nr_telefone_mascarado",
            "dt_ultima_tentativa", "st_discagem", "fl_discagem_atendida",
            "fl_discagem_nao_atendida",
        ),
        hashed=(
            "id_discagem", "id_campanha", "id_cliente", "nr_telefone_mascarado",
            "dt_ultima_tentativa", "st_discagem",
        ),
        rules=(
            _null("id_discagem"),
            _null("id_campanha"),
            _null("id_cliente"),
            _null("dt_ultima_tentativa", "dt_ultima_tentativa_nula"),
        ),
        partition=("dt_ultima_tentativa", YMD),
        extras={
            "id_operador": _long("id_operador", -1),
            "nr_tentativas": _int("nr_tentativas"),
            "fl_convertido": _int("fl_convertido", 0),
            "nr_valor_convertido": _double("nr_valor_convertido", 0.0),
            "nr_custo_discagem": _double("nr_custo_discagem", 0.0),
        },
    )


def _metricas_operacionais(as_of: Column) -> SilverSpec:
    level = F.col("nr_nivel_servico")
    return SilverSpec(
        key=("id_metrica",),
        clean={
            "id_metrica": _long("id_metrica"),
            "dt_referencia": safe_cast("dt_referencia", "timestamp", "yyyy-MM-dd"),
            "id_fila": _long("id_fila", -1),
            "nr_chamadas_atendidas": _int("nr_chamadas_atendidas", 0),
            "nr_chamadas_abandonadas": _int("nr_chamadas_abandonadas", 0),
            "nr_tma_segundos": _int("nr_tma_segundos", 0),
            "nr_tme_segundos": _int("nr_tme_segundos", 0),
            "nr_taxa_abandono": _double("nr_taxa_abandono", 0.0),
        },
        derive=(
            {
                "nr_nivel_servico": R.service_level("nr_chamadas_atendidas", "nr_chamadas_abandonadas"),
                "nr_taxa_atendimento": R.attendance_rate("nr_taxa_abandono"),
                "nr_tma_minutos": R.minutes_from_seconds("nr_tma_segundos"),
                "nr_tme_minutos": R.minutes_from_seconds("nr_tme_segundos"),
                "fl_alto_abandono": R.flag_high_abandon("nr_taxa_abandono"),
            },
            {"fl_meta_nivel_servico": R.flag_service_goal("nr_nivel_servico")},
        ),
        columns=(
            "id_metrica", "dt_referencia", "id_fila", "nr_chamadas_atendidas",
            "nr_chamadas_abandonadas", "nr_tma_segundos", "nr_tma_minutos", "nr_tme_segundos",
            "nr_tme_minutos", "nr_nivel_servico", "nr_taxa_atendimento", "nr_taxa_abandono",
            "fl_meta_nivel_servico", "fl_alto_abandono",
        ),
        hashed=(
            "id_metrica", "id_fila", "dt_referencia", "nr_chamadas_atendidas",
            "nr_chamadas_abandonadas", "nr_nivel_servico",
        ),
        rules=(
            _null("id_metrica"),
            _null("dt_referencia", "dt_referencia_nula"),
            ((level < 0) | (level > 100), "nr_nivel_servico_fora_do_range"),
        ),
        partition=("dt_referencia", YMD),
    )


SPECS: dict[str, Callable[[Column], SilverSpec]] = {
    "chamada": _chamada,
    "cliente": _cliente,
    "endereco_cliente": _endereco_cliente,
    "operador": _operador,
    "skill_operador": _skill_operador,
    "fila_atendimento": _fila_atendimento,
    "gravacao_chamada": _gravacao_chamada,
    "ticket": _ticket,
    "interacao_ticket": _interacao_ticket,
    "avaliacao_qualidade": _avaliacao_qualidade,
    "jornada_operador": _jornada_operador,
    "chat": _chat,
    "mensagem_chat": _mensagem_chat,
    "whatsapp_atendimento": _whatsapp,
    "ura_navegacao": _ura_navegacao,
    "campanha": _campanha,
    "discagem": _discagem,
    "metricas_operacionais": _metricas_operacionais,
}


def silver_spec(entity: str, as_of: str) -> SilverSpec:
    return SPECS[entity](F.lit(as_of).cast("date"))


def latest_events(entity: str, bronze: DataFrame, as_of: str, tie_break: str | None = None) -> DataFrame:
    """Decoded change events, one per key."""
    order = ["dt_cdc_evento"] + ([tie_break] if tie_break else [])
    spec = silver_spec(entity, as_of)
    return cdc.cdc_dedup_latest(cdc.cdc_decode_op(bronze), keys=spec.key, order=order)


def _beyond(key: str, typed: Column) -> Column:
    """What the typed value of a raw key does not tell: NULL where it gives back the text, else the text itself.

    Together with the typed value it separates rows as the raw key does.
    """
    raw = F.col(key).cast("string")
    return F.when(typed.cast("string").eqNullSafe(raw), None).otherwise(F.coalesce(F.concat(F.lit("="), raw), F.lit("-")))


def row_digest(entity: str, as_of: str) -> Column:
    """The row hash of a current-state table, over its finished columns."""
    return cdc.row_hash(silver_spec(entity, as_of).hashed)


def late_columns(entity: str, as_of: str) -> list[dict[str, Column]]:
    """Steps of the columns that follow from others of the checked rows: the derived ones, the date parts and the row hash."""
    spec = silver_spec(entity, as_of)
    steps = [{n: c for n, c in step.items() if n in spec.columns and n not in spec.early} for step in spec.derive]
    parts = cdc.partition_columns(*spec.partition) if spec.partition else {}
    return [step for step in (*steps, parts, {"hash_registro": row_digest(entity, as_of)}) if step]


def mark_silver(
    entity: str,
    bronze: DataFrame,
    *,
    as_of: str,
    run_ts: str | None = None,
    tie_break: str | None = None,
    extended: bool = False,
    tasks: int | None = None,
    hashed: bool = True,
) -> DataFrame:
    """All latest rows of one table, typed and derived, with the rejection reason (or NULL).

    ``extended`` keeps the spec's extra columns. The audit column is added only with ``run_ts``. ``tasks`` is that of
    :func:`cdc.cdc_dedup_latest`. Without ``hashed`` the row hash is left out; :func:`row_digest` gives it later.
    """
    spec = silver_spec(entity, as_of)
    clean = dict(spec.clean)
    for name, to in spec.optional.items():
        clean[name] = safe_cast(name, to) if name in bronze.columns else F.lit(None).cast(to)
    extras = {n: c for n, c in spec.extras.items() if extended and n in bronze.columns}
    # Typed before the shuffle by key, so that the text of numbers and times is neither sent nor sorted.
    typed = {**clean, **extras}
    exact = {f"_chave_{k}": _beyond(k, typed[k]) for k in spec.key}
    order = ["dt_cdc_evento"] + ([tie_break] if tie_break else [])
    events = cdc.cdc_decode_op(bronze).select(*[c.alias(n) for n, c in {**typed, **exact}.items()], "op_cdc", *order)
    df = cdc.cdc_dedup_latest(events, keys=[*spec.key, *exact], order=order, tasks=tasks).select(*typed, "dt_cdc_evento", "op_cdc")
    for step in spec.derive:
        df = df.withColumns(step)
    if hashed:
        df = df.withColumn("hash_registro", row_digest(entity, as_of))
    columns = [*spec.columns, *extras, *[c for c in CDC if hashed or c != "hash_registro"]]
    if run_ts:
        df = cdc.add_audit_columns(df, name="dt_ingestao_silver", run_ts=run_ts)
        columns.append("dt_ingestao_silver")
    if spec.partition:
        source, names = spec.partition
        df = df.withColumns(cdc.partition_columns(source, names))
        columns += names
    df = df.withColumn(cdc.REASON, cdc.first_reason(spec.rules))
    return cdc.schema_project(df, [*columns, cdc.REASON])


def build_silver(entity: str, bronze: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows of one current-state table; options as in :func:`mark_silver`."""
    return cdc.split_marked(mark_silver(entity, bronze, **options))
