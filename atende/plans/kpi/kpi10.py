"""Operator attendance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import half_up, pct, ratio, traffic_light
from atende.operators.lookup import with_dim
from atende.operators.scalars import one_row
from atende.operators.ranks import ranked
from atende.plans.kpi.common import mean, n, n_if, one_if, top, with_day, year_month
from atende.sources.stage import staged

# Shift statuses with their own class.
OCCURRENCES = ("PRESENTE", "AUSENTE", "FERIAS", "AFASTADO", "FOLGA")


def kpi10_base(t, occurrences: tuple[str, ...] = OCCURRENCES) -> DataFrame:
    f = with_dim(
        t["fato_jornada_operador"], t["dim_operador"].filter("fl_operador_ativo = 1"),
        fk="sk_operador", sk="sk_operador",
        take={"nm_operador": "nm_operador", "ds_faixa_tempo_casa": "ds_cargo"},
    )
    f = with_day(f, t, "sk_data", ["dt_completa", "nr_ano", "nr_mes", "nr_dia", "ds_dia_semana", "fl_fim_de_semana"])
    status = F.col("st_presenca")
    return f.select(
        "sk_jornada", "sk_operador", "sk_data", "nr_horas_trabalhadas", "nr_chamadas_atendidas",
        "nr_tickets_resolvidos", "st_presenca", "nm_operador", "ds_cargo", "dt_completa",
        "nr_ano", "nr_mes", "nr_dia", "ds_dia_semana", "fl_fim_de_semana",
        year_month().alias("ds_ano_mes"),
        F.when(status.isin(*occurrences), status).otherwise("OUTRO").alias("ds_tipo_ocorrencia"),
        one_if(F.col("fl_fim_de_semana") == 0).alias("fl_dia_util"),
    )


def _is(kind: str):
    return n_if(F.col("ds_tipo_ocorrencia") == kind)


def _while_present(column: str):
    return F.sum(F.when(F.col("ds_tipo_ocorrencia") == "PRESENTE", F.col(column)))


def _workdays():
    return n_if(F.col("fl_dia_util") == 1)


def kpi10_attendance(t, limit: int | None = None) -> DataFrame:
    hours = _while_present("nr_horas_trabalhadas")
    people = staged(
        kpi10_base(t)
        .groupBy("sk_operador", "nm_operador", "ds_cargo")
        .agg(
            n("sk_jornada").alias("nr_dias_registrados"),
            _workdays().alias("nr_dias_uteis"),
            *[_is(k).alias(f"nr_dias_{k.lower()}") for k in OCCURRENCES],
            pct(_is("PRESENTE"), _workdays()).alias("pct_taxa_presenca"),
            pct(_is("AUSENTE"), _workdays()).alias("pct_taxa_absenteismo"),
            half_up(hours, 2).alias("nr_horas_totais"),
            _while_present("nr_chamadas_atendidas").alias("nr_chamadas_totais"),
            _while_present("nr_tickets_resolvidos").alias("nr_tickets_totais"),
            ratio(_while_present("nr_chamadas_atendidas"), hours).alias("nr_chamadas_por_hora"),
            ratio(_while_present("nr_tickets_resolvidos"), hours).alias("nr_tickets_por_hora"),
            ratio(hours, _is("PRESENTE")).alias("nr_horas_medias_por_dia"),
        )
    )
    team = one_row(
        people.agg(
            mean("pct_taxa_presenca").alias("media_presenca_equipe"),
            mean("pct_taxa_absenteismo").alias("media_absenteismo_equipe"),
            mean("nr_chamadas_por_hora").alias("media_calls_hora_equipe"),
        )
    )
    pace, usual = F.col("nr_chamadas_por_hora"), F.col("media_calls_hora_equipe")
    rows = people.withColumns(team).withColumns(
        {
            "desvio_presenca_vs_media": half_up(F.col("pct_taxa_presenca") - F.col("media_presenca_equipe"), 2),
            "desvio_produtividade_vs_media": half_up(pace - usual, 2),
            "semaforo_absenteismo": traffic_light("pct_taxa_absenteismo", (5, 10), higher_is_better=False),
            "ds_situacao_produtividade": F.when(pace >= usual * 1.1, "ACIMA_DA_MEDIA")
            .when(pace >= usual * 0.9, "NA_MEDIA")
            .otherwise("ABAIXO_DA_MEDIA"),
        }
    )
    rows = ranked(
        rows,
        {
            "rank_presenca": ("pct_taxa_presenca", True),
            "rank_menor_absenteismo": ("pct_taxa_absenteismo", False),
            "rank_produtividade_hora": ("nr_chamadas_por_hora", True),
        },
        stored=True,
    )
    order = [("pct_taxa_absenteismo", True), ("nr_chamadas_por_hora", True), ("sk_operador", False)]
    return top(rows, order, limit)


def kpi10_monthly(t) -> DataFrame:
    return kpi10_base(t).groupBy("sk_operador", "nm_operador", "ds_ano_mes", "nr_ano", "nr_mes").agg(
        _workdays().alias("nr_dias_uteis_mes"),
        _is("PRESENTE").alias("nr_presente_mes"),
        _is("AUSENTE").alias("nr_ausente_mes"),
        pct(_is("AUSENTE"), _workdays()).alias("pct_absenteismo_mes"),
        half_up(_while_present("nr_horas_trabalhadas"), 2).alias("nr_horas_mes"),
        _while_present("nr_chamadas_atendidas").alias("nr_chamadas_mes"),
    )


def kpi10_absence_weekday(t) -> DataFrame:
    rows = n("sk_jornada")
    return (
        kpi10_base(t)
        .filter("fl_dia_util = 1")
        .groupBy("ds_dia_semana")
        .agg(
            _is("AUSENTE").alias("nr_ausencias"),
            rows.alias("nr_registros_dia"),
            pct(_is("AUSENTE"), rows).alias("pct_ausencia_dia_semana"),
        )
    )
