"""Ticket volume and service level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import half_up, pct
from atende.operators.lookup import with_dim
from atende.operators.ranks import ranked
from atende.plans.kpi.common import (
    OPEN, RESOLVED, SLA_HOURS, mean_if, n, n_if, one_if, top, with_day, year_month,
)


def target_hours(priority: Column, hours: dict[str, int] = SLA_HOURS) -> Column:
    out = F.lit(None).cast("int")
    for name, limit in hours.items():
        out = F.when(priority == name, limit).otherwise(out)
    return out


def tickets(t, day: dict[str, str]) -> DataFrame:
    """Tickets with category, priority, status and opening day."""
    f = t["fato_ticket"]
    f = with_dim(f, t["dim_categoria_ticket"], fk="sk_categoria", sk="sk_categoria", take={"nm_categoria": "ds_categoria_ticket"})
    f = with_dim(f, t["dim_prioridade_ticket"], fk="sk_prioridade", sk="sk_prioridade", take={"nm_prioridade": "ds_prioridade_ticket"})
    f = with_dim(f, t["dim_status_ticket"], fk="sk_status_ticket", sk="sk_status", take={"ds_status": "ds_status_ticket"})
    f = with_day(f, t, "sk_data_abertura", {"dt_completa": "dt_abertura", **day})
    status = F.col("ds_status_ticket")
    return f.withColumns(
        {
            "sk_operador": F.col("sk_operador_abertura"),
            "sk_data_resolucao": F.col("sk_data_fechamento"),
            "nr_tempo_resolucao_horas": half_up(F.col("nr_tempo_resolucao_min") / F.lit(60.0), 2),
            "fl_resolvido": one_if(status.isin(*RESOLVED)),
            "fl_em_aberto": one_if(status.isin(*OPEN)),
        }
    )


def kpi04_base(t, hours: dict[str, int] = SLA_HOURS) -> DataFrame:
    f = tickets(t, {"nr_ano": "nr_ano_abertura", "nr_mes": "nr_mes_abertura", "nr_dia": "nr_dia_abertura"})
    target = target_hours(F.col("ds_prioridade_ticket"), hours)
    return f.select(
        "sk_ticket", "sk_cliente", "sk_operador", "sk_categoria", "sk_prioridade",
        "sk_status_ticket", "sk_data_abertura", "sk_data_resolucao",
        "nr_tempo_resolucao_horas", "ds_categoria_ticket", "ds_prioridade_ticket",
        "ds_status_ticket", "dt_abertura", "nr_ano_abertura", "nr_mes_abertura",
        "nr_dia_abertura", year_month("dt_abertura").alias("ds_ano_mes_abertura"),
        target.alias("nr_sla_horas_target"),
        one_if(F.col("nr_tempo_resolucao_min") < target * 60).alias("fl_sla_cumprido"),
        "fl_resolvido", "fl_em_aberto",
    )


def kpi04_daily(t, limit: int | None = None) -> DataFrame:
    levels = tuple(SLA_HOURS)
    day = ["dt_abertura", "nr_ano_abertura", "nr_mes_abertura", "nr_dia_abertura", "ds_ano_mes_abertura"]
    out = (
        kpi04_base(t)
        .groupBy(*day)
        .agg(
            n("sk_ticket").alias("nr_tickets_abertos_dia"),
            *[n_if(F.col("ds_prioridade_ticket") == p).alias(f"nr_tickets_{p.lower()}") for p in levels],
            F.sum("fl_resolvido").alias("nr_tickets_resolvidos"),
            F.sum("fl_em_aberto").alias("nr_tickets_em_aberto"),
        )
    )
    opened, high = F.col("nr_tickets_abertos_dia"), F.col("nr_tickets_alta")
    out = out.withColumns(
        {
            "pct_resolucao_dia": pct(F.col("nr_tickets_resolvidos"), opened),
            **{f"pct_{p.lower()}_prioridade": pct(F.col(f"nr_tickets_{p.lower()}"), opened) for p in levels},
            "ds_alerta_volume": F.when(high > 50, "ATENCAO_ALTA_PRIORIDADE").when(high > 20, "MONITORAR").otherwise("NORMAL"),
        }
    )
    return top(out, [("dt_abertura", True), ("nr_tickets_abertos_dia", True)], limit)


def _sla_share() -> Column:
    return pct(F.sum("fl_sla_cumprido"), n_if(F.col("fl_resolvido") == 1))


def kpi04_sla_by_priority(t, hours: dict[str, int] = SLA_HOURS) -> DataFrame:
    done = F.col("fl_resolvido") == 1
    return (
        kpi04_base(t, hours)
        .filter(F.col("ds_prioridade_ticket").isin(*hours))
        .groupBy("ds_prioridade_ticket", "nr_sla_horas_target")
        .agg(
            n("sk_ticket").alias("nr_total_tickets"),
            n_if(done).alias("nr_resolvidos"),
            F.sum("fl_sla_cumprido").alias("nr_dentro_sla"),
            _sla_share().alias("pct_sla_cumprido"),
            n_if(done & (F.col("fl_sla_cumprido") == 0)).alias("nr_fora_sla"),
            mean_if(done, "nr_tempo_resolucao_horas").alias("nr_tempo_medio_resolucao_horas"),
            F.max(F.when(done, F.col("nr_tempo_resolucao_horas"))).alias("nr_tempo_max_resolucao_horas"),
        )
    )


def kpi04_by_category(t) -> DataFrame:
    done = F.col("fl_resolvido") == 1
    out = (
        kpi04_base(t)
        .groupBy("ds_categoria_ticket")
        .agg(
            n("sk_ticket").alias("nr_total_tickets"),
            n_if(F.col("ds_prioridade_ticket") == "ALTA").alias("nr_alta_prioridade"),
            n_if(done).alias("nr_resolvidos"),
            n_if(F.col("fl_em_aberto") == 1).alias("nr_em_aberto"),
            mean_if(done, "nr_tempo_resolucao_horas").alias("nr_mttr_horas"),
            _sla_share().alias("pct_sla_categoria"),
        )
    )
    return ranked(out, {"rank_volume_categoria": ("nr_total_tickets", True)})


def kpi04_status_share(t) -> DataFrame:
    base = kpi04_base(t)
    all_rows = base.agg(F.count(F.lit(1))).scalar()
    return (
        base.groupBy("ds_status_ticket")
        .agg(n("sk_ticket").alias("nr_tickets"))
        .select("ds_status_ticket", "nr_tickets", pct(F.col("nr_tickets"), all_rows).alias("pct_do_total"))
    )
