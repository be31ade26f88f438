"""Pieces that several KPI families share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atende.functions.rules import half_up
from atende.operators.lookup import partition_of, with_dim
from atende.operators.ranks import order_by

# Status labels the call KPIs count.
ANSWERED = ("ATENDIDA", "COMPLETADA", "TRANSFERIDA")
ABANDONED = ("ABANDONADA", "ABANDONADA_FILA")
RESOLVED = ("RESOLVIDO", "FECHADO")
OPEN = ("ABERTO", "EM_ATENDIMENTO", "PENDENTE")
SLA_HOURS = {"ALTA": 4, "MEDIA": 8, "BAIXA": 24}

YEAR_MONTH = "ds_ano_mes"


def one_if(condition: Column) -> Column:
    """1/0 INT, 0 when unknown."""
    return F.when(condition, 1).otherwise(0)


def n_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def n(column: str) -> Column:
    return F.count(F.col(column))


def mean(value: Column | str, digits: int = 2) -> Column:
    return half_up(F.avg(value), digits)


def mean_if(condition: Column, value: Column | str, digits: int = 2) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return half_up(F.avg(F.when(condition, value)), digits)


def year_month(day: str = "dt_completa") -> Column:
    return F.date_format(F.col(day), "yyyy-MM")


def optional(df: DataFrame, name: str, to: str) -> Column:
    """The column where the fact was built with it, else a typed NULL."""
    return F.col(name).cast(to) if name in df.columns else F.lit(None).cast(to)


def since_year(fact: DataFrame, date_key: str, min_year: int | None) -> DataFrame:
    """Year floor on the yyyyMMdd key itself and its month partition, so that it reaches the fact's file scan."""
    if min_year is None:
        return fact
    part = partition_of(date_key)
    if part in fact.columns:
        fact = fact.filter(F.col(part) >= min_year * 100)
    return fact.filter(F.col(date_key) >= min_year * 10000)


def with_day(fact: DataFrame, t, fk: str, take: Sequence[str] | dict[str, str]) -> DataFrame:
    return with_dim(fact, t["dim_data"], fk=fk, sk="sk_data", take=take)


def top(df: DataFrame, order: Sequence[tuple[str, bool]], limit: int | None = None) -> DataFrame:
    """ORDER BY (column, descending) with NULLs last, then LIMIT; ``None`` keeps all rows.

    Callers end ``order`` with the row's key, so that the rows kept do not vary.
    """
    df = df.orderBy(*[order_by(c, d) for c, d in order])
    return df if limit is None else df.limit(limit)
