"""Casts that turn bad input into NULL (ANSI mode would raise) and text clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: Column | str, to: str, fmt: str | None = None) -> Column:
    """Cast a string; a value that does not parse becomes NULL.

    ``to`` is a Spark type name. For ``date`` and ``timestamp`` a strict pattern is used.
    """
    c = _col(c)
    if to == "timestamp":
        return F.try_to_timestamp(c, F.lit(fmt or TS_FORMAT))
    if to == "date":
        return F.try_to_timestamp(c, F.lit(fmt or DATE_FORMAT)).cast("date")
    return c.try_cast(to)


def cast_columns(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Apply :func:`safe_cast` to each ``column -> type`` of ``spec`` in one projection."""
    return df.withColumns({name: safe_cast(name, to) for name, to in spec.items()})


def event_time(c: Column | str) -> Column:
    """ISO event time (with or without ``T``) to a timestamp, NULL when malformed."""
    return F.try_to_timestamp(_col(c))


def upper_text(c: Column | str, default: str | None = None) -> Column:
    out = F.upper(F.trim(_col(c)))
    return out if default is None else F.coalesce(out, F.lit(default))


def lower_text(c: Column | str, default: str | None = None) -> Column:
    out = F.lower(F.trim(_col(c)))
    return out if default is None else F.coalesce(out, F.lit(default))


def digits(c: Column | str, keep_plus: bool = False) -> Column:
    """Only the digits of a text (and ``+`` for phone numbers); NULL becomes ''."""
    pattern = r"[^\d+]" if keep_plus else r"[^\d]"
    return F.coalesce(F.regexp_replace(_col(c), pattern, ""), F.lit(""))


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """NULL -> default, per column, keeping each column's type."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()}
    )
