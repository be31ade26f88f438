"""Derived-column rules. Every rule maps Columns to a Column and needs no UDF.

Rules that depend on the calendar take ``as_of`` so that a run can be repeated.
Thresholds and labels are parameters; the defaults are the business values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from atende.functions.casts import _col

UNKNOWN = "DESCONHECIDO"

# Labels and limits of the business rules.
SCORE_BANDS = [(9.0, "EXCELENTE"), (7.0, "BOM"), (5.0, "REGULAR"), (3.0, "RUIM")]
TENURE_BANDS = [
    (90, "ATE_3_MESES"),
    (180, "3_A_6_MESES"),
    (365, "6_A_12_MESES"),
    (730, "1_A_2_ANOS"),
]
SKILL_LEVELS = {1: "BASICO", 2: "INTERMEDIARIO", 3: "AVANCADO"}
WAIT_BANDS = [(30, "ATE_30S"), (60, "31_A_60S"), (120, "61_A_120S")]
WEEKDAYS = ["DOMINGO", "SEGUNDA", "TERCA", "QUARTA", "QUINTA", "SEXTA", "SABADO"]
MONTHS = [
    "JANEIRO", "FEVEREIRO", "MARCO", "ABRIL", "MAIO", "JUNHO",
    "JULHO", "AGOSTO", "SETEMBRO", "OUTUBRO", "NOVEMBRO", "DEZEMBRO",
]
HOLIDAYS = ["01-01", "04-21", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25"]
RESOLVED_STATUSES = ["FECHADO", "RESOLVIDO"]


def flag(condition: Column) -> Column:
    """0/1 SMALLINT; an unknown (NULL) condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("smallint")


def ladder(value: Column, steps: Sequence[tuple[float, str]], op: str, default: Column | str) -> Column:
    """First step whose comparison holds, e.g. ``op='<='``; NULL values fall to ``default``."""
    compare = {
        "<": lambda cut: value < cut,
        "<=": lambda cut: value <= cut,
        ">": lambda cut: value > cut,
        ">=": lambda cut: value >= cut,
    }[op]
    default = F.lit(default) if isinstance(default, str) else default
    out = None
    for cut, label in steps:
        out = F.when(compare(cut), label) if out is None else out.when(compare(cut), label)
    return out.otherwise(default)


def half_up(value: Column, digits: int = 2) -> Column:
    """Round half up after removing binary noise far beyond the wanted digits.

    Sums of doubles depend on the order of the partial sums in their last bits; without the
    first step a value on a rounding border could differ from run to run.
    """
    return F.round(F.round(value, max(9, digits + 6)), digits)


def pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Percentage as DOUBLE; NULL when the denominator is 0."""
    return half_up(F.lit(100.0) * numerator / F.nullif(denominator, F.lit(0)), digits)


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return half_up(
        numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0)), digits
    )


# --- durations -----------------------------------------------------------------------

def flag_valid_duration(seconds: Column | str, start: Column | str, end: Column | str) -> Column:
    return flag((_col(seconds) > 0) & (_col(end) > _col(start)))


def flag_complete(start: Column | str, end: Column | str) -> Column:
    return flag(_col(start).isNotNull() & _col(end).isNotNull())


def minutes_from_seconds(seconds: Column | str) -> Column:
    return F.round(_col(seconds) / F.lit(60.0), 2)


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))).cast("int")


def resolution_minutes(opened: Column | str, closed: Column | str) -> Column:
    return F.round(
        (F.unix_timestamp(_col(closed)) - F.unix_timestamp(_col(opened))) / F.lit(60.0), 2
    )


# --- tickets -------------------------------------------------------------------------

def flag_resolved(status: Column | str, resolved: Sequence[str] = tuple(RESOLVED_STATUSES)) -> Column:
    return flag(_col(status).isin(*resolved))


def flag_within_sla(minutes: Column | str, limit: int = 480) -> Column:
    """Whole minutes are compared, so 480.9 still passes."""
    return flag(_col(minutes).cast("int") <= limit)


# --- bands ---------------------------------------------------------------------------

def band_score(score: Column | str) -> Column:
    score = _col(score)
    return ladder(score, SCORE_BANDS, ">=", F.when(score < 3.0, "CRITICO").otherwise(UNKNOWN))


def flag_passed(score: Column | str, cut: float = 7.0) -> Column:
    return flag(_col(score) >= cut)


def flag_critical(score: Column | str, cut: float = 5.0) -> Column:
    return flag(_col(score) < cut)


def tenure_days(hired: Column | str, as_of: Column) -> Column:
    return F.datediff(as_of, _col(hired))


def band_tenure(days: Column | str) -> Column:
    days = _col(days)
    return ladder(days, TENURE_BANDS, "<", F.when(days >= 730, "ACIMA_2_ANOS").otherwise(UNKNOWN))


def band_skill_level(level: Column | str) -> Column:
    level = _col(level)
    out = F.when(level >= 4, "ESPECIALISTA")
    for value, label in SKILL_LEVELS.items():
        out = out.when(level == value, label)
    return out.otherwise(UNKNOWN)


def band_wait(seconds: Column | str) -> Column:
    seconds = _col(seconds)
    return ladder(seconds, WAIT_BANDS, "<=", F.when(seconds > 120, "ACIMA_120S").otherwise(UNKNOWN))


# --- flags ---------------------------------------------------------------------------

def flag_ivr_abandon(option: Column | str, label: str = "ABANDONO") -> Column:
    return flag(_col(option) == label)


def service_level(answered: Column | str, abandoned: Column | str) -> Column:
    total = _col(answered) + _col(abandoned)
    return F.when(total > 0, F.round(_col(answered) * F.lit(100.0) / total, 2))


def attendance_rate(abandon_rate: Column | str) -> Column:
    return F.round(F.lit(100.0) - _col(abandon_rate), 2)


def flag_service_goal(level: Column | str, goal: float = 80.0) -> Column:
    return flag(_col(level) >= goal)


def flag_high_abandon(rate: Column | str, limit: float = 10.0) -> Column:
    return flag(_col(rate) > limit)


def campaign_status(active: Column | str, active_values: Sequence[str] = ("True",)) -> Column:
    return F.when(_col(active).isin(*active_values), "ATIVA").otherwise("INATIVA")


def campaign_days(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))


def flag_in_force(start: Column | str, end: Column | str, as_of: Column) -> Column:
    return flag((_col(start) <= as_of) & (_col(end) >= as_of))


def flag_expired(recorded: Column | str, as_of: Column) -> Column:
    return flag(_col(recorded) < as_of)


def days_to_expire(recorded: Column | str, as_of: Column) -> Column:
    return F.datediff(_col(recorded), as_of)


def flag_answered(contact: Column | str) -> Column:
    return flag(_col(contact).try_cast("int") == 1)


def complement(flag_col: Column | str) -> Column:
    return (F.lit(1) - _col(flag_col)).cast("smallint")


def flag_sender(sender: Column | str, label: str) -> Column:
    return flag(_col(sender) == label)


def presence_flag(status: Column | str) -> Column:
    return flag(_col(status) == "PRESENTE")


def flag_status(status: Column | str, label: str) -> Column:
    return flag(_col(status) == label)


def flag_active(status: Column | str) -> Column:
    return flag(_col(status) == "A")


def flag_has(c: Column | str) -> Column:
    return flag(F.length(_col(c)) > 0)


# --- calendar ------------------------------------------------------------------------

def date_key(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyyMMdd").cast("int")


def calendar_attributes(day: Column | str) -> dict[str, Column]:
    """Year .. business-day attributes of a date. The weekday counts from 1 = Sunday."""
    day = _col(day)
    weekday = F.dayofweek(day)
    weekend = weekday.isin(1, 7)
    holiday = F.date_format(day, "MM-dd").isin(*HOLIDAYS)
    return {
        "nr_ano": F.year(day),
        "nr_mes": F.month(day),
        "nr_dia": F.dayofmonth(day),
        "nr_trimestre": F.quarter(day),
        "nr_semana_ano": F.weekofyear(day),
        "nr_dia_semana": weekday,
        "ds_dia_semana": F.element_at(F.array(*map(F.lit, WEEKDAYS)), weekday),
        "ds_mes": F.element_at(F.array(*map(F.lit, MONTHS)), F.month(day)),
        "ds_trimestre": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "fl_fim_de_semana": flag(weekend),
        "fl_feriado": flag(holiday),
        "fl_dia_util": flag(~(weekend | holiday)),
    }


# --- classifiers ---------------------------------------------------------------------

LIGHTS = ("VERDE", "AMARELO", "VERMELHO")


def traffic_light(
    value: Column | str,
    cuts: Sequence[float],
    labels: Sequence[str] = LIGHTS,
    higher_is_better: bool = True,
) -> Column:
    """Threshold classifier with ``len(cuts) + 1`` labels; NULL gets the last label."""
    op = ">=" if higher_is_better else "<="
    return ladder(_col(value), list(zip(cuts, labels)), op, labels[-1])
