"""Masks for personal data. All are plain expressions; an empty or NULL input gives ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atende.functions.casts import _col


def _unless(missing: Column, masked: Column) -> Column:
    return F.when(missing, F.lit("")).otherwise(masked)


def mask_document(c: Column | str) -> Column:
    """First three and last two characters stay readable."""
    c = _col(c)
    return _unless(
        F.coalesce(F.length(c), F.lit(0)) == 0,
        F.concat(F.left(c, F.lit(3)), F.lit("*****"), F.right(c, F.lit(2))),
    )


def mask_email(c: Column | str) -> Column:
    """Only the domain stays readable; '' when there is no ``@``."""
    c = _col(c)
    return _unless(
        ~F.coalesce(F.contains(c, F.lit("@")), F.lit(False)),
        F.concat(F.lit("***@"), F.split_part(c, F.lit("@"), F.lit(2))),
    )


def mask_phone(c: Column | str) -> Column:
    """Only the last four characters stay readable."""
    c = _col(c)
    return _unless(
        F.coalesce(F.length(c), F.lit(0)) == 0,
        F.concat(F.lit("******"), F.right(c, F.lit(4))),
    )


def mask_postal_code(c: Column | str) -> Column:
    """First five characters of a code that has at least five."""
    c = _col(c)
    return _unless(
        F.coalesce(F.length(c), F.lit(0)) < 5, F.concat(F.left(c, F.lit(5)), F.lit("***"))
    )


def mask_login(c: Column | str) -> Column:
    """First three characters."""
    c = _col(c)
    return _unless(
        F.coalesce(F.length(c), F.lit(0)) == 0, F.concat(F.left(c, F.lit(3)), F.lit("***"))
    )


def text_length(c: Column | str) -> Column:
    """Length of a free text that is about to be dropped (0 for NULL)."""
    return F.coalesce(F.length(_col(c)), F.lit(0))


def has_text(c: Column | str) -> Column:
    """1 when the free text is not empty."""
    return (text_length(c) > 0).cast("smallint")
