"""Values of a one-row result as scalar subqueries (no join is planned)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row(df: DataFrame) -> dict[str, Column]:
    """Columns of a one-row DataFrame, usable in expressions over another DataFrame.

    All columns come from one subquery that runs once, however often they are used.
    """
    row = df.select(F.struct("*").alias("_row")).scalar()
    return {c: row.getField(c) for c in df.columns}
