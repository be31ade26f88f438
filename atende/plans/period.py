"""A window of days over the star schema, so that every KPI, view and dataset can be limited to a period."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atende.operators.lookup import partition_of
from atende.plans.facts import FACTS
from atende.plans.kpi.common import since_year


class Period:
    """The tables of ``t``, facts limited to days of their own date key.

    ``min_year`` is a floor on the key itself, which the scan and its partitions are pruned by before
    the query runs. ``days`` is a condition on the calendar (``dim_data``): the few days that meet it prune the
    partitions of the facts at run time.
    """

    def __init__(self, t: Mapping[str, DataFrame], *, min_year: int | None = None, days: Column | None = None):
        self.t, self.min_year, self.days = t, min_year, days

    def __getitem__(self, name: str) -> DataFrame:
        df = self.t[name]
        if name not in FACTS:
            return df
        key = FACTS[name].date_key
        df = since_year(df, key, self.min_year)
        if self.days is None:
            return df
        part = partition_of(key)
        side = self.t["dim_data"].filter(self.days).select(F.col("sk_data").alias("_dia"), F.floor(F.col("sk_data") / 100).cast("int").alias("_mes"))
        on = [F.col(key) == F.col("_dia")] + ([F.col(part) == F.col("_mes")] if part in df.columns else [])
        return df.join(side, on, "left_semi")
