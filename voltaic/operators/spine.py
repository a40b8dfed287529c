"""Generated rows: calendar spine and hour grid (V2, V3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config


def date_spine(df: DataFrame, date: str = "date") -> DataFrame:
    """Every calendar day from the minimum to the maximum of ``date``, per
    region where ``df`` has one.

    One plan: min/max (partial aggregates, one row per region) followed by
    ``explode(sequence(...))``.  The output grows with the calendar span,
    not with the data.
    """
    series = config.series_of(df)
    bounds = df.groupBy(*series).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    return bounds.select(
        *series, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias("date"))


def hour_grid(dates: DataFrame, date: str = "date") -> DataFrame:
    """Each date times hours 1-24, generated per row (no join)."""
    lo, hi = config.HOURS
    return dates.select(*config.series_of(dates), F.col(date).alias("date"),
                        F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("hour"))
