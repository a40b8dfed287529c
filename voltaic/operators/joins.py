"""Joins on the hourly key."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from .spine import date_spine, hour_grid


def left_join_all(base: DataFrame, others: Iterable[DataFrame | None],
                  on: Sequence[str] = config.KEYS) -> DataFrame:
    """Left join each present frame to ``base`` on ``on``.

    All sides join on the same key, so once each is hash partitioned on
    it (they are, when they come out of an aggregate on the key) the
    chain of sort-merge joins adds no shuffle; AQE turns a side into a
    broadcast only when its measured size is under the threshold.
    Missing sides (None) are skipped, which is how an absent source is
    tolerated.
    """
    out = base
    for other in others:
        if other is not None:
            out = out.join(other, on=list(on), how="left")
    return out


def attach_actuals(schedules: DataFrame, actuals: DataFrame,
                   keys: Sequence[str] = ("date", "hour", "intertie_zone"),
                   position: str = "pos", flow: str = "flow",
                   out: str = "actual_flow_mw") -> DataFrame:
    """Fill each schedule row with the actual flow of its hour.

    The last Actual of a key (highest ``position``) wins even if its flow
    is empty, so ``max_by`` carries a struct; an Actual without a schedule
    row is dropped by the left join.  Schedules must be unique on ``keys``.
    """
    last = (actuals.groupBy(*keys)
            .agg(F.max_by(F.struct(F.col(flow).alias("v")), F.col(position)).alias("_a")))
    return (schedules.join(last, on=list(keys), how="left")
            .withColumn(out, F.col("_a.v")).drop("_a"))


def unexpected_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct values of ``column`` outside ``allowed`` (NULL counts as
    unexpected).  ``allowed`` is a literal list, so this is a pushed-down
    filter and a partial distinct, not a join."""
    c = F.col(column)
    return df.select(c).filter(~c.isin(*allowed) | c.isNull()).distinct()


def missing_hours(df: DataFrame, keys: Sequence[str] = config.KEYS,
                  calendar: DataFrame | None = None) -> DataFrame:
    """Hours of a calendar span that have no row in ``df``.

    The span is that of ``calendar`` (default ``df`` itself), per region
    where it has one.  The grid is generated (one row per day and hour of
    the span, no join); present keys are reduced to distinct ones map-side
    before the anti join shuffles them.
    """
    date, hour = keys
    source = df if calendar is None else calendar
    series = config.series_of(source)
    grid = hour_grid(date_spine(source, date))
    present = df.select(*series, F.col(date).alias("date"), F.col(hour).alias("hour")).distinct()
    return grid.join(present, on=[*series, "date", "hour"], how="left_anti")


def recent(df: DataFrame, days: int, date: str = "date") -> DataFrame:
    """Rows with ``date >= max(date) - days`` (both ends included, so
    ``days + 1`` calendar dates).  The maximum is a scalar subquery: a
    one-row aggregate that runs first and is then a literal."""
    top = df.agg(F.max(date)).scalar()
    return df.filter(F.col(date) >= F.date_sub(top, days))
