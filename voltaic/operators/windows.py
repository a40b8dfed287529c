"""Calendar-range window aggregates."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_number(date: str = "date") -> Column:
    """Days since 1970-01-01: a numeric key for range frames."""
    return F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))


def rolling_mean(value: str, days: int, date: str = "date",
                 series: Sequence[str] = ()) -> Column:
    """Mean of ``value`` over the ``days`` calendar days ending at this row.

    A range frame over the day number, so a missing day shortens the
    frame instead of stretching it.  ``series`` partitions the window.
    """
    w = (Window.partitionBy(*[F.col(s) for s in series])
         .orderBy(day_number(date)).rangeBetween(-(days - 1), 0))
    return F.avg(F.col(value)).over(w)


def with_rolling(df: DataFrame, value: str, windows: dict[str, int], date: str = "date",
                 series: Sequence[str] = (), bucket_days: int = 366) -> DataFrame:
    """Add one rolling mean of ``value`` per entry of ``windows``
    (name -> days), computed in parallel over calendar buckets.

    Rows are split into buckets of ``bucket_days`` consecutive days (more
    if a window is longer; per series), and the last ``max(days) - 1`` days of each bucket are also
    copied into the next bucket as a halo.  Every frame then lies inside
    one bucket, the window runs per (series, bucket) in parallel, and the
    halo copies are dropped afterwards.  Each row is emitted at most
    twice, and the result equals the single-window result exactly.
    """
    reach = max(windows.values()) - 1
    # A bucket is at least as long as the longest window, so that a frame
    # reaches into one earlier bucket at most.
    bucket_days = max(bucket_days, reach + 1)
    dn = day_number(date)
    home = F.floor(dn / bucket_days)
    # one row per target bucket: its own, plus the next one for the tail days
    targets = F.when(dn - home * bucket_days >= bucket_days - reach,
                     F.array(home, home + 1)).otherwise(F.array(home))
    parts = df.select("*", dn.alias("_dn"), home.alias("_home"),
                      F.explode(targets).alias("_bucket"))
    order = Window.partitionBy(*[F.col(s) for s in series], F.col("_bucket")).orderBy("_dn")
    out = parts.select("*", *[F.avg(F.col(value)).over(order.rangeBetween(-(d - 1), 0))
                              .alias(name) for name, d in windows.items()])
    return out.filter(F.col("_bucket") == F.col("_home")).drop("_dn", "_home", "_bucket")
