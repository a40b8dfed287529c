"""Calendar attributes of a date and an hour-ending hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from .scalar import ColumnLike, col_of


def season(month: ColumnLike) -> Column:
    m = col_of(month)
    expr = None
    for months, label in config.SEASONS:
        test = m.isin(*months)
        expr = F.when(test, F.lit(label)) if expr is None else expr.when(test, F.lit(label))
    return expr.otherwise(F.lit(config.DEFAULT_SEASON))


def is_weekday(date: ColumnLike) -> Column:
    """Monday to Friday; Spark's dayofweek counts Sunday as 1."""
    return F.coalesce(F.dayofweek(col_of(date)).between(2, 6), F.lit(False))


def is_peak_hour(hour: ColumnLike) -> Column:
    lo, hi = config.PEAK_HOURS
    return F.coalesce(col_of(hour).between(lo, hi), F.lit(False))


TIME_FEATURES = ("day_of_week", "day_name", "is_weekday", "month_num", "season",
                 "is_peak_hour", "year", "month")


def time_feature_columns(date: str = "date", hour: str = "hour") -> list[Column]:
    d = F.col(date)
    return [
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        is_weekday(d).alias("is_weekday"),
        F.month(d).alias("month_num"),
        season(F.month(d)).alias("season"),
        is_peak_hour(F.col(hour)).alias("is_peak_hour"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
    ]


def with_time_features(df: DataFrame, date: str = "date", hour: str = "hour") -> DataFrame:
    """Add day_of_week (Sunday 1), day_name, is_weekday, month_num, season,
    is_peak_hour (hours 7-19, weekends too), year and month in one
    projection."""
    return df.select("*", *time_feature_columns(date, hour))


def date_attribute_columns(date: str = "date") -> list[Column]:
    """Attributes of the date dimension."""
    d = F.col(date)
    return [
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        is_weekday(d).alias("is_weekday"),
        season(F.month(d)).alias("season"),
        F.weekofyear(d).alias("week_of_year"),
    ]
