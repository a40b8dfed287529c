"""Data-quality checks.

Each check is an aggregate, not a scan into the driver: counts are
partial per task, and the duplicate and distinct-value checks first
reduce to one row per key or value, then total those rows.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config


class ContractError(ValueError):
    pass


def require_contract(df: DataFrame, columns: Sequence[str], name: str = "source") -> DataFrame:
    """Raise unless ``df`` has every column in ``columns`` and at least one
    row (``isEmpty`` reads one row at most)."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError(f"{name}: missing columns {missing}")
    if df.isEmpty():
        raise ContractError(f"{name}: no rows")
    return df


def quality_demand(df: DataFrame, value: str = "region_demand", keys: Sequence[str] = config.KEYS,
                   low: float = config.DEMAND_MIN, high: float = config.DEMAND_MAX) -> DataFrame:
    """Rows below ``low`` (0), above ``high`` (35000), hours outside 1-24, and
    all members of duplicate keys (region, date, hour); passed when all are 0."""
    v, h = F.col(value), F.col(keys[1])
    lo, hi = config.HOURS
    per_key = df.groupBy(*config.series_of(df), *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(v < low).alias("neg"),
        F.count_if(v > high).alias("ext"),
        F.count_if((h < lo) | (h > hi)).alias("bad_hour"))
    totals = per_key.agg(
        F.sum("n").alias("rows"), F.sum("neg").alias("negative_rows"),
        F.sum("ext").alias("extreme_rows"), F.sum("bad_hour").alias("invalid_hour_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"))
    checks = ["negative_rows", "extreme_rows", "invalid_hour_rows", "duplicate_rows"]
    return totals.select(
        F.lit("demand").alias("source"), *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                          for c in ["rows"] + checks],
        F.coalesce(sum((F.col(c) for c in checks[1:]), F.col(checks[0])) == 0, F.lit(True))
        .alias("passed"))


def quality_generation(df: DataFrame, fuel: str = "fuel_type", value: str = "output_mw",
                       expected: Sequence[str] = config.EXPECTED_FUELS) -> DataFrame:
    """Rows with negative output and the number of distinct fuels outside
    the expected set (NULL counts as one)."""
    f = F.col(fuel)
    per_fuel = df.groupBy(f.alias("_fuel")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(value) < 0).alias("neg"))
    odd = ~F.col("_fuel").isin(*expected) | F.col("_fuel").isNull()
    totals = per_fuel.agg(F.sum("n").alias("rows"), F.sum("neg").alias("negative_rows"),
                          F.count_if(odd).alias("unexpected_fuels"))
    return totals.select(
        F.lit("generation").alias("source"),
        F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.col("negative_rows"), F.lit(0)).cast("bigint").alias("negative_rows"),
        F.col("unexpected_fuels").cast("bigint").alias("unexpected_fuels"),
        ((F.coalesce(F.col("negative_rows"), F.lit(0)) == 0) &
         (F.col("unexpected_fuels") == 0)).alias("passed"))


def quality_prices(df: DataFrame, columns: Sequence[str], low: float = config.PRICE_MIN,
                   high: float = config.PRICE_MAX) -> DataFrame:
    """Per named price column: rows below ``low`` (-100) and above ``high``
    (10000).  One aggregate over all columns, then one output row per column."""
    aggs = []
    for c in columns:
        aggs += [F.count_if(F.col(c) < low).alias(f"{c}__lo"),
                 F.count_if(F.col(c) > high).alias(f"{c}__hi")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"),
                              F.col(f"`{c}__lo`").alias("rows_below_min"),
                              F.col(f"`{c}__hi`").alias("rows_above_max")) for c in columns])
    return (wide.select(F.inline(rows))
            .withColumn("passed", (F.col("rows_below_min") + F.col("rows_above_max")) == 0))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: non-null count, distinct values, minimum and maximum
    (as text, in the order of the column's type).

    One scan for all columns: each row becomes one (column, value) pair per
    column, pairs are counted by one grouping that combines map-side, and the
    figures come from the distinct pairs only.  Values of one type share a
    field of the pair, so they compare as what they are."""
    kinds = {c: df.schema[c].dataType for c in columns}
    fields = {k: f"v{i}" for i, k in enumerate(dict.fromkeys(t.simpleString() for t in kinds.values()))}
    types = {k.simpleString(): k for k in kinds.values()}

    def pair(c: str) -> F.Column:
        own = kinds[c].simpleString()
        return F.struct(F.lit(c).alias("column_name"), *[
            (F.col(f"`{c}`") if k == own else F.lit(None).cast(types[k])).alias(v) for k, v in fields.items()])

    pairs = df.select(F.inline(F.array(*[pair(c) for c in columns])))
    values = pairs.groupBy("column_name", *fields.values()).agg(F.count(F.lit(1)).alias("n"))
    known = reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in fields.values()])
    totals = values.groupBy("column_name").agg(
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("non_null"), F.count_if(known).alias("distinct_values"),
        *[f(v).cast("string").alias(f"{name}_{v}") for v in fields.values() for name, f in (("min", F.min), ("max", F.max))])
    figure = lambda name: F.coalesce(*[F.col(f"{name}_{v}") for v in fields.values()]).alias(f"{name}_value")
    found = totals.select("column_name", "non_null", "distinct_values", figure("min"), figure("max"))
    # A column of an empty frame has no pair; its figures are 0 and NULL.
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return every.join(found, "column_name", "left").select("column_name", zero("non_null"), zero("distinct_values"), "min_value", "max_value")
