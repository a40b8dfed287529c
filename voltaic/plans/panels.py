"""The questions the analyst's panels ask."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import hour_ending_ts, round_half_up, safe_div
from ..operators.joins import recent
from ..operators.topk import last_n_ascending, latest, preview, sample_n

MIX_FUELS = config.MIX_FUELS


def latest_status(snapshot: DataFrame) -> DataFrame:
    """The latest hour that has generation (of each region): demand,
    generation, clean share, price, intensity."""
    series = config.series_of(snapshot)
    s = snapshot.filter(F.col("total_generation_mw").isNotNull())
    s = s.select(*series, "date", "hour", "region_demand", "total_generation_mw", "clean_energy_pct",
                 "energy_price", "carbon_intensity_gco2_kwh")
    return latest(s, 1, series=series)


LAST_DAYS_COLUMNS = ("date", "season", "avg_demand_mw", "peak_demand_mw", "avg_price",
                     "avg_clean_energy_pct", "avg_carbon_intensity", "avg_temp_c")


def last_days(daily_mart: DataFrame, n: int = config.LAST_DAYS) -> DataFrame:
    """The last ``n`` days of the daily mart, oldest first, measures with
    NULL shown as 0."""
    series = config.series_of(daily_mart)
    rows = last_n_ascending(daily_mart.select(*series, *LAST_DAYS_COLUMNS), n, series=series)
    numeric = [c for c, t in rows.dtypes if t in ("double", "int", "bigint")]
    return rows.na.fill(0, subset=numeric)


def recent_demand(snapshot: DataFrame, days: int = config.RECENT_DAYS) -> DataFrame:
    """Demand of the last ``days`` days (both ends) with plot time."""
    return recent(snapshot, days).select(
        *config.series_of(snapshot), "date", "hour", "region_demand", "market_demand",
        hour_ending_ts("date", "hour").alias("ts"))


def recent_generation(snapshot: DataFrame, days: int = config.RECENT_DAYS) -> DataFrame:
    """MW per fuel of the last ``days`` days with plot time."""
    return recent(snapshot, days).select(
        *config.series_of(snapshot), "date", "hour", *[config.fuel_column(f) for f in MIX_FUELS],
        hour_ending_ts("date", "hour").alias("ts"))


def average_mix(snapshot: DataFrame) -> DataFrame:
    """Mean MW per fuel and its share of the sum of the means.

    One aggregate (partial per task, one row per region), shares computed in
    that row, then unpivoted to one row per fuel.
    """
    series = config.series_of(snapshot)
    means = snapshot.groupBy(*series).agg(*[F.avg(config.fuel_column(f)).alias(f) for f in MIX_FUELS])
    whole = sum((F.coalesce(F.col(f), F.lit(0.0)) for f in MIX_FUELS[1:]),
                F.coalesce(F.col(MIX_FUELS[0]), F.lit(0.0)))
    shares = means.select(*series, *[F.struct(F.lit(f).alias("fuel"),
                                     round_half_up(F.col(f), 2).alias("avg_mw"),
                                     round_half_up(safe_div(F.col(f), whole) * 100, 2)
                                     .alias("share_pct")).alias(f) for f in MIX_FUELS])
    return shares.select(*series, F.inline(F.array(*[F.col(f) for f in MIX_FUELS])))


def price_kpis(snapshot: DataFrame) -> DataFrame:
    """Mean, maximum, minimum price and the number of spike hours."""
    p = F.col("energy_price")
    return snapshot.filter(p.isNotNull()).groupBy(*config.series_of(snapshot)).agg(
        round_half_up(F.avg(p), 2).alias("avg_price"),
        round_half_up(F.max(p), 2).alias("max_price"),
        round_half_up(F.min(p), 2).alias("min_price"),
        F.count_if(p > config.PRICE_SPIKE).alias("spike_hours"))


def price_by_hour(snapshot: DataFrame) -> DataFrame:
    p = F.col("energy_price")
    return (snapshot.filter(p.isNotNull()).groupBy(*config.series_of(snapshot), "hour")
            .agg(round_half_up(F.avg(p), 2).alias("avg_price")))


def price_series(snapshot: DataFrame) -> DataFrame:
    """Hourly price and temperature with plot time, hours with a price."""
    return snapshot.filter(F.col("energy_price").isNotNull()).select(
        *config.series_of(snapshot), "date", "hour", "energy_price", "temperature_c",
        hour_ending_ts("date", "hour").alias("ts"))


def price_temperature_sample(snapshot: DataFrame, n: int = config.PRICE_SAMPLE,
                             seed: int = 7) -> DataFrame:
    """At most ``n`` random hours that have price and temperature."""
    s = snapshot.filter(F.col("energy_price").isNotNull() & F.col("temperature_c").isNotNull())
    series = config.series_of(snapshot)
    return sample_n(s.select(*series, "date", "hour", "temperature_c", "energy_price"), n, seed,
                    keys=[*series, *config.KEYS])


def carbon_kpis(carbon_mart: DataFrame) -> DataFrame:
    """Mean, lowest, highest intensity and the percent of hours that are
    Very Clean (of all hours of the mart)."""
    c = F.col("carbon_intensity_gco2_kwh")
    very_clean = F.count_if(F.col("carbon_category") == config.VERY_CLEAN_LABEL)
    return carbon_mart.groupBy(*config.series_of(carbon_mart)).agg(
        round_half_up(F.avg(c), 2).alias("avg_intensity"),
        round_half_up(F.min(c), 2).alias("min_intensity"),
        round_half_up(F.max(c), 2).alias("max_intensity"),
        round_half_up(safe_div(very_clean, F.count(F.lit(1))) * 100, 2)
        .alias("very_clean_pct"))


def carbon_hour_means(carbon_mart: DataFrame) -> DataFrame:
    """Mean intensity by hour of day over all hours of the mart."""
    return (carbon_mart.groupBy(*config.series_of(carbon_mart), "hour")
            .agg(round_half_up(F.avg("carbon_intensity_gco2_kwh"), 2)
                 .alias("avg_carbon_intensity")))


def carbon_gas_sample(carbon_mart: DataFrame, n: int = config.CARBON_SAMPLE,
                      seed: int = 7) -> DataFrame:
    series = config.series_of(carbon_mart)
    return sample_n(carbon_mart.select(*series, "date", "hour", "gas_mw", "carbon_intensity_gco2_kwh",
                                       "season"), n, seed, keys=[*series, *config.KEYS])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table: one partial count per task and table,
    unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"),
                                                            "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def explorer_preview(table: DataFrame, n: int = config.PREVIEW_ROWS,
                     order: tuple[str, ...] = config.KEYS) -> DataFrame:
    """First ``n`` rows of a table in key order."""
    return preview(table, n, order)


def run_sql(spark: SparkSession, tables: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Free SQL over named tables (registered as temporary views)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


class ReportCache:
    """Results of report SQL kept for ``ttl`` seconds per SQL text.

    The cached rows live on the executors (``DataFrame.cache``); the
    driver keeps only the handle and its age.  Every request frees all
    entries that have expired, asked for or not.
    """

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame],
                 ttl: float = 300.0, clock=None):
        import time
        self.spark, self.tables, self.ttl = spark, dict(tables), ttl
        self.clock = clock or time.monotonic
        self._entries: dict[str, tuple[float, DataFrame]] = {}

    def query(self, sql: str) -> DataFrame:
        now = self.clock()
        for old in [k for k, (at, _) in self._entries.items() if now - at >= self.ttl]:
            self._entries.pop(old)[1].unpersist()
        if sql in self._entries:
            return self._entries[sql][1]
        df = run_sql(self.spark, self.tables, sql).cache()
        self._entries[sql] = (now, df)
        return df

    def clear(self) -> None:
        for _, df in self._entries.values():
            df.unpersist()
        self._entries.clear()
