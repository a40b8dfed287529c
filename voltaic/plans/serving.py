"""Serving views and declared marts over the gold snapshot
(A3-A5, A12, A13, P26-P29, P34, J8, W1, W2).

The serving layer names columns as the declared tables do (``rt_price``,
``pct_*``); they bind to gold: rt_price is the energy price, fractions
derive from MW.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import classify_by, round_half_up, row_sum, safe_div
from ..operators.topk import latest
from ..operators.windows import with_rolling

KEYS = list(config.KEYS)


def _frac(fuel: str) -> F.Column:
    return safe_div(F.col(config.fuel_column(fuel)), F.col("total_generation_mw"))


def carbon_by_hour(snapshot: DataFrame) -> DataFrame:
    """Average, minimum and maximum intensity and the sample count by hour
    of day; hours without intensity are left out."""
    c = F.col("carbon_intensity_gco2_kwh")
    return (snapshot.filter(c.isNotNull()).groupBy(*config.series_of(snapshot), "hour")
            .agg(round_half_up(F.avg(c), 2).alias("avg_carbon_intensity"),
                 round_half_up(F.min(c), 2).alias("min_carbon_intensity"),
                 round_half_up(F.max(c), 2).alias("max_carbon_intensity"),
                 F.count(F.lit(1)).alias("sample_count")))


def daily_summary(snapshot: DataFrame) -> DataFrame:
    """Daily demand, generation, renewable percent, price, carbon and
    temperature, rounded to 1 or 2 digits."""
    d = F.col("region_demand")
    return snapshot.groupBy(*config.series_of(snapshot), "date").agg(
        round_half_up(F.avg(d), 1).alias("avg_demand_mw"),
        round_half_up(F.max(d), 1).alias("peak_demand_mw"),
        round_half_up(F.min(d), 1).alias("min_demand_mw"),
        round_half_up(F.avg("total_generation_mw"), 1).alias("avg_generation_mw"),
        round_half_up(F.avg("renewable_frac") * 100, 2).alias("avg_pct_renewable"),
        round_half_up(F.avg("energy_price"), 2).alias("avg_rt_price"),
        round_half_up(F.max("energy_price"), 2).alias("max_rt_price"),
        round_half_up(F.avg("carbon_intensity_gco2_kwh"), 2).alias("avg_carbon_intensity"),
        round_half_up(F.avg("temperature_c"), 1).alias("avg_temperature_c"))


def monthly_renewables(snapshot: DataFrame) -> DataFrame:
    """Monthly mean shares (percent) of renewables and of each fuel."""
    return (snapshot.groupBy(*config.series_of(snapshot), F.year("date").alias("year"),
                             F.month("date").alias("month"))
            .agg(round_half_up(F.avg("renewable_frac") * 100, 2).alias("avg_pct_renewable"),
                 *[round_half_up(F.avg(_frac(f)) * 100, 2).alias(f"avg_pct_{f.lower()}")
                   for f in ("Wind", "Solar", "Hydro", "Nuclear", "Gas")]))


MIX_FUELS = config.MIX_FUELS


def hourly_generation_mix(snapshot: DataFrame) -> DataFrame:
    """MW per fuel and percent shares per hour."""
    return snapshot.select(
        *config.series_of(snapshot), *KEYS, *[config.fuel_column(f) for f in MIX_FUELS],
        "total_generation_mw",
        *[F.col(config.fuel_column(f, "pct")).alias(f"pct_{f.lower()}")
          for f in ("Nuclear", "Gas", "Hydro", "Wind", "Solar")],
        round_half_up(F.col("renewable_frac") * 100, 2).alias("pct_renewable"))


def with_dayahead(snapshot: DataFrame, dayahead: DataFrame) -> DataFrame:
    """Snapshot with the day-ahead price joined (left, on the hour key)."""
    on = [c for c in config.series_of(snapshot) if c in dayahead.columns] + KEYS
    return snapshot.join(dayahead.select(*on, "da_price"), on=on, how="left")


def price_analysis(snapshot: DataFrame, dayahead: DataFrame) -> DataFrame:
    """Real-time and day-ahead price, spread and regime (>100 Spike, <0
    Negative, else Normal; an unknown price is Normal)."""
    s = with_dayahead(snapshot, dayahead)
    return s.select(
        *config.series_of(s), *KEYS, round_half_up(F.col("energy_price"), 2).alias("rt_price"),
        round_half_up(F.col("da_price"), 2).alias("da_price"),
        round_half_up(F.col("da_price") - F.col("energy_price"), 2).alias("price_spread"),
        "is_weekday", "is_peak_hour", "season",
        classify_by("energy_price", config.PRICE_REGIMES).alias("price_regime"))


def price_spreads(snapshot: DataFrame, dayahead: DataFrame) -> DataFrame:
    """Spread = day-ahead - real-time, its absolute value and sign, for
    hours that have both prices."""
    s = with_dayahead(snapshot, dayahead).filter(
        F.col("energy_price").isNotNull() & F.col("da_price").isNotNull())
    spread = F.col("da_price") - F.col("energy_price")
    return s.select(
        *config.series_of(s), *KEYS, round_half_up(F.col("energy_price"), 2).alias("rt_price"),
        round_half_up(F.col("da_price"), 2).alias("da_price"),
        round_half_up(spread, 2).alias("spread"),
        round_half_up(F.abs(spread), 2).alias("abs_spread"),
        (F.col("da_price") > F.col("energy_price")).alias("is_positive_spread"))


CONTRIBUTION_FUELS = ("Nuclear", "Gas", "Hydro", "Wind", "Solar")


def carbon_contribution(snapshot: DataFrame) -> DataFrame:
    """Each fuel's part of the intensity: fuel * factor / total."""
    total = F.col("total_generation_mw")
    return snapshot.filter(total.isNotNull()).select(
        *config.series_of(snapshot), *KEYS, "carbon_intensity_gco2_kwh",
        *[round_half_up(safe_div(F.col(config.fuel_column(f)) *
                                 F.lit(config.CARBON_FACTORS[f]), total), 2)
          .alias(f"{f.lower()}_contribution") for f in CONTRIBUTION_FUELS])


def daily_generation_mix(snapshot: DataFrame) -> DataFrame:
    """Daily energy per fuel (MWh = sum of hourly MW), shares of the day's
    total, demand peak, minimum and mean, price and carbon figures."""
    total = F.sum("total_generation_mw")
    renewable = F.sum(row_sum(config.fuel_column(f) for f in config.RENEWABLE_FUELS))
    d = F.col("region_demand")
    return snapshot.groupBy(*config.series_of(snapshot), "date").agg(
        *[round_half_up(F.sum(config.fuel_column(f)), 1).alias(f"{f.lower()}_mwh")
          for f in MIX_FUELS],
        round_half_up(total, 1).alias("total_mwh"),
        *[round_half_up(safe_div(F.sum(config.fuel_column(f)), total), 4)
          .alias(f"pct_{f.lower()}") for f in ("Nuclear", "Gas", "Hydro", "Wind", "Solar")],
        round_half_up(safe_div(renewable, total), 4).alias("pct_renewable"),
        F.max(d).alias("peak_demand_mw"), F.min(d).alias("min_demand_mw"),
        round_half_up(F.avg(d), 1).alias("avg_demand_mw"),
        round_half_up(F.avg("energy_price"), 2).alias("avg_price"),
        round_half_up(F.max("energy_price"), 2).alias("max_price"),
        round_half_up(F.min("energy_price"), 2).alias("min_price"),
        round_half_up(F.avg("carbon_intensity_gco2_kwh"), 2).alias("avg_carbon_intensity"))


def renewable_penetration(snapshot: DataFrame, series: Sequence[str] | None = None) -> DataFrame:
    """Daily renewable energy and share with 7- and 30-day rolling means of
    the share (calendar ranges).  The window runs on the daily rows, one
    per day and series."""
    series = list(series) if series is not None else config.series_of(snapshot)
    renewable = row_sum(config.fuel_column(f) for f in config.RENEWABLE_FUELS)
    daily = (snapshot.groupBy(*series, "date")
             .agg(F.sum(renewable).alias("_ren"), F.sum("total_generation_mw").alias("_tot"),
                  F.sum("wind_mw").alias("_wind"), F.sum("solar_mw").alias("_solar"),
                  F.sum("hydro_mw").alias("_hydro"))
             .withColumn("_frac", safe_div(F.col("_ren"), F.col("_tot"))))
    rolled = with_rolling(daily, "_frac", {"_r7": 7, "_r30": 30}, series=series)
    return rolled.select(
        *series, "date", F.year("date").alias("year"), F.month("date").alias("month"),
        round_half_up(F.col("_ren"), 1).alias("renewable_mwh"),
        round_half_up(F.col("_tot"), 1).alias("total_mwh"),
        round_half_up(F.col("_frac"), 4).alias("pct_renewable"),
        round_half_up(F.col("_wind"), 1).alias("wind_mwh"),
        round_half_up(F.col("_solar"), 1).alias("solar_mwh"),
        round_half_up(F.col("_hydro"), 1).alias("hydro_mwh"),
        round_half_up(F.col("_r7"), 4).alias("pct_renewable_7d_avg"),
        round_half_up(F.col("_r30"), 4).alias("pct_renewable_30d_avg"))


def latest_grid_status(snapshot: DataFrame) -> DataFrame:
    """All columns of the latest hour (of each region), one row per region."""
    return latest(snapshot, 1, series=config.series_of(snapshot))


VIEW_NAMES = ("v_latest_grid_status", "v_daily_summary", "v_hourly_generation_mix",
              "v_price_analysis", "v_carbon_by_hour", "v_monthly_renewables")


def named_views(snapshot: DataFrame, dayahead: DataFrame) -> dict[str, DataFrame]:
    """The six serving views as lazy DataFrames over the snapshot."""
    return {
        "v_latest_grid_status": latest_grid_status(snapshot),
        "v_daily_summary": daily_summary(snapshot),
        "v_hourly_generation_mix": hourly_generation_mix(snapshot),
        "v_price_analysis": price_analysis(snapshot, dayahead),
        "v_carbon_by_hour": carbon_by_hour(snapshot),
        "v_monthly_renewables": monthly_renewables(snapshot),
    }


def register_views(snapshot: DataFrame, dayahead: DataFrame) -> list[str]:
    """Register the six views as temporary views for SQL; returns names."""
    views = named_views(snapshot, dayahead)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


# FIXED VALUES: declared decimal types of the serving tables, by the shape of
# the column name (first match) -- energy and power, prices, shares, carbon,
# weather.
SERVING_TYPES = (
    ("_mwh", "decimal(12,1)"), ("_mw", "decimal(10,1)"), ("price", "decimal(10,2)"), ("spread", "decimal(10,2)"),
    ("carbon_intensity", "decimal(8,2)"), ("_contribution", "decimal(8,2)"), ("pct_", "decimal(6,4)"),
    ("temperature_c", "decimal(5,1)"), ("humidity_pct", "decimal(5,1)"), ("wind_speed_kmh", "decimal(5,1)"),
)
DECLARED = ("fct_hourly_grid_snapshot", "fct_daily_generation_mix", "fct_price_spreads", "fct_carbon_intensity", "mart_renewable_penetration")
# Serving tables with one row per day or hour, laid out by month; a change in
# a month changes only that month of them, but for the rolling means, which
# reach into the next.
MONTHLY = ("fct_hourly_grid_snapshot", "fct_daily_generation_mix", "fct_price_spreads", "fct_carbon_intensity",
           "v_daily_summary", "v_hourly_generation_mix", "v_price_analysis")


def declared_types(df: DataFrame) -> DataFrame:
    """Measures (doubles, and whole MW) as the decimals that the serving tables
    declare."""
    kind = lambda c: next((t for part, t in SERVING_TYPES if part in c), None)
    return df.select(*[F.col(c).cast(kind(c)).alias(c) if t in ("double", "int") and kind(c) else F.col(c) for c, t in df.dtypes])


def hourly_fact(snapshot: DataFrame, dayahead: DataFrame) -> DataFrame:
    """The hourly snapshot under the names of the declared serving fact:
    demand in MW, shares as fractions, real-time and day-ahead price with
    their spread, weather, carbon, losses and reserves, time features."""
    s = with_dayahead(snapshot, dayahead)
    have = lambda c: F.col(c) if c in s.columns else F.lit(None).cast("double")
    return s.select(
        *config.series_of(s), *KEYS,
        F.col("market_demand").alias("market_demand_mw"), F.col("region_demand").alias("region_demand_mw"),
        *[config.fuel_column(f) for f in MIX_FUELS], "total_generation_mw",
        *[_frac(f).alias(f"pct_{f.lower()}") for f in ("Nuclear", "Gas", "Hydro", "Wind", "Solar")],
        F.col("renewable_frac").alias("pct_renewable"),
        F.col("energy_price").alias("rt_price"), "da_price", (F.col("da_price") - F.col("energy_price")).alias("price_spread"),
        "temperature_c", "humidity_pct", "wind_speed_kmh",
        F.col("carbon_intensity_gco2_kwh").alias("carbon_intensity_gco2"),
        *[have(c).alias(c) for c in ("total_loss_mw", "reserve_10s_mw", "reserve_10n_mw", "reserve_30r_mw")],
        "is_weekday", "is_peak_hour", "season", "day_of_week", F.current_timestamp().alias("loaded_at"))


def serving_tables(fact: DataFrame, dayahead: DataFrame | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Builders of everything the serving layer holds: the declared facts and
    marts with their decimal types, and the six views.  Without a day-ahead
    feed the tables that need one have NULL there."""
    if dayahead is None:
        dayahead = fact.select(*config.series_of(fact), *KEYS, F.lit(None).cast("double").alias("da_price")).limit(0)
    marts = {
        "fct_hourly_grid_snapshot": lambda: hourly_fact(fact, dayahead),
        "fct_daily_generation_mix": lambda: daily_generation_mix(fact),
        "fct_price_spreads": lambda: price_spreads(fact, dayahead),
        "fct_carbon_intensity": lambda: carbon_contribution(fact),
        "mart_renewable_penetration": lambda: renewable_penetration(fact),
    }
    views = {name: (lambda df=df: df) for name, df in named_views(fact, dayahead).items()}
    return {**{n: (lambda b=b: declared_types(b())) for n, b in marts.items()}, **views}
