"""Named queries over the driver's tables: ``QUERIES[name](spark, sf_dir)``
returns a DataFrame; ``ORACLE[name]`` is the same query in DuckDB SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from .. import oracle as O
from ..functions import round_half_up, row_sum
from ..operators.dedupe import keep_last
from ..operators.windows import with_rolling
from ..sources import bindings as B
from . import gold as G
from . import silver as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.with_ctes(sql)
        return fn
    return deco


# --- shared plans -------------------------------------------------------------
#
# A DataFrame is an immutable, lazy plan.  The snapshot plan that most
# queries start from is built once per catalog and then reused; every query
# still executes it in full from the files (nothing is cached), but the
# driver does not analyse the same 40 operators again.

class Catalog:
    """The named queries over one folder, with the plans they share.

    Plans hold the file list of the moment they were built, so a catalog sees
    the folder as it was; make a new one to see files that came later."""

    _current: dict[tuple[str, str], Catalog] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.plans: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Catalog:
        """The catalog that ``QUERIES`` use for this session and folder."""
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in cls._current:
            cls._current[key] = cls(spark, sf_dir)
        return cls._current[key]

    def use(self) -> Catalog:
        """Let ``QUERIES`` over this folder use this catalog from now on."""
        self._current[self.spark.sparkContext.applicationId, self.sf_dir] = self
        return self

    def query(self, name: str) -> DataFrame:
        return QUERIES[name](self.use().spark, self.sf_dir)


def _shared(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    plans = Catalog.of(spark, sf_dir).plans
    if name not in plans:
        plans[name] = build()
    return plans[name]


def silver_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, sf_dir, "silver_demand",
                   lambda: S.demand(B.demand_feed(spark, sf_dir)))


def generation_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, sf_dir, "generation_wide",
                   lambda: S.generation_wide(B.generation_feed(spark, sf_dir)))


def silver_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, sf_dir, "silver_generation",
                   lambda: S.with_generation_shares(generation_wide(spark, sf_dir)))


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, sf_dir, "snapshot", lambda: G.hourly_snapshot(
        silver_demand(spark, sf_dir),
        silver_generation(spark, sf_dir),
        S.prices(B.price_feed(spark, sf_dir)),
        S.weather(B.weather_feed(spark, sf_dir))))


def carbon_mart_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, sf_dir, "carbon_mart",
                   lambda: G.carbon_mart(snapshot(spark, sf_dir)))


def daily_mart_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, sf_dir, "daily_mart",
                   lambda: G.mart_daily_summary(snapshot(spark, sf_dir)))


# --- step 1: dedupe and pivot ---------------------------------------------------

@register("dedupe_last", """
SELECT date, hour, market_demand, region_demand
FROM (SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY _row_id DESC) AS rn
      FROM b_demand) WHERE rn = 1""")
def dedupe_last(spark, sf_dir):
    """The last published demand row per hour."""
    return keep_last(B.demand_feed(spark, sf_dir), ["date", "hour"], ["_row_id"],
                     drop_order=True)


@register("generation_pivot", "SELECT * FROM s_gen_total")
def generation_pivot(spark, sf_dir):
    """One row per hour, a MW column per fuel, total."""
    return generation_wide(spark, sf_dir).withColumn("total_generation_mw",
                                                     row_sum(S.MW_COLUMNS))


# The event feed with two types mapped to fuels outside the list and outputs
# moved down, so that unlisted fuels and negative outputs occur.
def unlisted_feed(spark, sf_dir):
    fuel = F.col("fuel_type")
    return (B.generation_feed(spark, sf_dir)
            .withColumn("fuel_type", F.when(fuel == "Solar", "Coal").when(fuel == "Wind", "Oil").otherwise(fuel))
            .withColumn("output_mw", F.col("output_mw") - UNLISTED_SHIFT))


UNLISTED_SHIFT = 40
UNLISTED_SQL = f"""(SELECT date, hour, CASE fuel_type WHEN 'Solar' THEN 'Coal' WHEN 'Wind' THEN 'Oil' ELSE fuel_type END AS fuel_type,
       output_mw - {UNLISTED_SHIFT} AS output_mw, _published_at, _row_id FROM b_generation)"""


@register("generation_unlisted", f"""
SELECT date, hour, nuclear_mw, hydro_mw, gas_mw, other_mw, nuclear_mw + hydro_mw + gas_mw + other_mw AS total_generation_mw
FROM (SELECT date, hour, coalesce(sum(output_mw) FILTER (WHERE fuel_type = 'Nuclear'), 0.0) AS nuclear_mw,
             coalesce(sum(output_mw) FILTER (WHERE fuel_type = 'Hydro'), 0.0) AS hydro_mw,
             coalesce(sum(output_mw) FILTER (WHERE fuel_type = 'Gas'), 0.0) AS gas_mw,
             coalesce(sum(output_mw) FILTER (WHERE fuel_type IN ('Coal', 'Oil')), 0.0) AS other_mw
      FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date, hour, fuel_type
                                                       ORDER BY _published_at DESC, _row_id DESC) AS rn
                           FROM {UNLISTED_SQL}) WHERE rn = 1 AND output_mw >= 0)
      GROUP BY date, hour)""")
def generation_unlisted(spark, sf_dir):
    """Fuels outside the list count in other_mw and the total;
    negative outputs are dropped after keep-last."""
    wide = S.with_generation_shares(S.generation_wide(unlisted_feed(spark, sf_dir)))
    return wide.select("date", "hour", "nuclear_mw", "hydro_mw", "gas_mw", "other_mw", "total_generation_mw")


@register("generation_shares", "SELECT * FROM s_generation")
def generation_shares(spark, sf_dir):
    """Percent share per fuel, clean share, renewable fraction."""
    return silver_generation(spark, sf_dir)


# --- step 3: snapshot and carbon -------------------------------------------------

@register("hourly_snapshot", "SELECT * FROM snapshot")
def hourly_snapshot(spark, sf_dir):
    """Demand left join generation, prices, weather; carbon."""
    return snapshot(spark, sf_dir)


@register("carbon_mart", "SELECT * FROM carbon_mart")
def carbon_mart(spark, sf_dir):
    """Hourly intensity and its class."""
    return carbon_mart_plan(spark, sf_dir)


# --- step 5: aggregates and views -------------------------------------------------

@register("mart_daily_summary", "SELECT * FROM daily_mart")
def mart_daily_summary(spark, sf_dir):
    """A2, P24."""
    return daily_mart_plan(spark, sf_dir)


@register("carbon_by_hour", f"""
SELECT hour, {O.R('avg(carbon_intensity_gco2_kwh)')} AS avg_carbon_intensity,
       {O.R('min(carbon_intensity_gco2_kwh)')} AS min_carbon_intensity,
       {O.R('max(carbon_intensity_gco2_kwh)')} AS max_carbon_intensity,
       count(*) AS sample_count
FROM snapshot WHERE carbon_intensity_gco2_kwh IS NOT NULL GROUP BY hour""")
def carbon_by_hour(spark, sf_dir):
    """A4: intensity by hour of day, NULLs left out."""
    from . import serving
    return serving.carbon_by_hour(snapshot(spark, sf_dir))


# --- step 2: silver features ---------------------------------------------------------

@register("time_features", f"SELECT *, {O.TIME_FEATURES} FROM s_generation")
def time_features(spark, sf_dir):
    """P5: the silver generation table with its time features."""
    from ..functions import with_time_features
    return with_time_features(silver_generation(spark, sf_dir))


@register("demand_class", "SELECT * FROM s_demand")
def demand_class(spark, sf_dir):
    """Silver demand with class and export."""
    return silver_demand(spark, sf_dir)


@register("price_class", "SELECT * FROM s_prices")
def price_class(spark, sf_dir):
    """Silver prices."""
    return S.prices(B.price_feed(spark, sf_dir))


@register("weather_class", "SELECT * FROM s_weather")
def weather_class(spark, sf_dir):
    """Silver weather."""
    return S.weather(B.weather_feed(spark, sf_dir))


@register("realtime_loss", f"""
SELECT *, total_energy - total_loss AS net_load,
       {O.PCT('total_loss', 'total_energy')} AS loss_pct
FROM b_realtime""")
def realtime_loss(spark, sf_dir):
    """Net load and loss percent of the 5-minute totals."""
    return S.realtime(B.realtime_feed(spark, sf_dir))


@register("intertie_flow", f"""
SELECT *, schedule_import_mw - schedule_export_mw AS net_scheduled_flow_mw,
       CASE WHEN schedule_import_mw - schedule_export_mw > 0 THEN 'Import'
            WHEN schedule_import_mw - schedule_export_mw < 0 THEN 'Export'
            ELSE 'Balanced' END AS flow_direction, {O.TIME_FEATURES}
FROM b_intertie""")
def intertie_flow(spark, sf_dir):
    """Net scheduled flow and direction."""
    return S.intertie(B.intertie_feed(spark, sf_dir))


# --- step 3 (cont.): factors and contributions -----------------------------------------

FUEL_VALUES = ("(VALUES ('Nuclear', 'Baseload', false, 12), ('Hydro', 'Baseload', true, 24), "
               "('Wind', 'Renewable', true, 11), ('Solar', 'Renewable', true, 45), "
               "('Gas', 'Peaking', false, 490), ('Biofuel', 'Renewable', true, 230)) "
               "AS f(fuel_type, fuel_category, is_renewable, carbon_factor_gco2_kwh)")


@register("generation_factors", f"""
SELECT g.fuel_type, g.date, g.hour, g.output_mw, f.fuel_category, f.is_renewable,
       CAST(f.carbon_factor_gco2_kwh AS INTEGER) AS carbon_factor_gco2_kwh,
       g.output_mw * f.carbon_factor_gco2_kwh AS emissions_kg
FROM g_last g LEFT JOIN {FUEL_VALUES} ON g.fuel_type = f.fuel_type""")
def generation_factors(spark, sf_dir):
    """Latest output per hour and fuel with the fuel's seed
    attributes and emissions (MWh x g/kWh = kg)."""
    return G.with_factors(S.generation_last(B.generation_feed(spark, sf_dir)),
                          G.dim_fuel_type(spark))


@register("carbon_contribution", f"""
SELECT date, hour, carbon_intensity_gco2_kwh,
       {', '.join(O.R(O.DIV(f.lower() + '_mw * ' + str(O.FACTORS[f.lower()]), 'total_generation_mw')) + ' AS ' + f.lower() + '_contribution' for f in ('Nuclear', 'Gas', 'Hydro', 'Wind', 'Solar'))}
FROM snapshot WHERE total_generation_mw IS NOT NULL""")
def carbon_contribution(spark, sf_dir):
    """Each fuel's share of the intensity."""
    from . import serving
    return serving.carbon_contribution(snapshot(spark, sf_dir))


# --- step 4: dimensions ----------------------------------------------------------------

@register("dim_date", """
SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
       CAST(day(date) AS INTEGER) AS day_of_month,
       CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name,
       coalesce(dayofweek(date) + 1 BETWEEN 2 AND 6, false) AS is_weekday,
       CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5)
            THEN 'Spring' WHEN month(date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
       CAST(week(date) AS INTEGER) AS week_of_year, false AS is_holiday
FROM (SELECT CAST(d AS DATE) AS date
      FROM (SELECT min(date) AS lo, max(date) AS hi FROM s_demand),
           generate_series(lo, hi, INTERVAL 1 DAY) AS t(d))""")
def dim_date(spark, sf_dir):
    """Calendar from the first to the last demand date."""
    return G.dim_date(silver_demand(spark, sf_dir))


# --- step 5: views ---------------------------------------------------------------------

@register("daily_summary", f"""
SELECT date, {O.R('avg(region_demand)', 1)} AS avg_demand_mw,
       {O.R('max(region_demand)', 1)} AS peak_demand_mw,
       {O.R('min(region_demand)', 1)} AS min_demand_mw,
       {O.R('avg(total_generation_mw)', 1)} AS avg_generation_mw,
       {O.R('avg(renewable_frac) * 100')} AS avg_pct_renewable,
       {O.R('avg(energy_price)')} AS avg_rt_price, {O.R('max(energy_price)')} AS max_rt_price,
       {O.R('avg(carbon_intensity_gco2_kwh)')} AS avg_carbon_intensity,
       {O.R('avg(temperature_c)', 1)} AS avg_temperature_c
FROM snapshot GROUP BY date""")
def daily_summary(spark, sf_dir):
    """A3: the daily view."""
    from . import serving
    return serving.daily_summary(snapshot(spark, sf_dir))


@register("monthly_renewables", f"""
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       {O.R('avg(renewable_frac) * 100')} AS avg_pct_renewable,
       {', '.join(O.R('avg(' + O.DIV(f + '_mw', 'total_generation_mw') + ') * 100') + ' AS avg_pct_' + f for f in ('wind', 'solar', 'hydro', 'nuclear', 'gas'))}
FROM snapshot GROUP BY 1, 2""")
def monthly_renewables(spark, sf_dir):
    """A5, P29."""
    from . import serving
    return serving.monthly_renewables(snapshot(spark, sf_dir))


@register("hourly_generation_mix", f"""
SELECT date, hour, nuclear_mw, gas_mw, hydro_mw, wind_mw, solar_mw, biofuel_mw,
       total_generation_mw, nuclear_pct AS pct_nuclear, gas_pct AS pct_gas,
       hydro_pct AS pct_hydro, wind_pct AS pct_wind, solar_pct AS pct_solar,
       {O.R('renewable_frac * 100')} AS pct_renewable
FROM snapshot""")
def hourly_generation_mix(spark, sf_dir):
    """P28."""
    from . import serving
    return serving.hourly_generation_mix(snapshot(spark, sf_dir))


@register("price_regime", f"""
SELECT s.date, s.hour, {O.R('s.energy_price')} AS rt_price, {O.R('d.da_price')} AS da_price,
       {O.R('d.da_price - s.energy_price')} AS price_spread,
       s.is_weekday, s.is_peak_hour, s.season,
       CASE WHEN s.energy_price > 100 THEN 'Spike' WHEN s.energy_price < 0 THEN 'Negative'
            ELSE 'Normal' END AS price_regime
FROM snapshot s LEFT JOIN b_dayahead d ON s.date = d.date AND s.hour = d.hour""")
def price_regime(spark, sf_dir):
    """The price analysis view."""
    from . import serving
    return serving.price_analysis(snapshot(spark, sf_dir),
                                  S.dayahead(B.dayahead_feed(spark, sf_dir)))


@register("price_spread", f"""
SELECT s.date, s.hour, {O.R('s.energy_price')} AS rt_price, {O.R('d.da_price')} AS da_price,
       {O.R('d.da_price - s.energy_price')} AS spread,
       {O.R('abs(d.da_price - s.energy_price)')} AS abs_spread,
       d.da_price > s.energy_price AS is_positive_spread
FROM snapshot s LEFT JOIN b_dayahead d ON s.date = d.date AND s.hour = d.hour
WHERE s.energy_price IS NOT NULL AND d.da_price IS NOT NULL""")
def price_spread(spark, sf_dir):
    """Day-ahead minus real-time spread."""
    from . import serving
    return serving.price_spreads(snapshot(spark, sf_dir),
                                 S.dayahead(B.dayahead_feed(spark, sf_dir)))


@register("latest_grid_status", """
SELECT * FROM snapshot
WHERE (date, hour) = (SELECT (date, hour) FROM snapshot ORDER BY date DESC, hour DESC LIMIT 1)""")
def latest_grid_status(spark, sf_dir):
    """Every column of the latest hour."""
    from . import serving
    return serving.latest_grid_status(snapshot(spark, sf_dir))


# --- step 6: declared marts and windows ----------------------------------------------------

@register("daily_generation_mix", f"""
SELECT date,
       {', '.join(O.R('sum(' + f + '_mw)', 1) + ' AS ' + f + '_mwh' for f in ('nuclear', 'gas', 'hydro', 'wind', 'solar', 'biofuel'))},
       {O.R('sum(total_generation_mw)', 1)} AS total_mwh,
       {', '.join(O.R(O.DIV('sum(' + f + '_mw)', 'sum(total_generation_mw)'), 4) + ' AS pct_' + f for f in ('nuclear', 'gas', 'hydro', 'wind', 'solar'))},
       {O.R(O.DIV('sum(hydro_mw + wind_mw + solar_mw + biofuel_mw)', 'sum(total_generation_mw)'), 4)} AS pct_renewable,
       max(region_demand) AS peak_demand_mw, min(region_demand) AS min_demand_mw,
       {O.R('avg(region_demand)', 1)} AS avg_demand_mw,
       {O.R('avg(energy_price)')} AS avg_price, {O.R('max(energy_price)')} AS max_price,
       {O.R('min(energy_price)')} AS min_price,
       {O.R('avg(carbon_intensity_gco2_kwh)')} AS avg_carbon_intensity
FROM snapshot GROUP BY date""")
def daily_generation_mix(spark, sf_dir):
    """A12."""
    from . import serving
    return serving.daily_generation_mix(snapshot(spark, sf_dir))


@register("renewable_penetration", f"""
SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       {O.R('ren', 1)} AS renewable_mwh, {O.R('tot', 1)} AS total_mwh,
       {O.R('frac', 4)} AS pct_renewable, {O.R('wind', 1)} AS wind_mwh,
       {O.R('solar', 1)} AS solar_mwh, {O.R('hydro', 1)} AS hydro_mwh,
       {O.R('avg(frac) OVER (ORDER BY dn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)', 4)}
           AS pct_renewable_7d_avg,
       {O.R('avg(frac) OVER (ORDER BY dn RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)', 4)}
           AS pct_renewable_30d_avg
FROM (SELECT date, date_diff('day', DATE '1970-01-01', date) AS dn,
             sum(hydro_mw + wind_mw + solar_mw + biofuel_mw) AS ren,
             sum(total_generation_mw) AS tot, sum(wind_mw) AS wind, sum(solar_mw) AS solar,
             sum(hydro_mw) AS hydro,
             {O.DIV('sum(hydro_mw + wind_mw + solar_mw + biofuel_mw)', 'sum(total_generation_mw)')} AS frac
      FROM snapshot GROUP BY date)""")
def renewable_penetration(spark, sf_dir):
    """A13, W1, W2."""
    from . import serving
    return serving.renewable_penetration(snapshot(spark, sf_dir))


@register("rolling_load_by_series", f"""
SELECT series, date, load_mw,
       {O.R('avg(load_mw) OVER (PARTITION BY series ORDER BY dn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)', 4)} AS load_7d_avg,
       {O.R('avg(load_mw) OVER (PARTITION BY series ORDER BY dn RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)', 4)} AS load_30d_avg
FROM (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date,
             date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS dn,
             CAST(sum(CAST(floor(o_totalprice / 1000) AS BIGINT)) AS BIGINT) AS load_mw
      FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL)""")
def rolling_load_by_series(spark, sf_dir):
    """W1, W2 over several years and series, so that frames cross the edges
    of the calendar buckets (the snapshot's days all lie in one)."""
    load = F.sum(F.floor(F.col("o_totalprice") / 1000).cast("long"))
    daily = (B.table(spark, sf_dir, "orders").filter(F.col("o_orderdate").isNotNull())
             .groupBy(F.col("o_orderpriority").alias("series"), F.col("o_orderdate").cast("date").alias("date"))
             .agg(load.alias("load_mw")))
    rolled = with_rolling(daily, "load_mw", {"_r7": 7, "_r30": 30}, series=["series"])
    return rolled.select("series", "date", "load_mw", round_half_up(F.col("_r7"), 4).alias("load_7d_avg"),
                         round_half_up(F.col("_r30"), 4).alias("load_30d_avg"))


# --- step 7: panels ---------------------------------------------------------------------------

@register("latest_status", """
SELECT date, hour, region_demand, total_generation_mw, clean_energy_pct, energy_price,
       carbon_intensity_gco2_kwh
FROM snapshot WHERE total_generation_mw IS NOT NULL ORDER BY date DESC, hour DESC LIMIT 1""")
def latest_status(spark, sf_dir):
    """T1."""
    from . import panels
    return panels.latest_status(snapshot(spark, sf_dir))


@register("last_14_days", """
SELECT date, season, coalesce(avg_demand_mw, 0) AS avg_demand_mw,
       coalesce(peak_demand_mw, 0) AS peak_demand_mw, coalesce(avg_price, 0) AS avg_price,
       coalesce(avg_clean_energy_pct, 0) AS avg_clean_energy_pct,
       coalesce(avg_carbon_intensity, 0) AS avg_carbon_intensity,
       coalesce(avg_temp_c, 0) AS avg_temp_c
FROM (SELECT * FROM daily_mart ORDER BY date DESC LIMIT 14)""")
def last_14_days(spark, sf_dir):
    """T2, P31."""
    from . import panels
    return panels.last_days(daily_mart_plan(spark, sf_dir))


@register("recent_demand", """
SELECT date, hour, region_demand, market_demand,
       CAST(date AS TIMESTAMP) + hour * INTERVAL 1 HOUR AS ts
FROM snapshot WHERE date >= (SELECT max(date) - 7 FROM snapshot)""")
def recent_demand(spark, sf_dir):
    """T3, J9, P30."""
    from . import panels
    return panels.recent_demand(snapshot(spark, sf_dir))


@register("recent_generation", """
SELECT date, hour, nuclear_mw, gas_mw, hydro_mw, wind_mw, solar_mw, biofuel_mw,
       CAST(date AS TIMESTAMP) + hour * INTERVAL 1 HOUR AS ts
FROM snapshot WHERE date >= (SELECT max(date) - 7 FROM snapshot)""")
def recent_generation(spark, sf_dir):
    """T3 on the generation panel."""
    from . import panels
    return panels.recent_generation(snapshot(spark, sf_dir))


@register("average_mix", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS fuel, {O.R('avg(' + f.lower() + '_mw)')} AS avg_mw, "
    f"{O.R(O.DIV('avg(' + f.lower() + '_mw)', ' + '.join('coalesce(avg(' + g.lower() + '_mw), 0.0)' for g in ('Nuclear', 'Gas', 'Hydro', 'Wind', 'Solar', 'Biofuel'))) + ' * 100')} AS share_pct "
    "FROM snapshot" for f in ("Nuclear", "Gas", "Hydro", "Wind", "Solar", "Biofuel")) + ")")
def average_mix(spark, sf_dir):
    """Mean MW per fuel and share of the sum of means."""
    from . import panels
    return panels.average_mix(snapshot(spark, sf_dir))


@register("price_kpis", f"""
SELECT {O.R('avg(energy_price)')} AS avg_price, {O.R('max(energy_price)')} AS max_price,
       {O.R('min(energy_price)')} AS min_price,
       count(*) FILTER (WHERE energy_price > 100) AS spike_hours
FROM snapshot WHERE energy_price IS NOT NULL""")
def price_kpis(spark, sf_dir):
    """A7."""
    from . import panels
    return panels.price_kpis(snapshot(spark, sf_dir))


@register("price_by_hour", f"""
SELECT hour, {O.R('avg(energy_price)')} AS avg_price
FROM snapshot WHERE energy_price IS NOT NULL GROUP BY hour""")
def price_by_hour(spark, sf_dir):
    """A8."""
    from . import panels
    return panels.price_by_hour(snapshot(spark, sf_dir))


@register("price_series", """
SELECT date, hour, energy_price, temperature_c,
       CAST(date AS TIMESTAMP) + hour * INTERVAL 1 HOUR AS ts
FROM snapshot WHERE energy_price IS NOT NULL""")
def price_series(spark, sf_dir):
    """The price panel series."""
    from . import panels
    return panels.price_series(snapshot(spark, sf_dir))


@register("price_temperature_sample", """
SELECT date, hour, temperature_c, energy_price FROM snapshot
WHERE energy_price IS NOT NULL AND temperature_c IS NOT NULL
ORDER BY md5(strftime(date, '%Y-%m-%d') || '|' || CAST(hour AS VARCHAR) || '|7'), date, hour LIMIT 500""")
def price_temperature_sample(spark, sf_dir):
    """At most 500 random hours."""
    from . import panels
    return panels.price_temperature_sample(snapshot(spark, sf_dir))


@register("carbon_kpis", f"""
SELECT {O.R('avg(carbon_intensity_gco2_kwh)')} AS avg_intensity,
       {O.R('min(carbon_intensity_gco2_kwh)')} AS min_intensity,
       {O.R('max(carbon_intensity_gco2_kwh)')} AS max_intensity,
       {O.R(O.DIV("count(*) FILTER (WHERE carbon_category = 'Very Clean')", 'count(*)') + ' * 100')} AS very_clean_pct
FROM carbon_mart""")
def carbon_kpis(spark, sf_dir):
    """A9."""
    from . import panels
    return panels.carbon_kpis(carbon_mart_plan(spark, sf_dir))


@register("carbon_hour_means", f"""
SELECT hour, {O.R('avg(carbon_intensity_gco2_kwh)')} AS avg_carbon_intensity
FROM carbon_mart GROUP BY hour""")
def carbon_hour_means(spark, sf_dir):
    """A10."""
    from . import panels
    return panels.carbon_hour_means(carbon_mart_plan(spark, sf_dir))


@register("carbon_gas_sample", """
SELECT date, hour, gas_mw, carbon_intensity_gco2_kwh, season FROM carbon_mart
ORDER BY md5(strftime(date, '%Y-%m-%d') || '|' || CAST(hour AS VARCHAR) || '|7'), date, hour LIMIT 800""")
def carbon_gas_sample(spark, sf_dir):
    """At most 800 random hours of the carbon mart."""
    from . import panels
    return panels.carbon_gas_sample(carbon_mart_plan(spark, sf_dir))


def gold_tables(spark, sf_dir) -> dict[str, DataFrame]:
    snap = snapshot(spark, sf_dir)
    return {
        "fct_hourly_grid_snapshot": snap,
        "mart_daily_summary": daily_mart_plan(spark, sf_dir),
        "mart_carbon_intensity": carbon_mart_plan(spark, sf_dir),
        "dim_date": G.dim_date(silver_demand(spark, sf_dir)),
        "dim_fuel_type": G.dim_fuel_type(spark),
    }


@register("table_counts", """
SELECT 'fct_hourly_grid_snapshot' AS table_name, count(*) AS rows FROM snapshot
UNION ALL SELECT 'mart_daily_summary', count(*) FROM daily_mart
UNION ALL SELECT 'mart_carbon_intensity', count(*) FROM carbon_mart
UNION ALL SELECT 'dim_date', (SELECT CAST(max(date) - min(date) AS BIGINT) + 1 FROM s_demand)""")
def table_counts(spark, sf_dir):
    """Rows of each gold table that derives from the feeds."""
    from . import panels
    tables = gold_tables(spark, sf_dir)
    return panels.table_counts({n: t for n, t in tables.items() if n != "dim_fuel_type"})


@register("preview", "SELECT * FROM snapshot ORDER BY date, hour LIMIT 100")
def preview(spark, sf_dir):
    """T5: first 100 rows of the snapshot in key order."""
    from . import panels
    return panels.explorer_preview(snapshot(spark, sf_dir))


@register("sql_explorer", """
SELECT date, hour, region_demand, total_generation_mw, energy_price
FROM snapshot ORDER BY date, hour LIMIT 10""")
def sql_explorer(spark, sf_dir):
    """Free SQL over the gold tables, registered as views."""
    from . import panels
    return panels.run_sql(spark, gold_tables(spark, sf_dir), """
        SELECT date, hour, region_demand, total_generation_mw, energy_price
        FROM fct_hourly_grid_snapshot ORDER BY date, hour LIMIT 10""")


# --- step 8: quality -------------------------------------------------------------------------

@register("quality_demand", """
SELECT 'demand' AS source, CAST(sum(n) AS BIGINT) AS rows,
       CAST(sum(neg) AS BIGINT) AS negative_rows, CAST(sum(ext) AS BIGINT) AS extreme_rows,
       CAST(sum(bad) AS BIGINT) AS invalid_hour_rows,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows,
       sum(neg) + sum(ext) + sum(bad) + coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 AS passed
FROM (SELECT date, hour, count(*) AS n,
             count(*) FILTER (WHERE region_demand < 0) AS neg,
             count(*) FILTER (WHERE region_demand > 35000) AS ext,
             count(*) FILTER (WHERE hour < 1 OR hour > 24) AS bad
      FROM b_demand GROUP BY date, hour)""")
def quality_demand(spark, sf_dir):
    """A14 on the raw demand report."""
    from ..operators.quality import quality_demand as q
    return q(B.demand_feed(spark, sf_dir))


@register("quality_generation", """
SELECT 'generation' AS source, CAST(sum(n) AS BIGINT) AS rows,
       CAST(sum(neg) AS BIGINT) AS negative_rows,
       CAST(count(*) FILTER (WHERE fuel IS NULL OR fuel NOT IN
            ('Nuclear', 'Gas', 'Hydro', 'Wind', 'Solar', 'Biofuel')) AS BIGINT) AS unexpected_fuels,
       sum(neg) = 0 AND count(*) FILTER (WHERE fuel IS NULL OR fuel NOT IN
            ('Nuclear', 'Gas', 'Hydro', 'Wind', 'Solar', 'Biofuel')) = 0 AS passed
FROM (SELECT fuel_type AS fuel, count(*) AS n, count(*) FILTER (WHERE output_mw < 0) AS neg
      FROM b_generation GROUP BY fuel_type)""")
def quality_generation(spark, sf_dir):
    """A15 on the raw generation report."""
    from ..operators.quality import quality_generation as q
    return q(B.generation_feed(spark, sf_dir))


@register("quality_prices", """
SELECT 'energy_price' AS column_name,
       count(*) FILTER (WHERE energy_price < -100) AS rows_below_min,
       count(*) FILTER (WHERE energy_price > 10000) AS rows_above_max,
       count(*) FILTER (WHERE energy_price < -100) + count(*) FILTER (WHERE energy_price > 10000) = 0
           AS passed
FROM b_prices""")
def quality_prices(spark, sf_dir):
    """Range checks on named price columns."""
    from ..operators.quality import quality_prices as q
    return q(B.price_feed(spark, sf_dir), ["energy_price"])


@register("unexpected_fuels", """
SELECT DISTINCT fuel_type FROM b_generation
WHERE fuel_type IS NULL OR fuel_type NOT IN ('Nuclear', 'Gas', 'Hydro', 'Wind', 'Solar', 'Biofuel')""")
def unexpected_fuels(spark, sf_dir):
    """J6, A18."""
    from ..operators.joins import unexpected_values
    return unexpected_values(B.generation_feed(spark, sf_dir), "fuel_type",
                             config.EXPECTED_FUELS)


@register("missing_hours", """
SELECT g.date, g.hour
FROM (SELECT CAST(d AS DATE) AS date, h AS hour
      FROM (SELECT min(date) AS lo, max(date) AS hi FROM b_generation),
           generate_series(lo, hi, INTERVAL 1 DAY) AS t(d), range(1, 25) AS r(h)) g
WHERE NOT EXISTS (SELECT 1 FROM b_generation b WHERE b.date = g.date AND b.hour = g.hour)""")
def missing_hours(spark, sf_dir):
    """Hours of the generation report's span without a row."""
    from ..operators.joins import missing_hours as mh
    return mh(B.generation_feed(spark, sf_dir))


@register("profile", """
SELECT 'date' AS column_name, count(date) AS non_null, count(DISTINCT date) AS distinct_values,
       CAST(min(date) AS VARCHAR) AS min_value, CAST(max(date) AS VARCHAR) AS max_value
FROM b_generation
UNION ALL SELECT 'hour', count(hour), count(DISTINCT hour), CAST(min(hour) AS VARCHAR),
       CAST(max(hour) AS VARCHAR) FROM b_generation
UNION ALL SELECT 'fuel_type', count(fuel_type), count(DISTINCT fuel_type), min(fuel_type),
       max(fuel_type) FROM b_generation""")
def profile(spark, sf_dir):
    """Distinct values and ranges of the generation report."""
    from ..operators.quality import profile as p
    return p(B.generation_feed(spark, sf_dir), ["date", "hour", "fuel_type"])


# --- step 10: real-time hourly (batch form of the stream) ----------------------------------------

@register("realtime_hourly", f"""
SELECT date, hour, {O.R('avg(total_energy)')} AS energy_mw, {O.R('avg(total_loss)')} AS loss_mw,
       {O.R('avg(total_load)')} AS load_mw,
       {O.PCT('sum(total_loss)', 'sum(total_energy)')} AS loss_pct,
       {O.R('avg(total_10s)')} AS reserve_10s_mw, {O.R('avg(total_10n)')} AS reserve_10n_mw,
       {O.R('avg(total_30r)')} AS reserve_30r_mw, count(*) AS intervals
FROM b_realtime GROUP BY date, hour""")
def realtime_hourly(spark, sf_dir):
    """K2 (batch form): 5-minute totals to hourly means."""
    from ..streaming.realtime import hourly_totals
    return hourly_totals(S.realtime(B.realtime_feed(spark, sf_dir)))


@register("view_sql", f"""
SELECT v.hour, v.avg_carbon_intensity, p.n_spikes
FROM (SELECT hour, {O.R('avg(carbon_intensity_gco2_kwh)')} AS avg_carbon_intensity
      FROM snapshot WHERE carbon_intensity_gco2_kwh IS NOT NULL GROUP BY hour) v
JOIN (SELECT hour, count(*) FILTER (WHERE energy_price > 100) AS n_spikes
      FROM snapshot GROUP BY hour) p ON v.hour = p.hour""")
def view_sql(spark, sf_dir):
    """SQL over the registered serving views (carbon by hour beside the
    number of spike hours of the price view)."""
    from . import serving
    serving.register_views(snapshot(spark, sf_dir),
                           S.dayahead(B.dayahead_feed(spark, sf_dir)))
    return spark.sql("""
        SELECT v.hour, v.avg_carbon_intensity, p.n_spikes
        FROM v_carbon_by_hour v
        JOIN (SELECT hour, count_if(price_regime = 'Spike') AS n_spikes
              FROM v_price_analysis GROUP BY hour) p ON v.hour = p.hour""")


@register("snapshot_losses", f"""
SELECT s.date, s.hour, s.region_demand, s.total_generation_mw, s.energy_price,
       r.loss AS total_loss_mw, r.r1 AS reserve_10s_mw, r.r2 AS reserve_10n_mw, r.r3 AS reserve_30r_mw
FROM snapshot s LEFT JOIN (
  SELECT date, hour, {O.R('avg(total_loss)')} AS loss, {O.R('avg(total_10s)')} AS r1,
         {O.R('avg(total_10n)')} AS r2, {O.R('avg(total_30r)')} AS r3
  FROM b_realtime GROUP BY date, hour) r ON s.date = r.date AND s.hour = r.hour""")
def snapshot_losses(spark, sf_dir):
    """The snapshot with its fourth side, loss and reserves."""
    from ..streaming.realtime import hourly_totals, snapshot_side
    hourly = hourly_totals(S.realtime(B.realtime_feed(spark, sf_dir)))
    snap = G.hourly_snapshot(silver_demand(spark, sf_dir), silver_generation(spark, sf_dir),
                             S.prices(B.price_feed(spark, sf_dir)), realtime=snapshot_side(hourly))
    return snap.select("date", "hour", "region_demand", "total_generation_mw", "energy_price",
                       "total_loss_mw", "reserve_10s_mw", "reserve_10n_mw", "reserve_30r_mw")


# --- checks that find something --------------------------------------------------------------

@register("missing_price_hours", """
SELECT g.date, g.hour
FROM (SELECT CAST(d AS DATE) AS date, h AS hour
      FROM (SELECT min(date) AS lo, max(date) AS hi FROM b_demand),
           generate_series(lo, hi, INTERVAL 1 DAY) AS t(d), range(1, 25) AS r(h)) g
WHERE NOT EXISTS (SELECT 1 FROM b_prices b WHERE b.date = g.date AND b.hour = g.hour)""")
def missing_price_hours(spark, sf_dir):
    """Hours of the demand calendar without a price."""
    from ..operators.joins import missing_hours as mh
    return mh(B.price_feed(spark, sf_dir), calendar=B.demand_feed(spark, sf_dir))


@register("unlisted_fuels", f"""
SELECT DISTINCT fuel_type FROM {UNLISTED_SQL}
WHERE fuel_type IS NULL OR fuel_type NOT IN ('Nuclear', 'Gas', 'Hydro', 'Wind', 'Solar', 'Biofuel')""")
def unlisted_fuels(spark, sf_dir):
    """J6, A18, U2 on a feed that holds fuels outside the list."""
    from ..operators.joins import unexpected_values
    return unexpected_values(unlisted_feed(spark, sf_dir), "fuel_type", config.EXPECTED_FUELS)


@register("quality_unlisted", f"""
SELECT 'generation' AS source, count(*) AS rows, count(*) FILTER (WHERE output_mw < 0) AS negative_rows,
       count(DISTINCT fuel_type) FILTER (WHERE fuel_type NOT IN
            ('Nuclear', 'Gas', 'Hydro', 'Wind', 'Solar', 'Biofuel')) AS unexpected_fuels, false AS passed
FROM {UNLISTED_SQL}""")
def quality_unlisted(spark, sf_dir):
    """A15 on a feed with negative outputs and unlisted fuels."""
    from ..operators.quality import quality_generation as q
    return q(unlisted_feed(spark, sf_dir))


@register("quality_price_bounds", """
SELECT 'energy_price' AS column_name, count(*) FILTER (WHERE energy_price < 0) AS rows_below_min,
       count(*) FILTER (WHERE energy_price > 100) AS rows_above_max, false AS passed
FROM b_prices""")
def quality_price_bounds(spark, sf_dir):
    """A16 with tighter bounds, so that some rows fail."""
    from ..operators.quality import quality_prices as q
    return q(B.price_feed(spark, sf_dir), ["energy_price"], low=0, high=100)


# --- many regions ------------------------------------------------------------------------------

def regional_snapshot_plan(spark, sf_dir) -> DataFrame:
    return _shared(spark, sf_dir, "regional_snapshot", lambda: G.hourly_snapshot(
        S.demand(B.regional(spark, sf_dir, "demand")),
        S.generation(B.regional(spark, sf_dir, "generation"), features=False),
        S.prices(B.regional(spark, sf_dir, "prices")),
        S.weather(B.regional(spark, sf_dir, "weather"))))


_R = B.REGIONS
_REGIONAL_SQL = f"""
d AS (SELECT * FROM (SELECT 'R' || CAST(o_custkey % {_R} AS VARCHAR) AS region, b.*,
        row_number() OVER (PARTITION BY o_custkey % {_R}, date, hour ORDER BY _row_id DESC) AS rn
      FROM b_demand b JOIN orders ON o_orderkey = _row_id) WHERE rn = 1),
g AS (SELECT region, date, hour, sum(output_mw) FILTER (WHERE fuel_type = 'Nuclear') AS nuclear,
             sum(CAST(output_mw AS DECIMAL(20,4))) AS total
      FROM (SELECT 'R' || CAST(_row_id % {_R} AS VARCHAR) AS region, b.*,
              row_number() OVER (PARTITION BY _row_id % {_R}, date, hour, fuel_type ORDER BY _published_at DESC, _row_id DESC) AS rn
            FROM b_generation b) WHERE rn = 1 AND output_mw >= 0 GROUP BY region, date, hour),
p AS (SELECT * FROM (SELECT 'R' || CAST(c_nationkey % {_R} AS VARCHAR) AS region, b.*,
        row_number() OVER (PARTITION BY c_nationkey % {_R}, date, hour ORDER BY _row_id DESC) AS rn
      FROM b_prices b JOIN customer ON c_custkey = _row_id) WHERE rn = 1),
w AS (SELECT * FROM (SELECT 'R' || CAST(_row_id % {_R} AS VARCHAR) AS region, b.*,
        row_number() OVER (PARTITION BY _row_id % {_R}, date, hour ORDER BY _row_id DESC) AS rn
      FROM b_weather b) WHERE rn = 1),
r AS (SELECT d.region, d.date, d.hour, d.region_demand, coalesce(g.nuclear, CASE WHEN g.total IS NOT NULL THEN 0.0 END) AS nuclear_mw,
             {O.R('g.total')} AS total_generation_mw, p.energy_price, w.temperature_c
      FROM d LEFT JOIN g ON (d.region, d.date, d.hour) = (g.region, g.date, g.hour)
             LEFT JOIN p ON (d.region, d.date, d.hour) = (p.region, p.date, p.hour)
             LEFT JOIN w ON (d.region, d.date, d.hour) = (w.region, w.date, w.hour))"""


def _regional(sql: str) -> str:
    """Prefix the regional tables, after the shared ones that they name."""
    head = O.with_ctes("SELECT * FROM b_demand, b_generation, b_prices, b_weather").rpartition("\nSELECT")[0]
    return f"{head},{_REGIONAL_SQL}\n{sql}"


def _register_regional(name: str, sql: str):
    def deco(fn: Query) -> Query:
        QUERIES[name], ORACLE[name] = fn, _regional(sql)
        return fn
    return deco


@_register_regional("regional_snapshot", "SELECT * FROM r")
def regional_snapshot(spark, sf_dir):
    """J1-J3 with a region column leading every key."""
    from ..functions import round_half_up
    return regional_snapshot_plan(spark, sf_dir).select(
        "region", "date", "hour", "region_demand", "nuclear_mw",
        round_half_up("total_generation_mw", 2).alias("total_generation_mw"), "energy_price", "temperature_c")


@_register_regional("regional_latest_status", """
SELECT region, date, hour, region_demand, total_generation_mw, energy_price
FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY date DESC, hour DESC) AS n
      FROM r WHERE total_generation_mw IS NOT NULL) WHERE n = 1""")
def regional_latest_status(spark, sf_dir):
    """T1 per region."""
    from ..functions import round_half_up
    from . import panels
    return panels.latest_status(regional_snapshot_plan(spark, sf_dir)).select(
        "region", "date", "hour", "region_demand",
        round_half_up("total_generation_mw", 2).alias("total_generation_mw"), "energy_price")


@_register_regional("regional_missing_hours", """
SELECT c.region, CAST(c.d AS DATE) AS date, c.hour
FROM (SELECT region, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d, h AS hour
      FROM (SELECT region, min(date) AS lo, max(date) AS hi FROM g GROUP BY region), range(1, 25) AS t(h)) c
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.region = c.region AND p.date = c.d AND p.hour = c.hour)""")
def regional_missing_hours(spark, sf_dir):
    """J7 per region: hours of a region's generation calendar without a price."""
    from ..operators.joins import missing_hours as mh
    return mh(B.regional(spark, sf_dir, "prices"), calendar=B.regional(spark, sf_dir, "generation"))


@_register_regional("regional_price_by_hour", f"""
SELECT region, hour, {O.R('avg(energy_price)')} AS avg_price
FROM r WHERE energy_price IS NOT NULL GROUP BY region, hour""")
def regional_price_by_hour(spark, sf_dir):
    """A8 per region."""
    from . import panels
    return panels.price_by_hour(regional_snapshot_plan(spark, sf_dir))
