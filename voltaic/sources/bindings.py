"""Bronze feeds derived from the driver's tables.

The source system lands six operator reports.  For checks at any scale we
derive the same shapes from the driver's deterministic tables, so that
Spark and an independent SQL engine read identical rows and the work
grows with the tables.  Each feed keeps its publication order in
``_published_at`` / ``_row_id`` so the keep-last rule has a named order.

FIXED VALUES of the bindings (day 0 of the grid calendar, the event type
to fuel map, the day spans) are listed together below; the arithmetic of
each measure is in its function.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- FIXED VALUES -----------------------------------------------------------
DAY_ZERO = _dt.date(2024, 1, 1)
EVENT_FUEL = (("click", "Nuclear"), ("view", "Hydro"), ("signup", "Wind"),
              ("purchase", "Solar"), ("error", "Gas"))
DEMAND_DAYS = 40          # orders spread over 40 days
GRID_DAYS = 30            # customers, parts and lineitems over 30 days
RESERVE_EVENTS = (("total_10s", "click"), ("total_10n", "view"), ("total_30r", "signup"))
REGIONS = 3               # regions of the regional feeds
# --- end of fixed values ----------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def grid_day(n: Column) -> Column:
    """Day ``n`` of the grid calendar."""
    return F.date_add(F.lit(DAY_ZERO), n.cast("int"))


def _hour_of(key: str, days: int) -> Column:
    """Hour 1-24 of a key spread over ``days`` days: (key div days) % 24 + 1,
    in integer arithmetic."""
    return F.expr(f"cast(({key} div {days}) % 24 + 1 as int)")


def demand_feed(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """Raw demand report rows: several per hour; the highest order key is
    the last published."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        grid_day(k % DEMAND_DAYS).alias("date"),
        _hour_of("o_orderkey", DEMAND_DAYS).alias("hour"),
        F.floor(F.col("o_totalprice") / 15).alias("market_demand"),
        F.floor(F.col("o_totalprice") / 16).alias("region_demand"),
        k.alias("_row_id"),
        *extra,
    )


def generation_feed(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """Raw generation report rows (long form): one per event; the event
    type names the fuel, the value is the output."""
    e = table(spark, sf_dir, "events")
    fuel = None
    for event, name in EVENT_FUEL:
        test = F.col("event_type") == event
        fuel = F.when(test, F.lit(name)) if fuel is None else fuel.when(test, F.lit(name))
    return e.select(
        F.to_date("ts").alias("date"),
        (F.hour("ts") + 1).alias("hour"),
        fuel.alias("fuel_type"),
        F.col("value").alias("output_mw"),
        F.col("ts").alias("_published_at"),
        F.col("event_id").alias("_row_id"),
        *extra,
    )


def price_feed(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        grid_day(k % GRID_DAYS).alias("date"),
        _hour_of("c_custkey", GRID_DAYS).alias("hour"),
        (F.col("c_acctbal") / 60).alias("energy_price"),
        k.alias("_row_id"),
        *extra,
    )


def weather_feed(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        grid_day(k % GRID_DAYS).alias("date"),
        _hour_of("p_partkey", GRID_DAYS).alias("hour"),
        # exact decimal arithmetic, then double
        (F.col("p_size") * F.lit(Decimal("1.2")) - 22).cast("double").alias("temperature_c"),
        (k % 101).cast("double").alias("humidity_pct"),
        (F.col("p_retailprice") % 60).alias("wind_speed_kmh"),
        k.alias("_row_id"),
        *extra,
    )


def realtime_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-minute totals: energy counts every event but purchases (so an
    interval of purchases only has zero energy); loss is 2% of the error
    events; each reserve is one event type.  Sums are exact in
    decimal(20,4), then doubles."""
    e = table(spark, sf_dir, "events")
    v = F.col("value").cast("decimal(20,4)")
    energy = F.sum(F.when(F.col("event_type") == "purchase", F.lit(0).cast("decimal(20,4)"))
                   .otherwise(v))
    loss = F.lit(0.02).cast("decimal(3,2)") * F.sum(
        F.when(F.col("event_type") == "error", v).otherwise(F.lit(0).cast("decimal(20,4)")))
    agg = (e.groupBy(F.to_date("ts").alias("date"), (F.hour("ts") + 1).alias("hour"),
                     (F.floor(F.minute("ts") / 5) + 1).cast("int").alias("interval"))
           .agg(energy.alias("_e"), loss.alias("_l"),
                *[F.sum(F.when(F.col("event_type") == event, v).otherwise(F.lit(0).cast("decimal(20,4)"))).alias(c)
                  for c, event in RESERVE_EVENTS]))
    return agg.select(
        "date", "hour", "interval",
        F.col("_e").cast("double").alias("total_energy"),
        F.col("_l").cast("double").alias("total_loss"),
        (F.col("_e") - F.col("_l")).cast("double").alias("total_load"),
        *[F.col(c).cast("double").alias(c) for c, _ in RESERVE_EVENTS],
    )


def intertie_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled imports (finished lines) and exports (open lines) per
    hour and zone."""
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity")
    return (li.groupBy(grid_day(F.col("l_orderkey") % GRID_DAYS).alias("date"),
                       ((F.col("l_partkey") % 24) + 1).cast("int").alias("hour"),
                       F.col("l_returnflag").alias("intertie_zone"))
            .agg(F.sum(F.when(F.col("l_linestatus") == "F", q).otherwise(F.lit(0.0)))
                 .alias("schedule_import_mw"),
                 F.sum(F.when(F.col("l_linestatus") == "O", q).otherwise(F.lit(0.0)))
                 .alias("schedule_export_mw")))


def dayahead_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-ahead price per hour (the source system has no feed for it)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(grid_day(F.col("l_orderkey") % GRID_DAYS).alias("date"),
                       ((F.col("l_partkey") % 24) + 1).cast("int").alias("hour"))
            .agg(F.avg(F.col("l_extendedprice") / 1000).alias("da_price")))


FEEDS = {
    "demand": demand_feed,
    "generation": generation_feed,
    "prices": price_feed,
    "weather": weather_feed,
    "realtime": realtime_feed,
    "intertie": intertie_feed,
    "dayahead": dayahead_feed,
}


# The column whose remainder by REGIONS names the region of a row.
REGION_KEYS = {"demand": "o_custkey", "generation": "event_id", "prices": "c_nationkey", "weather": "p_partkey"}


def regional(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A feed with a ``region`` column ('R0', 'R1', ...)."""
    key = F.col(REGION_KEYS[name])
    region = F.concat(F.lit("R"), (key % REGIONS).cast("string")).alias("region")
    return FEEDS[name](spark, sf_dir, region)


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: feed(spark, sf_dir) for name, feed in FEEDS.items()}
