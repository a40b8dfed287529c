"""Dimensions, the report cache and the gold layer on the driver's tables."""

import datetime as dt

from conftest import SF001
from voltaic.plans import catalog
from voltaic.plans import gold as G
from voltaic.plans.panels import ReportCache


def test_dim_hour(spark):
    rows = G.dim_hour(spark, peak_classes=[(">=", 7, "On-Peak")], default_class="Off-Peak") \
        .orderBy("hour_key").collect()
    assert len(rows) == 24 and rows[0].hour_label == "01:00" and rows[23].hour_label == "24:00"
    assert [r.is_peak for r in rows].count(True) == 13
    assert rows[6].peak_class == "On-Peak" and rows[0].peak_class == "Off-Peak"


def test_seed_dimensions(spark):
    fuel = {r.fuel_type: r for r in G.dim_fuel_type(spark).collect()}
    assert len(fuel) == 6 and fuel["Gas"].carbon_factor_gco2_kwh == 490
    assert fuel["Hydro"].is_renewable and not fuel["Nuclear"].is_renewable
    assert G.dim_zone(spark).count() == 10
    own = spark.createDataFrame([("Gas", 500), ("Coal", 900)], "fuel_type string, carbon_factor_gco2_kwh int")
    factors = G.carbon_factors(own)
    assert tuple(spark.range(1).select(factors["Gas"], factors["Other"], factors["Hydro"]).first()) == (500, 0, 0)


def test_dim_date_with_holidays(spark):
    demand = spark.createDataFrame([(dt.date(2026, 12, 24),), (dt.date(2026, 12, 27),)],
                                   "date date")
    hol = spark.createDataFrame([(dt.date(2026, 12, 25),)], "date date")
    rows = G.dim_date(demand, hol).orderBy("date").collect()
    assert [r.is_holiday for r in rows] == [False, True, False, False]
    assert rows[1].week_of_year == 52 and rows[1].quarter == 4
    assert rows[1].month_name == "December" and rows[1].season == "Winter"


def test_gold_tables_and_counts(spark):
    tables = catalog.gold_tables(spark, SF001)
    counts = {r.table_name: r.rows for r in catalog.QUERIES["table_counts"](spark, SF001).collect()}
    assert counts["fct_hourly_grid_snapshot"] == counts["mart_carbon_intensity"]
    assert set(tables) == {*counts, "dim_fuel_type"}


def test_report_cache_ttl(spark):
    now = [0.0]
    cache = ReportCache(spark, {"t": spark.range(5)}, ttl=300, clock=lambda: now[0])
    a = cache.query("SELECT count(*) AS n FROM t")
    assert cache.query("SELECT count(*) AS n FROM t") is a
    now[0] = 301.0
    b = cache.query("SELECT count(*) AS n FROM t")
    assert b is not a and b.collect()[0].n == 5
    cache.query("SELECT max(id) AS m FROM t")
    now[0] = 602.0
    cache.query("SELECT min(id) AS m FROM t")
    assert len(cache._entries) == 1          # entries nobody asked for again are freed too
    cache.clear()


def test_named_views_registered(spark):
    from voltaic.plans import serving
    from voltaic.plans import silver as S
    from voltaic.sources import bindings as B
    names = serving.register_views(catalog.snapshot(spark, SF001),
                                   S.dayahead(B.dayahead_feed(spark, SF001)))
    assert set(names) == set(serving.VIEW_NAMES)
    assert spark.sql("SELECT count(*) AS n FROM v_latest_grid_status").collect()[0].n == 1
    assert spark.table("v_carbon_by_hour").count() <= 24


def test_a_new_catalog_sees_new_files(spark, tmp_path):
    import shutil
    for t in ("orders", "events", "customer", "part"):
        (tmp_path / f"{t}.parquet").mkdir()
        shutil.copy(f"{SF001}/{t}.parquet", tmp_path / f"{t}.parquet" / "a.parquet")
    peak = lambda c: c.query("demand_class").agg({"market_demand": "max"}).first()[0]
    before = peak(catalog.Catalog(spark, str(tmp_path)))
    more = spark.read.parquet(f"{SF001}/orders.parquet").limit(1).selectExpr(
        "* except (o_orderkey, o_totalprice)", "7000000L AS o_orderkey", "15000000D AS o_totalprice")
    more.write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    assert before < 1_000_000 == peak(catalog.Catalog(spark, str(tmp_path)))
