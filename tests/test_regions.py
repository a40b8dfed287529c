"""Many regions at once: the hourly key becomes (region, date, hour), and
each region's results equal the single-region results."""

from pyspark.sql import functions as F

from conftest import SF001
from voltaic.plans import gold as G, serving, silver as S
from voltaic.sources import bindings as B


def _feeds(spark, region=None, bump=0):
    feeds = {"demand": B.demand_feed(spark, SF001), "generation": B.generation_feed(spark, SF001),
             "prices": B.price_feed(spark, SF001), "weather": B.weather_feed(spark, SF001)}
    if bump:
        feeds["demand"] = feeds["demand"].withColumn("region_demand",
                                                     F.col("region_demand") + bump)
    if region is not None:
        feeds = {k: v.withColumn("region", F.lit(region)) for k, v in feeds.items()}
    return feeds


def _snapshot(feeds):
    return G.hourly_snapshot(S.demand(feeds["demand"]),
                             S.generation(feeds["generation"], features=False),
                             S.prices(feeds["prices"]), S.weather(feeds["weather"]))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_two_regions_match_one_region_each(spark):
    a, b = _feeds(spark, "A"), _feeds(spark, "B", bump=7000)
    both = {k: a[k].unionByName(b[k]) for k in a}
    snap = _snapshot(both)
    single_a, single_b = _snapshot(_feeds(spark)), _snapshot(_feeds(spark, bump=7000))
    cols = single_a.columns
    assert _rows(snap.filter("region = 'A'").select(*cols)) == _rows(single_a)
    assert _rows(snap.filter("region = 'B'").select(*cols)) == _rows(single_b)

    for fn in (G.mart_daily_summary, serving.daily_summary, serving.renewable_penetration,
               serving.carbon_by_hour, serving.daily_generation_mix):
        multi = fn(snap)
        assert "region" in multi.columns, fn.__name__
        one = fn(single_b)
        assert _rows(multi.filter("region = 'B'").select(*one.columns)) == _rows(one), \
            fn.__name__


def test_region_windows_are_partitioned(spark):
    a, b = _feeds(spark, "A"), _feeds(spark, "B")
    snap = _snapshot({k: a[k].unionByName(b[k]) for k in a})
    plan = serving.renewable_penetration(snap)._jdf.queryExecution().executedPlan().toString()
    # the rolling window is partitioned by region (and calendar bucket)
    assert "windowspecdefinition(region" in plan


def test_panels_and_checks_keep_regions_apart(spark):
    from voltaic.operators import quality as Q
    from voltaic.operators.joins import missing_hours
    from voltaic.plans import panels
    a, b = _feeds(spark, "A"), _feeds(spark, "B", bump=7000)
    snap = _snapshot({k: a[k].unionByName(b[k]) for k in a})
    single = _snapshot(_feeds(spark, bump=7000))
    daily, daily_one = G.mart_daily_summary(snap), G.mart_daily_summary(single)
    carbon, carbon_one = G.carbon_mart(snap), G.carbon_mart(single)
    for fn, many, one in [
        (panels.latest_status, snap, single), (panels.recent_demand, snap, single), (panels.recent_generation, snap, single),
        (panels.average_mix, snap, single), (panels.price_kpis, snap, single), (panels.price_by_hour, snap, single),
        (panels.price_series, snap, single), (panels.last_days, daily, daily_one), (panels.carbon_kpis, carbon, carbon_one),
        (panels.carbon_hour_means, carbon, carbon_one), (serving.latest_grid_status, snap, single),
    ]:
        got, want = fn(many), fn(one)
        assert _rows(got.filter("region = 'B'").select(*want.columns)) == _rows(want), fn.__name__
    hours = spark.createDataFrame([("A", 1, h) for h in range(1, 25)] + [("B", 1, 5)], "region string, d int, hour int")
    hours = hours.selectExpr("region", "date'2031-02-03' AS date", "hour", "1 AS region_demand")
    assert {(r.region, r.hour) for r in missing_hours(hours).collect()} == {("B", h) for h in range(1, 25) if h != 5}
    assert Q.quality_demand(hours).first().duplicate_rows == 0
