"""Lake I/O and the layer runner on hand-made reports."""

import tempfile
from collections import Counter

from pyspark.sql import functions as F

from conftest import write
from test_readers import DEMAND, GEN, INTERTIE, PRICE, REALTIME, REALTIME_NODATE, WEATHER
from voltaic.plans import serving
from voltaic.plans.runner import PUBLISHED, LayerConfig, run_layers
from voltaic.sources import lake


def test_write_observes_count_and_optional(spark):
    root = tempfile.mkdtemp(prefix="voltaic-lake-")
    df = spark.range(10).withColumn("_source", F.lit("x"))
    assert lake.write_table(lake.drop_lineage(df), f"{root}/t") == 10
    assert "_source" not in lake.read_table(spark, f"{root}/t").columns
    assert lake.optional(spark, f"{root}/missing") is None


def test_widen_numeric(spark):
    df = spark.createDataFrame([(1, 2, "a", 1.5)], "a int, b long, c string, d double")
    assert [t for _, t in lake.widen_numeric(df).dtypes] == ["double", "double", "string",
                                                             "double"]


def test_ingest_and_seed(spark):
    root = tempfile.mkdtemp(prefix="voltaic-ingest-")
    write(f"{root}/raw/fuel.csv", "fuel_type,fuel_category,is_renewable,carbon_factor_gco2_kwh,"
          "display_color,display_order\nNuclear,Baseload,false,12,#8B5CF6,1\n")
    seed = lake.read_seed(spark, f"{root}/raw/fuel.csv", lake.FUEL_SEED_SCHEMA).collect()[0]
    assert seed.carbon_factor_gco2_kwh == 12 and seed.is_renewable is False
    assert lake.ingest(spark, f"{root}/raw/fuel.csv", f"{root}/bronze/fuel") == 1
    assert lake.ingest(spark, f"{root}/raw/none.csv", f"{root}/bronze/none") is None


def test_publish_to_catalog(spark):
    lake.publish(spark.range(3), "voltaic_publish_test")
    assert spark.table("voltaic_publish_test").count() == 3


def test_run_layers_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="voltaic-run-")
    landed = {
        "demand": [write(f"{root}/raw/demand.csv", DEMAND)],
        "prices": [write(f"{root}/raw/prices.csv", PRICE)],
        "generation": [write(f"{root}/raw/gen.xml", GEN)],
        "intertie": [write(f"{root}/raw/it.xml", INTERTIE)],
        "realtime": [write(f"{root}/raw/rt.csv", REALTIME)],
        "weather": [write(f"{root}/raw/w.json", WEATHER), f"{root}/raw/missing.json"],
    }
    summary = {(r.layer, r.table_name): r for r in
               run_layers(spark, LayerConfig(f"{root}/lake", landed)).collect()}
    assert all(r.error is None for r in summary.values()), summary
    assert summary[("bronze", "demand")].rows == 3
    assert summary[("silver", "demand")].rows == 2
    assert summary[("rejects", "demand")].rows == 0
    assert summary[("gold", "fct_hourly_grid_snapshot")].rows == 2
    snap = spark.read.parquet(f"{root}/lake/gold/fct_hourly_grid_snapshot")
    hour1 = snap.filter("hour = 1").collect()[0]
    assert hour1.nuclear_mw == 7100.0 and hour1.energy_price == 25.5
    assert hour1.carbon_intensity_gco2_kwh is not None
    assert spark.read.parquet(f"{root}/lake/gold/mart_daily_summary").count() == 1


def test_lineage_and_raw_csv(spark):
    root = tempfile.mkdtemp(prefix="voltaic-raw-")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    lake.write_raw(df, f"{root}/raw")
    back = spark.read.csv(f"{root}/raw", header=True)
    tagged = lake.with_lineage(back)
    row = tagged.collect()[0]
    assert row._source.startswith("file:") and row._loaded_at is not None
    assert lake.drop_lineage(lake.with_lineage(df, "api")).columns == ["id", "v"]


def test_dynamic_partition_overwrite(spark):
    root = tempfile.mkdtemp(prefix="voltaic-dyn-")
    first = spark.createDataFrame([(2025, 1), (2026, 2)], "year int, v int")
    lake.write_table(first, f"{root}/t", partition_by=["year"])
    lake.write_table(spark.createDataFrame([(2026, 3)], "year int, v int"), f"{root}/t",
                     partition_by=["year"], dynamic=True)
    got = sorted((r.year, r.v) for r in lake.read_table(spark, f"{root}/t").collect())
    assert got == [(2025, 1), (2026, 3)]


def test_run_layers_isolates_a_failed_source(spark):
    root = tempfile.mkdtemp(prefix="voltaic-run2-")
    landed = {
        "demand": [write(f"{root}/raw/demand.csv", DEMAND)],
        # a price report without the price column breaks its contract
        "prices": [write(f"{root}/raw/prices.csv", "Date,Hour,Other\n2031-02-03,1,3\n")],
    }
    summary = {(r.layer, r.table_name): r for r in
               run_layers(spark, LayerConfig(f"{root}/lake", landed)).collect()}
    assert "ContractError" in summary[("bronze", "prices")].error
    assert summary[("gold", "fct_hourly_grid_snapshot")].rows == 2
    snap = spark.read.parquet(f"{root}/lake/gold/fct_hourly_grid_snapshot")
    assert snap.filter("energy_price IS NOT NULL").count() == 0


def test_a_second_run_takes_nothing_from_the_first(spark):
    root = tempfile.mkdtemp(prefix="voltaic-run3-")
    good = {"demand": [write(f"{root}/raw/demand.csv", DEMAND)], "prices": [write(f"{root}/raw/prices.csv", PRICE)]}
    run_layers(spark, LayerConfig(f"{root}/lake", good)).collect()
    assert spark.read.parquet(f"{root}/lake/gold/fct_hourly_grid_snapshot").filter("energy_price IS NOT NULL").count() == 1
    bad = {**good, "prices": [write(f"{root}/raw/prices2.csv", "Date,Hour,Other\n2031-02-03,1,3\n")]}
    summary = {(r.layer, r.table_name): r for r in run_layers(spark, LayerConfig(f"{root}/lake", bad)).collect()}
    assert "ContractError" in summary[("bronze", "prices")].error and ("silver", "prices") not in summary
    snap = spark.read.parquet(f"{root}/lake/gold/fct_hourly_grid_snapshot")
    assert snap.count() == 2 and snap.filter("energy_price IS NOT NULL").count() == 0


def test_rejects_serving_and_publish(spark):
    root = tempfile.mkdtemp(prefix="voltaic-run4-")
    landed = {
        "demand": [write(f"{root}/raw/demand.csv", DEMAND + "Total,,100,90\n")],
        "generation": [write(f"{root}/raw/gen.xml", GEN)],
        "realtime": [write(f"{root}/raw/rt/a.csv", REALTIME), write(f"{root}/raw/rt/b.csv", REALTIME_NODATE)],
    }
    cfg = LayerConfig(f"{root}/lake", landed, publish={}, publish_prefix="voltaic_run4_")
    summary = {(r.layer, r.table_name): r for r in run_layers(spark, cfg).collect()}
    assert all(r.error is None for r in summary.values()), summary
    assert summary[("rejects", "demand")].rows == 1 and summary[("rejects", "realtime")].rows == 1
    assert summary[("bronze", "demand")].rows == 3
    assert {n for layer, n in summary if layer == "publish"} == set(PUBLISHED)
    assert spark.table("voltaic_run4_mart_daily_summary").count() == 1
    mix = spark.read.parquet(f"{root}/lake/serving/fct_daily_generation_mix")
    types = dict(mix.dtypes)
    assert (types["nuclear_mwh"], types["pct_nuclear"], types["peak_demand_mw"]) == ("decimal(12,1)", "decimal(6,4)", "decimal(10,1)")
    assert {n for layer, n in summary if layer == "serving"} == {*serving.DECLARED, *serving.VIEW_NAMES}
    fact = spark.read.parquet(f"{root}/lake/gold/fct_hourly_grid_snapshot")
    assert "reserve_30r_mw" in fact.columns


def test_few_files_per_month_whatever_the_tasks(spark):
    root = tempfile.mkdtemp(prefix="voltaic-files-")
    days = spark.range(0, 720, 1, 40).selectExpr("date_add(date'2031-01-01', cast(id as int)) AS date", "cast(id % 24 as int) AS hour")
    df = days.selectExpr("*", "year(date) AS year", "month(date) AS month").repartition(40)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert lake.write_table(df, f"{root}/t", partition_by=["year", "month"], sort_by=["date", "hour"]) == 720
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    per_month = Counter(f.rpartition("/")[0] for f in spark.read.parquet(f"{root}/t").inputFiles())
    assert len(per_month) == 24 and max(per_month.values()) <= 2


def test_optional_raises_what_is_not_absence(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="voltaic-broken-")
    write(f"{root}/t/part.parquet", "this is no parquet file")
    with pytest.raises(Exception):
        lake.optional(spark, f"{root}/t").count()
