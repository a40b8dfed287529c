"""Whole runs on hand-made reports: regions, rejects, increments, safe
replacement, and the plans of landed tables."""

import datetime as dt
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from conftest import write
from voltaic.operators.dedupe import keep_last, pack_order
from voltaic.plans import silver as S
from voltaic.plans.runner import LayerConfig, Run, _fact, run_layers
from voltaic.sources import lake, probe, reports as R

HEADER = "Date,Hour,Market Demand,Ontario Demand"


def fresh(name):
    return tempfile.mkdtemp(prefix=f"voltaic-{name}-")


def days(first, n):
    return [(dt.date.fromisoformat(first) + dt.timedelta(i)).isoformat() for i in range(n)]


def hours(region, which, bump, hour=(1, 2)):
    """The six reports and day-ahead prices of some days, of one region or, by
    name, of several (``region``: name -> bump)."""
    names = region if isinstance(region, dict) else {region: bump}
    own = isinstance(region, dict)
    col = lambda r: f",{r}" if own else ""
    head = ",Region" if own else ""
    tag = lambda r: f"<Region>{r}</Region>" if own else ""
    rows = [(r, b, d, h) for r, b in names.items() for d in which for h in hour]
    gen = "".join(
        f"<DailyData>{tag(r)}<Day>{d}</Day>" + "".join(
            f"<HourlyData><Hour>{h}</Hour><FuelTotal><Fuel>NUCLEAR</Fuel><EnergyValue><Output>{7000 + b + h}</Output></EnergyValue></FuelTotal>"
            f"<FuelTotal><Fuel>WIND</Fuel><EnergyValue><Output>{300 + b}</Output></EnergyValue></FuelTotal></HourlyData>" for h in hour) + "</DailyData>"
        for r, b in names.items() for d in which)
    ties = "".join(
        f"<IMODocBody><Date>{d}</Date>" + "".join(
            f"<IntertieZone>{tag(r)}<IntertieZoneName>NORTH</IntertieZoneName><Schedules>" + "".join(f"<Schedule><Hour>{h}</Hour><Import>{10 + b}</Import><Export>1</Export></Schedule>" for h in hour)
            + "</Schedules></IntertieZone>" for r, b in names.items()) + "</IMODocBody>" for d in which)
    weather = "[" + ",".join(
        "{" + (f'"region": "{r}", ' if own else "") + '"hourly": {"time": [' + ",".join(f'"{d}T{h - 1:02d}:00"' for d in which for h in hour)
        + '], "temperature_2m": [' + ",".join(str(b / 100 + h) for _ in which for h in hour) + '], "relative_humidity_2m": [' + ",".join("50" for _ in which for _ in hour)
        + '], "wind_speed_10m": [' + ",".join("9" for _ in which for _ in hour) + "]}}" for r, b in names.items()) + "]"
    realtime = {d: f"\\TOTALS FOR {d.replace('-', '/')}\nHOUR,INTERVAL,TOTAL ENERGY,TOTAL LOSS,TOTAL LOAD{head.upper()}\n"
                + "".join(f"{h},1,{100 + b},2,{98 + b}{col(r)}\n" for r, b, e, h in rows if e == d) for d in which}
    return {
        "demand": f"\\banner\n{HEADER}{head}\n" + "".join(f"{d},{h},{16000 + b},{15000 + b + h}{col(r)}\n" for r, b, d, h in rows),
        "prices": f"Date,Hour,HOEP{head}\n" + "".join(f"{d},{h},{20 + b / 10}{col(r)}\n" for r, b, d, h in rows),
        "dayahead": f"Date,Hour,DA Price{head}\n" + "".join(f"{d},{h},{21 + b / 10}{col(r)}\n" for r, b, d, h in rows),
        "generation": f'<Document xmlns="http://example.org/s"><DocBody>{gen}</DocBody></Document>',
        "intertie": f'<Doc xmlns="http://example.org/i">{ties}</Doc>',
        "weather": weather, "realtime": realtime}


def land(folder, made, name):
    """Write the reports of ``hours`` and return the folder of each source."""
    ends = {"generation": "xml", "intertie": "xml", "weather": "json"}
    for source, text in made.items():
        for part, body in (text.items() if isinstance(text, dict) else [("all", text)]):
            write(f"{folder}/{source}/{name[source] if isinstance(name, dict) else name}_{part}.{ends.get(source, 'csv')}", body)
    return {source: [f"{folder}/{source}"] for source in made}


def tables(spark, root):
    found = {}
    for layer in ("silver", "gold", "serving"):
        for name in sorted(os.listdir(f"{root}/{layer}")):
            df = spark.read.parquet(f"{root}/{layer}/{name}")
            cols = sorted(c for c in df.columns if c != "loaded_at")
            found[layer, name] = sorted(map(repr, df.select(*cols).collect()))
    return found


def no_errors(summary):
    rows = summary.collect()
    assert all(r.error is None for r in rows), [r for r in rows if r.error]
    return {(r.layer, r.table_name): r.rows for r in rows}


def regional(spark, root):
    silver = {n: spark.read.parquet(f"{root}/silver/{n}") for n in ("demand", "prices", "generation", "weather", "realtime", "intertie", "dayahead")}
    for name, df in silver.items():
        counts = {tuple(r)[:-1]: r[-1] for r in df.groupBy("region", "date", "hour").count().collect()}
        assert len(counts) == 4 and set(counts.values()) == {1}, (name, counts)
        assert {k[0] for k in counts} == {"A", "B"}, name
    fact = spark.read.parquet(f"{root}/gold/fct_hourly_grid_snapshot").orderBy("region", "hour").collect()
    assert [(r.region, r.hour, r.region_demand, r.nuclear_mw, r.energy_price, r.temperature_c, r.total_loss_mw) for r in fact] == [
        ("A", 1, 15001, 7001.0, 20.0, 1.0, 2.0), ("A", 2, 15002, 7002.0, 20.0, 2.0, 2.0),
        ("B", 1, 15101, 7101.0, 30.0, 2.0, 2.0), ("B", 2, 15102, 7102.0, 30.0, 3.0, 2.0)]
    declared = spark.read.parquet(f"{root}/serving/fct_hourly_grid_snapshot")
    types = dict(declared.dtypes)
    assert {c: types[c] for c in ("market_demand_mw", "pct_wind", "rt_price", "da_price", "price_spread", "temperature_c", "carbon_intensity_gco2", "reserve_10s_mw", "loaded_at")} == {
        "market_demand_mw": "decimal(10,1)", "pct_wind": "decimal(6,4)", "rt_price": "decimal(10,2)", "da_price": "decimal(10,2)", "price_spread": "decimal(10,2)",
        "temperature_c": "decimal(5,1)", "carbon_intensity_gco2": "decimal(8,2)", "reserve_10s_mw": "decimal(10,1)", "loaded_at": "timestamp"}
    row = declared.filter("hour = 1 AND region = 'A'").first()
    assert (str(row.rt_price), str(row.price_spread), str(row.total_loss_mw)) == ("20.00", "1.00", "2.0")
    assert [spark.read.parquet(f"{root}/gold/{d}").count() for d in ("dim_hour", "dim_zone")] == [24, 10]
    spreads = spark.read.parquet(f"{root}/serving/fct_price_spreads").collect()
    assert len(spreads) == 4 and {(str(r.spread), r.is_positive_spread) for r in spreads} == {("1.00", True)}


def test_two_regions_in_one_file(spark):
    root = fresh("regions1")
    landed = land(f"{root}/raw", hours({"A": 0, "B": 100}, ["2031-02-03"], 0), "both")
    no_errors(run_layers(spark, LayerConfig(f"{root}/lake", landed)))
    regional(spark, f"{root}/lake")
    for source, reader in (("demand", R.read_demand_report), ("prices", R.read_price_report), ("weather", R.read_weather_json)):
        out = R.backfill(spark, reader, landed[source]).collect()
        assert [(r.region, r.hour) for r in out] == [(x, h) for x in "AB" for h in (1, 2)]


def test_two_regions_in_two_folders(spark):
    root = fresh("regions2")
    for region, bump in (("A", 0), ("B", 100)):
        land(f"{root}/raw/region={region}", hours(region, ["2031-02-03"], bump), "own")
    landed = {s: [f"{root}/raw/region={r}/{s}" for r in "AB"] for s in hours("A", ["2031-02-03"], 0)}
    no_errors(run_layers(spark, LayerConfig(f"{root}/lake", landed)))
    regional(spark, f"{root}/lake")
    assert [(r.region, r.hour) for r in R.backfill(spark, R.read_demand_report, landed["demand"]).collect()] == [(x, h) for x in "AB" for h in (1, 2)]


def test_a_source_without_the_region_is_an_error(spark):
    root = fresh("regions3")
    made = hours({"A": 0, "B": 100}, ["2031-02-03"], 0)
    landed = land(f"{root}/raw", {"demand": made["demand"], "weather": hours("x", ["2031-02-03"], 0)["weather"]}, "f")
    summary = {(r.layer, r.table_name): r for r in run_layers(spark, LayerConfig(f"{root}/lake", landed)).collect()}
    assert "region" in summary["gold", "weather"].error
    assert summary["gold", "fct_hourly_grid_snapshot"].rows == 4


def test_every_row_is_in_bronze_or_a_reject_with_its_reason(spark):
    root = fresh("rejects")
    good = f"\\banner\n{HEADER}\n2031-02-03,1,1,100\n2031-02-03,x,1,100\nsoon,3,1,100\n2031-02-03,4,1,bad\n2031-02-03,5,1,\n2031-02-03,6,zzz,100\n"
    write(f"{root}/raw/demand/a.csv", good)
    write(f"{root}/raw/demand/b.csv", "\\only\n\\banners\n")
    write(f"{root}/raw/rt/a.csv", "\\T FOR 2031/02/03\nHOUR,INTERVAL,TOTAL ENERGY\n1,1,5\n1,x,5\nx,1,5\n1,2,bad\n1,3,\n")
    write(f"{root}/raw/rt/b.csv", "\\T FOR 2031/02/03\nno header here\n")
    cfg = LayerConfig(f"{root}/lake", {"demand": [f"{root}/raw/demand"], "realtime": [f"{root}/raw/rt"]})
    got = no_errors(run_layers(spark, cfg))
    assert got["bronze", "demand"] == got["silver", "demand"] == 2 and got["rejects", "demand"] == 4
    assert {k[1]: n for k, n in got.items() if k[0] == "rejects" and "/" in k[1]} == {
        "demand/bad date": 1, "demand/bad hour": 1, "demand/bad measure": 1, "demand/no measure": 1,
        "realtime/no header": 1, "realtime/bad hour": 1, "realtime/bad interval": 1, "realtime/bad measure": 1, "realtime/no measure": 1}
    bronze = spark.read.parquet(f"{root}/lake/bronze/demand")
    assert bronze.count() == 6 and {"_loaded_at", "_source", "status"} <= set(bronze.columns)
    assert bronze.filter("_source is null or _loaded_at is null").isEmpty()


def test_a_headerless_file_is_rejected_beside_good_ones(spark):
    root = fresh("headless")
    write(f"{root}/d/a.csv", f"{HEADER}\n2031-02-03,1,1,100\n")
    write(f"{root}/d/b.csv", "\n\n\\banner\n")
    write(f"{root}/d/c.csv", "Hour,Date,Ontario Demand\n2,2031-02-03,200\n")
    rows = sorted((r.hour or 0, r.market_demand, r.region_demand, r._reason) for r in R.read_demand_report(spark, f"{root}/d").collect())
    assert rows == [(1, 1, 100, None), (2, None, 200, None)]


def test_the_probe_reads_first_lines_only(spark):
    root = fresh("probe")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem
    read = lambda: sum(s.getBytesRead() for s in fs.getAllStatistics())

    def cost(rows):
        path = write(f"{root}/{rows}.csv", f"\\banner\n{HEADER}\n" + "2031-02-03,1,16000,15000\n" * rows)
        before = read()
        assert [tuple(r)[1] for r in probe.heads(spark, path, R._data_line).collect()] == [HEADER]
        return read() - before, os.path.getsize(path)

    short, long = cost(200_000), cost(1_600_000)
    assert long[1] > 7 * short[1]
    assert long[0] < 1.5 * short[0] + (1 << 20) and long[0] < long[1] / 4, (short, long)


def test_landed_bronze_keeps_last_without_a_sort(spark):
    root = fresh("order")
    write(f"{root}/d/demand_2030.csv", f"{HEADER}\n2031-02-03,1,1,100\n2031-02-03,1,1,150\n2031-02-03,2,1,170\n")
    write(f"{root}/d/demand_2031.csv", f"{HEADER}\n2031-02-03,1,1,200\n")
    good, _ = R.split_rejects(R.read_demand_report(spark, f"{root}/d"))
    lake.write_table(good, f"{root}/bronze")
    bronze = lake.read_table(spark, f"{root}/bronze")
    out = S.demand(pack_order(bronze))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning(date") == 1
    assert sorted((r.hour, r.region_demand) for r in out.collect()) == [(1, 200), (2, 170)]
    plain = keep_last(bronze, ["date", "hour"], ["_published_at", "_row_id"], drop_order=True)
    assert sorted((r.hour, r.region_demand) for r in plain.collect()) == [(1, 200), (2, 170)]


def partitions(root):
    """Last change of each month of each table."""
    out = {}
    for layer in ("silver", "gold", "serving"):
        for at, _, names in os.walk(f"{root}/{layer}"):
            if "month=" in at and any(n.endswith(".parquet") for n in names):
                out[os.path.relpath(at, root)] = max(os.stat(f"{at}/{n}").st_mtime_ns for n in names if n.endswith(".parquet"))
    return out


def test_an_incremental_run_rewrites_one_month_and_equals_a_full_run(spark):
    root = fresh("steps")
    first, more = days("2031-01-30", 4) + days("2031-03-10", 2), ["2031-02-10"]
    some = lambda made: {k: made[k] for k in ("demand", "generation")}
    landed = land(f"{root}/raw", some(hours("x", first, 0)), "a")
    step = LayerConfig(f"{root}/lake", landed, incremental=True)
    no_errors(run_layers(spark, step))
    before = partitions(f"{root}/lake")
    time.sleep(1.1)
    got = no_errors(run_layers(spark, step))
    assert all(n == 0 for (layer, _), n in got.items() if layer in ("bronze", "silver")) and partitions(f"{root}/lake") == before
    made = hours("x", more, 50)
    made["demand"] += "2031-02-01,1,16000,17777\nsoon,1,1,1\n"            # restates an hour
    land(f"{root}/raw", some(made), "b")
    got = no_errors(run_layers(spark, step))
    assert got["bronze", "demand"] == 3 and got["rejects", "demand"] == 1
    after = partitions(f"{root}/lake")
    touched = {p for p in after if after[p] != before.get(p)}
    assert {p.split("/", 2)[2] for p in touched if "renewable_penetration" not in p} == {"year=2031/month=2"}
    assert {p.split("/", 2)[2] for p in touched if "renewable_penetration" in p} == {"year=2031/month=2", "year=2031/month=3"}
    no_errors(run_layers(spark, LayerConfig(f"{root}/full", landed)))
    steps, full = tables(spark, f"{root}/lake"), tables(spark, f"{root}/full")
    assert steps.keys() == full.keys()
    for name in full:
        assert steps[name] == full[name], name
    fact = spark.read.parquet(f"{root}/lake/gold/fct_hourly_grid_snapshot")
    assert fact.filter("date = '2031-02-01' AND hour = 1").first().region_demand == 17777


def test_a_source_that_lands_nothing_keeps_its_rows(spark):
    root = fresh("steps2")
    landed = land(f"{root}/raw", {k: v for k, v in hours("x", ["2031-02-03"], 0).items() if k in ("demand", "prices")}, "a")
    no_errors(run_layers(spark, LayerConfig(f"{root}/lake", landed, incremental=True)))
    write(f"{root}/raw/demand/b.csv", f"{HEADER}\n2031-02-03,3,1,111\n")
    got = no_errors(run_layers(spark, LayerConfig(f"{root}/lake", {"demand": landed["demand"]}, incremental=True)))
    assert got["bronze", "demand"] == 1
    fact = spark.read.parquet(f"{root}/lake/gold/fct_hourly_grid_snapshot")
    assert sorted((r.hour, r.energy_price) for r in fact.collect()) == [(1, 20.0), (2, 20.0), (3, None)]
    write(f"{root}/raw/demand/b.csv", f"{HEADER}\n2031-02-03,3,1,112222\n")       # a changed file: read as a whole
    no_errors(run_layers(spark, LayerConfig(f"{root}/lake", {"demand": landed["demand"]}, incremental=True)))
    fact = spark.read.parquet(f"{root}/lake/gold/fct_hourly_grid_snapshot")
    assert sorted((r.hour, r.region_demand) for r in fact.collect()) == [(1, 15001), (2, 15002), (3, 112222)]


def test_a_failed_write_leaves_the_old_table(spark):
    root = fresh("replace")
    lake.write_table(spark.range(5), f"{root}/t")
    broken = spark.range(1000).repartition(8).select(F.when(F.col("id") == 777, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        lake.write_table(broken, f"{root}/t")
    assert lake.read_table(spark, f"{root}/t").count() == 5
    with pytest.raises(ValueError):
        lake.write_counted(spark.range(9), f"{root}/t", check=lambda counts: (_ for _ in ()).throw(ValueError(counts)))
    assert lake.read_table(spark, f"{root}/t").count() == 5
    os.rename(f"{root}/t", f"{root}/t.__old")                     # a run that stopped between the renames
    assert lake.optional(spark, f"{root}/t").count() == 5
    assert lake.write_table(spark.range(7), f"{root}/t") == 7
    assert lake.read_table(spark, f"{root}/t").count() == 7 and os.listdir(root) == ["t"]


def test_bucketed_silver_joins_without_a_shuffle(spark):
    root = fresh("buckets")
    made = hours({"A": 0, "B": 100}, days("2031-01-31", 2), 0)
    kinds = ("demand", "generation", "prices", "weather", "realtime")
    landed = land(f"{root}/raw", {k: made[k] for k in kinds}, "a")
    cfg = LayerConfig(f"{root}/lake", landed, buckets=4, catalog="voltaic_b_", incremental=True)
    no_errors(run_layers(spark, cfg))
    run = Run(spark, cfg)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _fact({n: run.read("silver", n) for n in kinds})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Hourly totals aggregate a column into its keys; they and the joins stay in their buckets.
    assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan, plan
    for name in kinds:
        for month in ("year=2031/month=1", "year=2031/month=2"):
            assert 1 <= len([f for f in os.listdir(f"{root}/lake/silver/{name}/{month}") if f.endswith(".parquet")]) <= 4
    before = spark.read.parquet(f"{root}/lake/gold/fct_hourly_grid_snapshot").count()
    more = hours({"A": 0, "B": 100}, ["2031-02-09"], 0)
    land(f"{root}/raw", {k: more[k] for k in kinds}, "b")
    no_errors(run_layers(spark, cfg))
    fact = spark.read.parquet(f"{root}/lake/gold/fct_hourly_grid_snapshot")
    assert before == 8 and fact.count() == 12 and fact.filter("nuclear_mw IS NULL OR energy_price IS NULL OR total_loss_mw IS NULL").isEmpty()
    assert run.read("silver", "demand").count() == 12
