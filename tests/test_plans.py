
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from voltaic.plans import catalog
from voltaic.sources import bindings as B


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def fresh_snapshot(spark):
    """A newly built snapshot plan (the catalog's shared one may have run)."""
    from voltaic.plans import gold as G, silver as S
    return G.hourly_snapshot(S.demand(B.demand_feed(spark, SF001)),
                             S.generation(B.generation_feed(spark, SF001), features=False),
                             S.prices(B.price_feed(spark, SF001)),
                             S.weather(B.weather_feed(spark, SF001)))


def test_snapshot_joins_reuse_partitioning(spark, no_auto_broadcast):
    plan = plan_text(fresh_snapshot(spark))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # one shuffle per source aggregate, and one more for the pivot over the rows
    # that keep-last left per fuel; the three joins on (date, hour) add none
    assert plan.count("Exchange hashpartitioning") == 5
    assert plan.count("SortMergeJoin") == 3


def test_generation_is_aggregated_without_a_sort(spark):
    for name in ("generation_pivot", "generation_factors"):
        plan = plan_text(catalog.QUERIES[name](spark, SF001))
        assert "SortAggregate" not in plan and "Sort [" not in plan, name


def test_no_driver_collect_in_the_library():
    import pathlib
    import re
    root = pathlib.Path(catalog.__file__).parents[1]
    found = [f.name for f in root.rglob("*.py") if "llm" not in f.parts
             for _ in re.findall(r"\.(?:collect|toPandas|take)\(", f.read_text())]
    # the distinct headers of a report; the paths of new files, as any read needs
    # its file list, and the months that they touch
    assert sorted(found) == ["reports.py", "runner.py", "runner.py"]


def test_scans_read_only_needed_columns(spark):
    plan = plan_text(fresh_snapshot(spark))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan


def test_dimension_join_is_broadcast(spark):
    plan = plan_text(catalog.QUERIES["generation_factors"](spark, SF001))
    assert "BroadcastHashJoin" in plan


def test_latest_status_is_bounded_topk(spark):
    plan = plan_text(catalog.QUERIES["latest_status"](spark, SF001))
    assert "TakeOrderedAndProject" in plan


def test_keep_last_aggregates_map_side(spark):
    plan = plan_text(catalog.QUERIES["dedupe_last"](spark, SF001))
    assert "partial_max_by" in plan and "Window" not in plan


def test_shares_sum_to_100(spark):
    df = catalog.QUERIES["generation_shares"](spark, SF001)
    pct_cols = [c for c in df.columns if c.endswith("_pct") and c != "clean_energy_pct"]
    total = sum((F.col(c) for c in pct_cols[1:]), F.col(pct_cols[0]))
    bad = df.filter(F.col("total_generation_mw") > 0).filter(F.abs(total - 100) > 0.005 * 7)
    assert bad.count() == 0


def test_snapshot_rows_equal_demand_keys(spark):
    snap = catalog.snapshot(spark, SF001)
    keys = B.demand_feed(spark, SF001).select("date", "hour").distinct()
    assert snap.count() == keys.count()
    assert snap.select("date", "hour").distinct().count() == snap.count()


def test_missing_hours_of_full_grid_is_empty(spark):
    from voltaic.operators.joins import missing_hours
    from voltaic.operators.spine import date_spine, hour_grid
    grid = hour_grid(date_spine(B.demand_feed(spark, SF001)))
    assert missing_hours(grid).count() == 0
