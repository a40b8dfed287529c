"""Boundary tests of every classification, rounding and calendar rules."""

import datetime as dt

import pytest

from voltaic import config
from voltaic.functions import (classify_by, hour_ending_ts, pct, round_half_up,
                               with_time_features)

CASES = [
    (config.DEMAND_CLASSES, [(14999, "Low"), (15000, "Medium"), (19999.5, "Medium"),
                             (20000, "High"), (24999, "High"), (25000, "Extreme"),
                             (None, "Extreme")]),
    (config.PRICE_CLASSES, [(-0.01, "Negative"), (0, "Low"), (19.99, "Low"), (20, "Medium"),
                            (49.99, "Medium"), (50, "High"), (99.99, "High"), (100, "Spike"),
                            (None, "Spike")]),
    (config.TEMPERATURE_CLASSES, [(-10.01, "Extreme Cold"), (-10, "Cold"), (-0.01, "Cold"),
                                  (0, "Mild"), (14.99, "Mild"), (15, "Warm"), (24.99, "Warm"),
                                  (25, "Hot"), (34.99, "Hot"), (35, "Extreme Heat"),
                                  (None, "Extreme Heat")]),
    (config.HVAC_MODES, [(17.99, "Heating"), (18, "Neutral"), (22, "Neutral"),
                         (22.01, "Cooling"), (None, "Neutral")]),
    (config.FLOW_DIRECTIONS, [(0.01, "Import"), (0, "Balanced"), (-0.01, "Export"),
                              (None, "Balanced")]),
    (config.CARBON_CLASSES, [(49.99, "Very Clean"), (50, "Clean"), (99.99, "Clean"),
                             (100, "Moderate"), (199.99, "Moderate"), (200, "Dirty"),
                             (None, "Dirty")]),
    (config.PRICE_REGIMES, [(100, "Normal"), (100.01, "Spike"), (0, "Normal"),
                            (-0.01, "Negative"), (None, "Normal")]),
]


@pytest.mark.parametrize("spec,cases", CASES)
def test_classify_boundaries(spark, spec, cases):
    df = spark.createDataFrame([(None if v is None else float(v),) for v, _ in cases], "v double")
    got = [r[0] for r in df.select(classify_by("v", spec)).collect()]
    assert got == [label for _, label in cases]


def test_round_half_up_is_decimal(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (None,)], "v double")
    got = [r[0] for r in df.select(round_half_up("v", 2)).collect()]
    assert got == [1.01, 2.68, -1.01, None]


def test_pct_zero_whole_is_null(spark):
    df = spark.createDataFrame([(1.0, 3.0), (0.0, 0.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(pct("a", "b")).collect()]
    assert got == [33.33, None, None]


def test_hour_ending_timestamp(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 1), 24), (dt.date(2026, 1, 1), 1)],
                               "date date, hour int")
    got = [r[0] for r in df.select(hour_ending_ts("date", "hour")).collect()]
    assert got == [dt.datetime(2026, 1, 2, 0, 0), dt.datetime(2026, 1, 1, 1, 0)]


def test_time_features(spark):
    rows = [(dt.date(2026, 3, 1), 7), (dt.date(2026, 3, 2), 20), (dt.date(2026, 12, 5), 19),
            (dt.date(2026, 9, 30), 6)]
    df = with_time_features(spark.createDataFrame(rows, "date date, hour int"))
    got = [(r.day_of_week, r.day_name, r.is_weekday, r.season, r.is_peak_hour, r.year, r.month)
           for r in df.collect()]
    assert got == [(1, "Sunday", False, "Spring", True, 2026, 3),
                   (2, "Monday", True, "Spring", False, 2026, 3),
                   (7, "Saturday", False, "Winter", True, 2026, 12),
                   (4, "Wednesday", True, "Fall", False, 2026, 9)]
