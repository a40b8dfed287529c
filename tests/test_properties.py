"""Randomised checks of keep-last and pivot against a brute force in
plain Python (hypothesis draws small frames with duplicates and NULLs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from voltaic.operators.dedupe import keep_last
from voltaic.operators.pivot import pivot_measure

FUELS = ["A", "B", "C"]

rows_strategy = st.lists(
    st.tuples(st.integers(0, 3),                       # key
              st.sampled_from(FUELS),                  # category
              st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),  # value
              st.integers(0, 1000)),                   # publication order
    min_size=0, max_size=40, unique_by=lambda r: r[3])  # the order is total

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=rows_strategy)
def test_keep_last_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, c string, v double, seq int")
    got = sorted(tuple(r) for r in keep_last(df, ["k"], ["seq"]).collect())
    best = {}
    for k, c, v, seq in rows:
        if k not in best or seq > best[k][3]:
            best[k] = (k, c, v, seq)
    assert got == sorted(best.values())


@SETTINGS
@given(rows=rows_strategy)
def test_pivot_latest_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, c string, v double, seq int")
    got = {r.k: (r.A, r.B, r.C) for r in
           pivot_measure(keep_last(df, ["k", "c"], ["seq"]), ["k"], "c", "v", FUELS).collect()}
    latest = {}
    for k, c, v, seq in rows:
        if (k, c) not in latest or seq > latest[(k, c)][1]:
            latest[(k, c)] = (v, seq)
    want = {k: tuple(latest.get((k, f), (None, 0))[0] for f in FUELS)
            for k in {r[0] for r in rows}}
    assert got == want
