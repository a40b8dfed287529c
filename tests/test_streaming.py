"""K1 and K2 with Trigger.AvailableNow on files dropped into a folder
(FIXTURES.md part 3, item 7)."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import write
from voltaic.plans import silver as S
from voltaic.sources import reports as R
from voltaic.streaming import realtime as RT

HEAD = ("\\WRITTEN SOMETIME FOR 2031/02/03\n"
        "HOUR,INTERVAL,TOTAL ENERGY,TOTAL LOSS,TOTAL LOAD\n")


def _files(folder, far_hour=None):
    write(f"{folder}/in/rt_1.csv", HEAD + "13,1,100,2,98\n13,2,110,2,108\n")
    write(f"{folder}/in/rt_2.csv", HEAD + "13,3,120,3,117\n14,1,90,1,89\n")
    last = "14,2,95,1,94\n13,1,100,2,98\n"              # repeats a row of file 1
    if far_hour:
        last += f"{far_hour},1,50,1,49\n"
    write(f"{folder}/in/rt_3.csv", HEAD + last)


def _intake(spark, folder, **how):
    q = RT.start_intake(spark, f"{folder}/in", f"{folder}/rows", f"{folder}/ckpt-in", **how)
    q.awaitTermination()


def _follow(spark, folder, name, build, series=()):
    """Run a stream over the intake table, one file at a time, to its end."""
    rows = RT.realtime_stream(spark, f"{folder}/rows", series, max_files=1)
    RT.start_to_table(build(rows), f"{folder}/{name}", f"{folder}/ckpt-{name}").awaitTermination()
    return spark.read.parquet(f"{folder}/{name}")


def test_the_last_publication_wins_in_stream_and_batch(spark):
    folder = tempfile.mkdtemp(prefix="voltaic-k1-")
    _files(folder)
    write(f"{folder}/in/rt_4.csv", HEAD + "13,2,150,2,148\n")                 # restates an interval
    _intake(spark, folder, max_files=1)
    key = ["date", "hour", "interval", "total_energy", "net_load", "loss_pct"]
    batch = S.realtime(R.read_realtime_report(spark, f"{folder}/in"))
    assert {(r.hour, r.interval): r.total_energy for r in batch.collect()}[13, 2] == 150.0
    write(f"{folder}/in/rt_5.csv", HEAD.replace("2031/02/03", "2031/02/05") + "1,1,70,1,69\n")   # moves the watermark on
    _intake(spark, folder, max_files=1)
    out = _follow(spark, folder, "last", lambda rows: RT.last_publications(rows, "1 hour").drop("ts"))
    assert sorted(S.realtime(out).select(*key).collect()) == sorted(batch.select(*key).collect())   # the open interval is not there
    write(f"{folder}/in/rt_6.csv", HEAD + "13,2,999,2,997\n")                 # too late: the interval is closed
    write(f"{folder}/in/rt_7.csv", HEAD.replace("2031/02/03", "2031/02/06") + "1,1,70,1,69\n")
    _intake(spark, folder, max_files=1)
    out = _follow(spark, folder, "last", lambda rows: RT.last_publications(rows, "1 hour").drop("ts"))
    got = {(r.date.day, r.hour, r.interval): r.total_energy for r in out.collect()}
    assert len(got) == out.count() == 6 and got[3, 13, 2] == 150.0 and got[5, 1, 1] == 70.0


def test_regions_stay_apart_in_the_stream(spark):
    folder = tempfile.mkdtemp(prefix="voltaic-k1reg-")
    head = HEAD.replace("TOTAL LOAD", "TOTAL LOAD,REGION")
    write(f"{folder}/in/rt_1.csv", head + "13,1,100,2,98,A\n13,1,200,2,198,B\n13,2,110,2,108,A\n13,2,110,2,108,\n")
    write(f"{folder}/in/rt_2.csv", head + "13,1,150,2,148,A\n20,1,1,1,1,A\n")
    _intake(spark, folder, max_files=1, series=["region"])
    assert [(r.status, r.hour) for r in RT.rejected(spark, f"{folder}/rows").collect()] == [("no region", 13)]
    build = lambda rows: RT.hourly_stream(RT.last_publications(rows, "1 hour"), delay=None)
    out = {(r.region, r.hour): (r.energy_mw, r.intervals) for r in _follow(spark, folder, "hours", build, ["region"]).collect()}
    assert out == {("A", 13): (130.0, 2), ("B", 13): (200.0, 1)}


def test_hourly_stream_emits_closed_hours_only(spark):
    folder = tempfile.mkdtemp(prefix="voltaic-k2-")
    _files(folder, far_hour=20)
    _intake(spark, folder, max_files=1)
    out = {r.hour: r for r in _follow(spark, folder, "out", lambda rows: RT.hourly_stream(RT.last_publications(rows, "3 hours"), delay=None)).collect()}
    assert 20 not in out                                   # its window is still open
    batch = RT.hourly_totals(S.realtime(R.read_realtime_report(spark, f"{folder}/in")).filter(F.col("hour") < 20))
    expect = {r.hour: r for r in batch.collect()}
    assert set(out) == set(expect) == {13, 14}
    for h in (13, 14):
        assert out[h].energy_mw == expect[h].energy_mw
        assert out[h].intervals == expect[h].intervals


def test_files_that_landed_at_one_time_go_by_name(spark):
    folder = tempfile.mkdtemp(prefix="voltaic-k1t-")
    names = [write(f"{folder}/in/rt_{i:02d}.csv", "") for i in range(16)]
    listed = [f"{folder}/in/{f}" for f in os.listdir(f"{folder}/in")]
    late = max(names, key=lambda f: names.index(f) - listed.index(f))       # listed before files of earlier names
    for i, f in enumerate(names[: names.index(late)]):
        write(f, HEAD + f"13,{i + 1},100,2,98\n" if i < 12 else HEAD)
    for f in names[names.index(late) + 1 :]:
        os.remove(f)
    write(late, HEAD + "20,1,50,1,49\n")
    for f in names[: names.index(late) + 1]:
        os.utime(f, (1_900_000_000, 1_900_000_000))
    _intake(spark, folder, max_files=1)
    out = _follow(spark, folder, "out", lambda rows: RT.hourly_stream(RT.last_publications(rows, "1 hour"), delay=None)).collect()
    assert [(r.hour, r.intervals) for r in out] == [(13, min(12, names.index(late)))]


def test_intake_writes_so_many_files_at_a_time(spark):
    folder = tempfile.mkdtemp(prefix="voltaic-k1m-")
    order = ["e", "b", "d", "a c", "x/c%20[1]{é}"]
    for i, name in enumerate(order):
        f = write(f"{folder}/in/{name}.csv", HEAD + f"13,{i + 1},100,2,98\n" + "x,1,1,1,1\n")
        os.utime(f, (1_900_000_000 + i // 2, 1_900_000_000 + i // 2))
    _intake(spark, folder, max_files=2)
    _intake(spark, folder, max_files=2)
    got = {}
    for r in spark.read.parquet(f"{folder}/rows").filter("status = 'ok'").collect():
        got.setdefault(r.batch, []).append(r.interval)
    assert [sorted(got[b]) for b in sorted(got)] == [[1, 2], [3, 4], [5]]
    assert RT.rejected(spark, f"{folder}/rows").count() == 5
    whole = {r._published_at for r in R.read_realtime_report(spark, f"{folder}/in").collect()}
    assert {r._published_at for r in RT.accepted(spark, f"{folder}/rows").collect()} == whole


def test_rejects_go_beside_the_good_rows(spark):
    folder = tempfile.mkdtemp(prefix="voltaic-k1r-")
    _files(folder)
    write(f"{folder}/in/rt_4.csv", "HOUR,INTERVAL,TOTAL ENERGY,TOTAL LOSS,TOTAL LOAD\n15,1,80,1,79\n")
    write(f"{folder}/in/rt_5.csv", HEAD + "x,1,80,1,79\n")
    _intake(spark, folder)
    assert RT.accepted(spark, f"{folder}/rows").count() == 6
    assert sorted((r.status, r.hour, r.total_energy) for r in RT.rejected(spark, f"{folder}/rows").collect()) == [("bad date", 15, 80.0), ("bad hour", None, 80.0)]


def test_a_replayed_batch_writes_nothing_twice(spark):
    folder = tempfile.mkdtemp(prefix="voltaic-k1b-")
    rows = spark.createDataFrame([(1, None), (2, "bad date")], "hour int, status string")
    assert RT.write_batch(rows, 7, f"{folder}/t")
    assert not RT.write_batch(rows, 7, f"{folder}/t")
    assert not RT.write_batch(rows.union(rows), 7, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 2
    os.remove(f"{folder}/t/batch=7/_SUCCESS")               # the writer stopped half-way
    assert RT.write_batch(rows, 7, f"{folder}/t") and RT.write_batch(rows, 8, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 4


def test_event_time_ignores_clock_changes(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        rows = spark.createDataFrame([("2026-03-08", h, 1) for h in range(1, 25)], "d string, hour int, interval int")
        rows = rows.selectExpr("cast(d as date) AS date", "hour", "interval").withColumn("ts", RT.interval_start())
        date, hour = RT.market_hour(F.col("ts"))
        got = rows.select(F.col("date") == date, hour).collect()
        assert [tuple(r) for r in got] == [(True, h) for h in range(1, 25)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_batch_keeps_the_last_publication_of_an_interval(spark):
    folder = tempfile.mkdtemp(prefix="voltaic-k2b-")
    _files(folder)
    write(f"{folder}/in/rt_9.csv", HEAD + "13,1,104,2,102\n")
    out = {r.hour: r for r in RT.hourly_totals(S.realtime(R.read_realtime_report(spark, f"{folder}/in"))).collect()}
    assert out[13].intervals == 3 and out[13].energy_mw == round((104 + 110 + 120) / 3, 2)
    assert out[13].reserve_10s_mw is None
