"""Real-time totals: hourly roll-up (K2) in batch and streaming form, and
incremental intake of report files (K1).

Intake is one query that parses each file once and writes good rows and
rejects in one idempotent write per micro-batch.  What follows streams from
that table: the last publication of each interval, and the hourly roll-up of
those.  Batch and streaming forms share the parser and the aggregate
expressions; the stream adds event time, a watermark and tumbling windows, so
state is bounded and late rows are dropped.
"""

from __future__ import annotations

import re
from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from .. import config
from ..functions import pct, round_half_up
from ..sources.lake import exists
from ..sources.reports import parse_realtime_text

INTERVAL_KEYS = ("date", "hour", "interval")
INTERVAL_LENGTH = "5 minutes"


RESERVES = {"total_10s": "reserve_10s_mw", "total_10n": "reserve_10n_mw", "total_30r": "reserve_30r_mw"}


def _measures(columns: Sequence[str]) -> list[Column]:
    mean = lambda c: round_half_up(F.avg(c), 2) if c in columns else F.lit(None).cast("double")
    return [
        mean("total_energy").alias("energy_mw"),
        mean("total_loss").alias("loss_mw"),
        mean("total_load").alias("load_mw"),
        pct(F.sum("total_loss"), F.sum("total_energy")).alias("loss_pct"),
        *[mean(c).alias(name) for c, name in RESERVES.items()],
        F.count(F.lit(1)).alias("intervals"),
    ]


def hourly_totals(realtime: DataFrame) -> DataFrame:
    """5-minute totals to hourly mean energy, loss, load and reserves, loss
    percent (of the hour's sums) and the number of intervals (batch form),
    per region where there is one.  A measure that the report lacks is NULL."""
    return realtime.groupBy(*config.series_of(realtime), "date", "hour").agg(*_measures(realtime.columns))


def snapshot_side(hourly: DataFrame) -> DataFrame:
    """Hourly totals as the snapshot's fourth side: loss and reserves."""
    return hourly.select(*config.series_of(hourly), "date", "hour", F.col("loss_mw").alias("total_loss_mw"), *RESERVES.values())


def interval_start(date: str = "date", hour: str = "hour", interval: str = "interval") -> Column:
    """Event time of a 5-minute interval: hour-ending ``hour`` starts at
    ``hour - 1``; interval n (1-12) starts (n - 1) * 5 minutes later.

    The market clock is read as if it were UTC (watermarks need an instant),
    and ``market_hour`` reads it back the same way, so clock changes of the
    session's zone shift nothing."""
    minutes = (F.col(hour) - 1) * 60 + (F.col(interval) - 1) * 5
    return F.timestamp_seconds(F.unix_date(date).cast("bigint") * 86400 + minutes.cast("bigint") * 60)


def market_hour(ts: Column) -> tuple[Column, Column]:
    """Date and hour-ending hour of an event time made by ``interval_start``."""
    seconds = F.unix_seconds(ts)
    return (F.date_from_unix_date(F.floor(seconds / 86400).cast("int")),
            (F.floor(F.pmod(seconds, F.lit(86400)) / 3600) + 1).cast("int"))


def _texts(reader: DataFrameReader | DataStreamReader, paths: str | list[str]) -> DataFrame:
    text = reader.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(paths)
    return text.select("value", F.col("_metadata.file_path").alias("_published_at"), F.col("_metadata.file_modification_time").alias("landed"))


def _path(name: str) -> str:
    """The path to load for the name that a row's metadata give a file."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(name))


def write_batch(rows: DataFrame, batch_id: int | str, table: str) -> bool:
    """One micro-batch of parsed rows into its own folder of ``table``, good
    rows and rejects in one write; whether it was written.  A batch that is
    replayed after it was written changes nothing; one that stopped half-way
    is written anew, over what it left."""
    folder = f"{table}/batch={batch_id}"
    if exists(rows.sparkSession, f"{folder}/_SUCCESS"):
        return False
    rows.withColumn("status", F.coalesce("status", F.lit("ok"))).write.mode("overwrite").partitionBy("status").parquet(folder)
    return True


def start_intake(spark: SparkSession, folder: str, table: str, checkpoint: str, max_files: int | None = None,
                 series: Sequence[str] = (), available_now: bool = True) -> StreamingQuery:
    """K1: every report file that lands in ``folder`` is read and parsed once;
    its rows go to ``table``, rejects with their reason beside the good ones.
    ``series`` names the key columns that the reports carry (the region).

    With ``max_files`` the new files are written so many at a time, in the
    order in which they landed, and by name if they landed at one time: the
    file source lists those in any order, and what follows would take the
    earlier publication for late.  Their names cost one more read of each."""
    def land(text: DataFrame, batch: int) -> None:
        parse = lambda df: parse_realtime_text(df.drop("landed"), series=series).withColumnRenamed("_reason", "status")
        if not max_files:
            write_batch(parse(text), batch, table)
            return
        files = text.select("landed", "_published_at").distinct().orderBy("landed", "_published_at").collect()
        names = [f["_published_at"] for f in files]
        for n, at in enumerate(range(0, len(names), max_files)):
            part = _texts(text.sparkSession.read, [_path(f) for f in names[at : at + max_files]])
            write_batch(parse(part), f"{batch}_{n:05d}", table)

    writer = _texts(spark.readStream, folder).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _schema(spark: SparkSession, series: Sequence[str]) -> T.StructType:
    """The columns of an intake table, without those in its folder names."""
    none = spark.createDataFrame([], "value string, _published_at string")
    return parse_realtime_text(none, series=series).drop("_reason").schema


def accepted(spark: SparkSession, table: str) -> DataFrame:
    """Good rows of an intake table, every publication of an interval."""
    return spark.read.parquet(table).filter(F.col("status") == "ok").drop("status", "batch")


def rejected(spark: SparkSession, table: str) -> DataFrame:
    """Rejects of an intake table, with their reason in ``status``."""
    return spark.read.parquet(table).filter(F.col("status") != "ok")


def realtime_stream(spark: SparkSession, table: str, series: Sequence[str] = (), max_files: int | None = None) -> DataFrame:
    """Good rows of an intake table as a stream, with event time ``ts``; they
    are parsed already."""
    reader = spark.readStream.schema(_schema(spark, series)).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{table}/batch=*/status=ok").withColumn("ts", interval_start())


def last_publications(rows: DataFrame, delay: str = "1 day") -> DataFrame:
    """K1: the last publication of each interval (region, date, hour,
    interval), by file and line as in a batch.

    State holds one row per open interval.  An interval is emitted once, when
    the watermark has passed it by ``delay``; until then a restatement takes
    the place of what was there, and later ones are dropped."""
    keys = [*config.series_of(rows), *INTERVAL_KEYS]
    order = F.struct("_published_at", "_line_no")
    rest = [c for c in rows.columns if c not in (*keys, "ts", "_published_at", "_line_no")]
    best = (rows.withWatermark("ts", delay).groupBy(F.window("ts", INTERVAL_LENGTH).alias("w"), *keys)
            .agg(F.max_by(F.struct(*rest), order).alias("last")))
    return best.select(*keys, "last.*", F.window_time("w").alias("ts"))


def hourly_stream(rows: DataFrame, delay: str | None = "3 hours") -> DataFrame:
    """K2: tumbling one-hour windows on event time, per region where there is
    one.  In append mode an hour is emitted once the watermark passes its end;
    rows later than the watermark are dropped.  ``delay=None`` keeps the
    watermark already set upstream (by ``last_publications``); a stream has
    one watermark."""
    w = F.window("ts", "1 hour")
    if delay is not None:
        rows = rows.withWatermark("ts", delay)
    series = config.series_of(rows)
    agg = rows.groupBy(w.alias("w"), *series).agg(*_measures(rows.columns))
    date, hour = market_hour(F.col("w.start"))
    return agg.select(*series, date.alias("date"), hour.alias("hour"),
                      "energy_mw", "loss_mw", "load_mw", "loss_pct", *RESERVES.values(), "intervals")


def start_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                   fmt: str = "parquet", available_now: bool = True) -> StreamingQuery:
    """Run a stream into a file table with a checkpoint on shared storage;
    ``availableNow`` processes what has landed and stops."""
    writer = (df.writeStream.format(fmt).outputMode(mode)
              .option("checkpointLocation", checkpoint).option("path", path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
