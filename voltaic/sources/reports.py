"""Readers of the landed operator reports.

All parsing is Spark's own: ``from_csv`` on the lines of delimited reports,
the XML and JSON sources with explicit schemas, and array expressions on a
whole-text read for the free-form real-time report.  Readers run on the
executors, one task per file split; nothing is parsed on the driver.

Each reader tags rows with a publication order: ``_published_at`` is
the file path (yearly files sort by name) and ``_row_id`` the position in
the file, one number, so that the keep-last rule has a named order.

Each row has a ``_reason``, NULL for a good one: what keeps it out of silver
(``no header``, ``bad date``, ``bad hour``, ``no region``, ``bad measure``,
``no measure``).  No row vanishes between a report and the two.

Series columns (``config.SERIES``: the region) come from a column or element of
the report, or else from a ``region=<name>`` folder in the path.  Files that
carry a series anywhere give a frame with that column, which then leads every
key; a row without a value is a reject.
"""

from __future__ import annotations

import csv
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..operators.dedupe import keep_last
from .lake import exists
from .probe import FEW_FILES, heads, path_part, series_in

# --- FIXED VALUES: report formats ---------------------------------------------
BANNER_PREFIX = "\\"                      # banner lines start with a backslash
DEMAND_COLUMNS = {"date": "date", "hour": "hour", "market_demand": "market_demand",
                  "ontario_demand": "region_demand"}
PRICE_COLUMNS = {"date": "date", "hour": "hour", "hoep": "energy_price"}
DAYAHEAD_COLUMNS = {"date": "date", "hour": "hour", "da_price": "da_price"}
REALTIME_HEADER_PREFIX = "HOUR"
REALTIME_DATE_MARK = "FOR"
REALTIME_DATE_FORMAT = "yyyy/MM/dd"
WEATHER_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
# --- end of fixed values --------------------------------------------------------


def canonical_name(name: str) -> str:
    """Trim, lower case, blanks to underscores."""
    return name.strip().lower().replace(" ", "_")


def _position() -> Column:
    """Place of a row in its file as one exact number: the split's start, then
    the row's place in its task (rows of a split are one run there)."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (F.col("_metadata.file_block_start").cast("decimal(14,0)") * F.lit(1 << 33).cast("decimal(10,0)")
            + row.cast("decimal(10,0)")).cast("decimal(24,0)")


def _data_line(lines) -> str | None:
    """The first line that is neither blank nor a banner line."""
    return next((x for x in lines if x.strip() and not x.startswith(BANNER_PREFIX)), None)


def header_names(header: str) -> list[str]:
    """The canonical column names of a header line."""
    return [canonical_name(c.removeprefix("\ufeff")) for c in next(csv.reader([header]))]


def read_banner_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Delimited reports whose leading banner lines start with a
    backslash.  All cells are text; callers conform the types.

    A probe reads the first data line of each file and no more: its header.
    All files are then one scan, and each cell is found by the name that the
    file's own header gives it, so a column that moved stays itself and one
    that a file lacks is NULL there.  The driver sees one row per distinct
    header.  ``_line`` is the text of the row; a file without a header line
    gives rows whose ``_header`` is NULL, and a line like the header none.
    """
    found = heads(spark, paths, _data_line).withColumnsRenamed({"path": "_published_at", "head": "_header"})
    formats = found.groupBy("_header").agg(F.count("*").alias("files")).collect()
    headers = sorted(r["_header"] for r in formats if r["_header"] is not None)
    named = {h: header_names(h) for h in headers}
    columns = list(dict.fromkeys(c for h in headers for c in named[h]))
    lines = spark.read.option("recursiveFileLookup", True).text(paths).select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_published_at"), _position().alias("_row_id"))
    lines = lines.where((F.trim("_line") != "") & ~F.col("_line").startswith(BANNER_PREFIX))
    if len(formats) == 1 and headers:
        lines = lines.withColumn("_header", F.lit(headers[0]))
    else:
        few = sum(r["files"] for r in formats) <= FEW_FILES
        lines = lines.join(F.broadcast(found) if few else found, "_published_at", "left")
    lines = lines.where(F.col("_header").isNull() | (F.col("_line") != F.col("_header")))
    width = max([len(n) for n in named.values()], default=1)
    schema = ", ".join(f"c{i} string" for i in range(width))
    cells = lines.withColumn("_cells", F.from_csv("_line", schema, {"escape": '"'}))

    def cell(name: str) -> Column:
        out = F.lit(None).cast("string")
        for h in headers:
            if name in named[h]:
                out = F.when(F.col("_header") == h, F.col(f"_cells.c{named[h].index(name)}")).otherwise(out)
        return out.alias(name)

    return cells.select(*[cell(c) for c in columns], "_header", "_line", "_published_at", "_row_id")


def _series(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each series as a trimmed text key: the report's own value, else the
    path's; empty is NULL."""
    for n in names:
        own = F.trim(F.col(n)) if n in df.columns else F.lit(None).cast("string")
        df = df.withColumn(n, F.coalesce(F.when(own != "", own), path_part(F.col("_published_at"), n)))
    return df


def _tagged(df: DataFrame, names: Sequence[str], bad: Sequence[tuple[Column, str]], layout: Sequence[str]) -> DataFrame:
    """``layout`` columns with ``_reason``: the first test that holds; the
    series lead."""
    reason = F.lit(None).cast("string")
    for test, why in reversed([*bad, *[(F.col(n).isNull(), f"no {n}") for n in names]]):
        reason = F.when(test, why).otherwise(reason)
    return df.select(*names, *[c for c in layout if c not in names], reason.alias("_reason"))


def _missing(*measures: str) -> list[tuple[Column, str]]:
    """Rejects of typed rows: no date, no hour, no required measure."""
    return [(F.col("date").isNull(), "bad date"), (F.col("hour").isNull(), "bad hour"),
            *[(F.col(m).isNull(), "no measure") for m in measures]]


def _report(spark: SparkSession, paths: str | Sequence[str], names: dict[str, str], required: str,
            types: dict[str, str], rest: str | None, series: Sequence[str] | None) -> DataFrame:
    """A delimited report as typed columns: those of ``names`` and, if ``rest``
    is a type, all others too.  S3, S4: a bad cell is NULL (``try_cast``); a
    bad date, hour or ``required`` measure tags its row."""
    raw = read_banner_csv(spark, paths)
    if series is None:
        series = [n for n in config.SERIES if n in raw.columns] or series_in(spark, paths)
    raw = _series(raw, series)
    given = [c for c in raw.columns if not c.startswith("_") and c not in series]
    sources = {dst: src for src, dst in names.items() if src in given}
    if rest is not None:
        sources.update({c: c for c in given if c not in names})
    types = {"date": "date", "hour": "int", **{c: rest for c in sources if c not in names.values()}, **types}
    text = {dst: F.trim(F.col(f"`{src}`")) for dst, src in sources.items()}
    typed = raw.select(*series, *[t.try_cast(types[c]).alias(c) for c, t in text.items()], "_header", "_published_at", "_row_id",
                       (text[required] if required in text else F.lit(None).cast("string")).alias("_measure"))
    null = lambda c: F.col(c).isNull() if c in text else F.lit(True)
    empty = F.coalesce(F.col("_measure"), F.lit("")) == ""
    tests = [(F.col("_header").isNull(), "no header"), (null("date"), "bad date"), (null("hour"), "bad hour"),
             (null(required) & ~empty, "bad measure"), (null(required), "no measure")]
    return _tagged(typed, series, tests, [*sources, "_published_at", "_row_id"])


def read_demand_report(spark: SparkSession, paths: str | Sequence[str], series: Sequence[str] | None = None) -> DataFrame:
    """Demand report: date, hour, market_demand, region_demand (+ order)."""
    return _report(spark, paths, DEMAND_COLUMNS, "region_demand",
                   {"market_demand": "int", "region_demand": "int"}, None, series)


def read_price_report(spark: SparkSession, paths: str | Sequence[str], series: Sequence[str] | None = None) -> DataFrame:
    """Price report: date, hour, energy_price; predispatch and reserve
    columns pass through as doubles."""
    return _report(spark, paths, PRICE_COLUMNS, "energy_price", {"energy_price": "double"}, "double", series)


def read_dayahead_report(spark: SparkSession, paths: str | Sequence[str], series: Sequence[str] | None = None) -> DataFrame:
    """Day-ahead prices in the same form: date, hour, da_price."""
    return _report(spark, paths, DAYAHEAD_COLUMNS, "da_price", {"da_price": "double"}, None, series)


def _element(name: str) -> str:
    """The XML element of a series."""
    return name.capitalize()


def _series_elements() -> list[T.StructField]:
    return [T.StructField(_element(n), T.StringType()) for n in config.SERIES]


def _xml_series(spark: SparkSession, paths, series: Sequence[str] | None) -> list[str]:
    return list(series) if series is not None else series_in(spark, paths, lambda n: [f"<{_element(n)}>"])


GENERATION_SCHEMA = T.StructType([
    *_series_elements(),
    T.StructField("Day", T.StringType()),
    T.StructField("HourlyData", T.ArrayType(T.StructType([
        T.StructField("Hour", T.StringType()),
        T.StructField("FuelTotal", T.ArrayType(T.StructType([
            T.StructField("Fuel", T.StringType()),
            T.StructField("EnergyValue", T.StructType([T.StructField("Output", T.StringType())])),
        ]))),
    ]))),
])


def read_generation_xml(spark: SparkSession, paths: str | Sequence[str], series: Sequence[str] | None = None) -> DataFrame:
    """Generation XML (default namespace) to long rows.

    A day without Day, an hour without Hour, and a fuel without Fuel or
    without Output text are skipped; the fuel name is trimmed and title
    cased (``initcap``: capitals after white space only).  A day may name
    its region.
    """
    series = _xml_series(spark, paths, series)
    days = (spark.read.format("xml").option("rowTag", "DailyData").option("recursiveFileLookup", True)
            .schema(GENERATION_SCHEMA).load(paths))
    hours = (days.filter(F.col("Day").isNotNull())
             .select("*", "_metadata", F.explode("HourlyData").alias("h"))
             .filter(F.col("h.Hour").isNotNull()))
    fuels = hours.select("*", "_metadata", F.explode("h.FuelTotal").alias("f"))
    out = F.col("f.EnergyValue.Output")
    rows = fuels.filter(F.col("f.Fuel").isNotNull() & out.isNotNull() & (out != "")).select(
        *[F.col(_element(n)).alias(n) for n in series],
        F.trim("Day").try_cast("date").alias("date"),
        F.trim("h.Hour").try_cast("int").alias("hour"),
        F.initcap(F.trim("f.Fuel")).alias("fuel_type"),
        F.trim(out).try_cast("double").alias("output_mw"),
        F.col("_metadata.file_path").alias("_published_at"), _position().alias("_row_id"))
    bad = [*_missing(), (F.col("output_mw").isNull(), "bad measure")]
    return _tagged(_series(rows, series), series, bad, ["date", "hour", "fuel_type", "output_mw", "_published_at", "_row_id"])


INTERTIE_SCHEMA = T.StructType([
    *_series_elements(),
    T.StructField("Date", T.StringType()),
    T.StructField("IntertieZone", T.ArrayType(T.StructType([
        *_series_elements(),
        T.StructField("IntertieZoneName", T.StringType()),
        T.StructField("Schedules", T.ArrayType(T.StructType([
            T.StructField("Schedule", T.ArrayType(T.StructType([
                T.StructField("Hour", T.StringType()),
                T.StructField("Import", T.StringType()),
                T.StructField("Export", T.StringType()),
            ]))),
        ]))),
        T.StructField("Actuals", T.ArrayType(T.StructType([
            T.StructField("Actual", T.ArrayType(T.StructType([
                T.StructField("Hour", T.StringType()),
                T.StructField("Flow", T.StringType()),
            ]))),
        ]))),
    ]))),
])


def _mw(text: Column) -> Column:
    """Absent or empty import/export is 0."""
    return F.coalesce(F.trim(text).try_cast("double"), F.lit(0.0))


def read_intertie_xml(spark: SparkSession, paths: str | Sequence[str], series: Sequence[str] | None = None) -> DataFrame:
    """Scheduled import and export per (date, hour, zone), with the
    actual flow of the hour attached (the last Actual of the hour wins,
    even when its flow is empty; Actuals without a schedule are dropped).
    Where several files hold one hour, schedule and actual both come from
    the last published file that schedules it.  A body, or a zone in it, may
    name its region.  A date that cannot be read is NULL."""
    from ..operators.joins import attach_actuals
    series = _xml_series(spark, paths, series)
    body = (spark.read.format("xml").option("rowTag", "IMODocBody").option("recursiveFileLookup", True)
            .schema(INTERTIE_SCHEMA).load(paths))
    zones = body.select("*", "_metadata", F.posexplode("IntertieZone").alias("_zone", "z"))
    zones = _series(zones.filter(F.col("z.IntertieZoneName").isNotNull()).select(
        *[F.coalesce(F.col(f"z.{_element(n)}"), F.col(_element(n))).alias(n) for n in series],
        F.trim("Date").try_cast("date").alias("date"), F.col("_metadata.file_path").alias("_published_at"),
        F.col("_metadata.file_block_start").alias("_block"), "_zone",
        F.trim("z.IntertieZoneName").alias("intertie_zone"),
        F.flatten(F.col("z.Schedules.Schedule")).alias("sched"),
        F.flatten(F.col("z.Actuals.Actual")).alias("act")), series)
    keys = [*series, "date", "hour", "intertie_zone"]
    schedules = (zones.select(*series, "date", "intertie_zone", "_published_at", "_block", "_zone",
                              F.posexplode("sched").alias("_pos", "s"))
                 .filter(F.col("s.Hour").isNotNull())
                 .select(*series, "date", F.trim("s.Hour").try_cast("int").alias("hour"),
                         "intertie_zone",
                         _mw(F.col("s.Import")).alias("schedule_import_mw"),
                         _mw(F.col("s.Export")).alias("schedule_export_mw"),
                         "_published_at", "_block", "_zone", "_pos"))
    # A repeated schedule key: keep the first row of the file (only it is
    # filled upstream), then attach the actual.
    schedules = keep_last(schedules, keys, [("_published_at", True), ("_block", False), ("_zone", False), ("_pos", False)])
    actuals = (zones.select(*series, "date", "intertie_zone", "_published_at", "_block", "_zone",
                            F.posexplode("act").alias("pos", "a"))
               .filter(F.col("a.Hour").isNotNull() & F.col("a.Flow").isNotNull())
               .select(*series, "date", F.trim("a.Hour").try_cast("int").alias("hour"),
                       "intertie_zone", "_published_at", F.struct("_block", "_zone", "pos").alias("pos"),
                       F.trim("a.Flow").try_cast("double").alias("flow")))
    rows = attach_actuals(schedules, actuals, keys=[*keys, "_published_at"])
    return _tagged(rows, series, _missing(), ["date", "hour", "intertie_zone", "schedule_import_mw", "schedule_export_mw", "actual_flow_mw"])


REALTIME_COLUMNS = ("hour", "interval", "total_energy", "total_loss", "total_load",
                    "total_disp_load_sched_off", "total_10s", "total_10n", "total_30r")
REALTIME_REQUIRED = "total_energy"


def parse_realtime_text(text: DataFrame, value: str = "value", series: Sequence[str] = ()) -> DataFrame:
    """S8 on a frame of whole report texts (batch or streaming).

    The header is the first line that starts with HOUR; data lines are the
    non-blank lines after it; the data date is taken from the first line
    that holds FOR, after its last FOR, as yyyy/MM/dd.  A file without a
    parsable date gives rows with a NULL date, and one without a header line
    one row without cells; ``_reason`` says so (see ``split_rejects``).
    ``series`` names the key columns to carry: a column of the report, or a
    folder of the path."""
    lines = F.transform(F.split(F.col(value), "\n"),
                        lambda l: F.trim(F.regexp_replace(l, "\r", "")))
    header_at = F.array_position(
        F.transform(lines, lambda l: F.upper(l).startswith(REALTIME_HEADER_PREFIX)), True)
    banner = F.try_element_at(F.filter(lines, lambda l: F.instr(l, REALTIME_DATE_MARK) > 0),
                              F.lit(1))
    date_text = F.trim(F.try_element_at(F.split(banner, REALTIME_DATE_MARK), F.lit(-1)))
    header = F.when(header_at > 0, F.try_element_at(lines, header_at.cast("int")))  # noqa
    names = F.transform(F.split(header, ","),
                        lambda h: F.lower(F.regexp_replace(F.trim(h), " ", "_")))
    body = F.filter(F.slice(lines, (header_at + 1).cast("int"), F.size(lines)), lambda l: l != "")
    parsed = text.select(
        F.to_date(F.try_to_timestamp(date_text, F.lit(REALTIME_DATE_FORMAT))).alias("date"),
        names.alias("_names"),
        F.when(header_at > 0, body).otherwise(F.array(F.lit(""))).alias("_body"),
        *[c for c in text.columns if c.startswith("_")])
    rows = parsed.select("*", F.posexplode("_body").alias("_line_no", "_line"))
    cells = F.split("_line", ",")

    def cell(name: str) -> Column:
        at = F.array_position(F.col("_names"), F.lit(name)).cast("int")
        return F.when(at > 0, F.trim(F.try_element_at(cells, at)))

    measures = [cell(c).try_cast("int" if c in ("hour", "interval") else "double").alias(c)
                for c in REALTIME_COLUMNS]
    keep = [c for c in text.columns if c.startswith("_")]
    typed = rows.select(*[cell(n).alias(n) for n in series], "date", *measures, *keep, "_line_no",
                        F.col("_names").isNull().alias("_headless"), cell(REALTIME_REQUIRED).alias("_measure"))
    lost = F.col(REALTIME_REQUIRED).isNull()
    bad = [(F.col("_headless"), "no header"), *_missing(), (F.col("interval").isNull(), "bad interval"),
           (lost & (F.coalesce(F.col("_measure"), F.lit("")) != ""), "bad measure"), (lost, "no measure")]
    if "_published_at" in keep:
        typed = _series(typed, series)
    return _tagged(typed, series, bad, ["date", *REALTIME_COLUMNS, *keep, "_line_no"])


def read_realtime_report(spark: SparkSession, paths: str | Sequence[str], series: Sequence[str] | None = None) -> DataFrame:
    """Real-time totals files.  Each file is read whole (one task per
    file; reports are small and many, so files are the parallel unit)."""
    if series is None:
        series = series_in(spark, paths, lambda n: [f",{n},"])
    text = spark.read.option("recursiveFileLookup", True).text(paths, wholetext=True)
    text = text.select("value", F.col("_metadata.file_path").alias("_published_at"))
    return parse_realtime_text(text, series=series)


def split_rejects(df: DataFrame, required: Sequence[str] = ("date",)) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects.  Rows of a reader are told by their ``_reason``
    (the good ones come without it); those of another frame must have all
    ``required`` columns."""
    if "_reason" in df.columns:
        return df.filter(F.col("_reason").isNull()).drop("_reason"), df.filter(F.col("_reason").isNotNull())
    ok = None
    for c in required:
        t = F.col(c).isNotNull()
        ok = t if ok is None else ok & t
    return df.filter(ok), df.filter(~ok)


WEATHER_SCHEMA = T.StructType([
    *[T.StructField(n, T.StringType()) for n in config.SERIES],
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("relative_humidity_2m", T.ArrayType(T.DoubleType())),
        T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
    ])),
])


def read_weather_json(spark: SparkSession, paths: str | Sequence[str], series: Sequence[str] | None = None) -> DataFrame:
    """Parallel hourly arrays zipped to rows; hour 0-23 becomes
    hour-ending 1-24 of the same date.  A document may name its region, and a
    file may be an array of documents."""
    if series is None:
        series = series_in(spark, paths, lambda n: [f'"{n}"'])
    doc = spark.read.option("multiLine", True).option("recursiveFileLookup", True).schema(WEATHER_SCHEMA).json(paths)
    h = F.col("hourly")
    rows = doc.filter(h.isNotNull()).select(
        *series, "_metadata",
        F.explode(F.arrays_zip(h["time"].alias("time"),
                               h["temperature_2m"].alias("temperature_c"),
                               h["relative_humidity_2m"].alias("humidity_pct"),
                               h["wind_speed_10m"].alias("wind_speed_kmh")))
        .alias("r"))
    ts = F.try_to_timestamp(F.col("r.time"), F.lit(WEATHER_TIME_FORMAT))
    typed = rows.select(*series, F.to_date(ts).alias("date"), (F.hour(ts) + 1).alias("hour"),
                        *[F.col(f"r.{c}").alias(c) for c in ("temperature_c", "humidity_pct", "wind_speed_kmh")],
                        F.col("_metadata.file_path").alias("_published_at"), _position().alias("_row_id"))
    return _tagged(_series(typed, series), series, _missing("temperature_c"),
                   ["date", "hour", "temperature_c", "humidity_pct", "wind_speed_kmh", "_published_at", "_row_id"])


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths or globs that exist (a metadata call each, on the driver, and
    no data read; name a folder or a glob where files are many)."""
    return [p for p in paths if exists(spark, p)]


def backfill(spark: SparkSession, reader, paths: Sequence[str],
             keys: Sequence[str] = config.KEYS) -> DataFrame | None:
    """One read over every yearly file that exists (missing years
    are skipped), the last published good row per key kept, ordered by key.
    The region leads the key where the reports have one.  Returns None when
    no file exists."""
    present = existing_paths(spark, paths)
    if not present:
        return None
    df, _ = split_rejects(reader(spark, present))
    keys = [*config.series_of(df), *keys]
    order = [c for c in ("_published_at", "_row_id") if c in df.columns]
    return keep_last(df, keys, order, drop_order=True).orderBy(*keys)
