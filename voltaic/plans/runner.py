"""Run the layers in order (X4): landed reports -> bronze -> silver -> gold
-> serving, and publish.

One failed source does not stop the others; the result is a small frame
with one row per (layer, table): rows written, or the error.  Each layer
reads the tables that this run wrote in the layer before, so lineage is
cut at every layer (a written table on shared storage, not a local
checkpoint) and no table of an earlier run enters a new one: a source that
failed now is absent, and the summary says so.  The hourly fact is
computed once; marts and views read it back.

A report is read once.  Its rows go to one bronze table, in one write that
is partitioned by ``status``: ``ok``, or why silver could not use the row.
Counts by status come from the same write, so rows in are rows in bronze and
rejects, reason by reason.

An incremental run (``LayerConfig(incremental=True)``) reads only files that
no run has read, appends them to bronze, and rewrites the months that they
touch in silver, gold and serving.  What it leaves equals a full run.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators.dedupe import pack_order
from ..operators.quality import ContractError
from ..sources import lake, probe, reports
from ..streaming.realtime import hourly_totals, snapshot_side
from . import gold as G
from . import serving as V
from . import silver as S

READERS: dict[str, Callable[[SparkSession, list[str]], DataFrame]] = {
    "demand": reports.read_demand_report,
    "prices": reports.read_price_report,
    "generation": reports.read_generation_xml,
    "intertie": reports.read_intertie_xml,
    "realtime": reports.read_realtime_report,
    "weather": reports.read_weather_json,
    "dayahead": reports.read_dayahead_report,
}

# The columns each report must carry; an empty report or a missing
# column fails that source only.  (Upstream checks the first four sources.)
CONTRACTS = {
    "demand": ("date", "hour", "market_demand", "region_demand"),
    "generation": ("date", "hour", "fuel_type", "output_mw"),
    "prices": ("date", "hour", "energy_price"),
    "weather": ("date", "hour", "temperature_c"),
    "dayahead": ("date", "hour", "da_price"),
}

# Why a row is no good; a series adds its own ("no region").
REASONS = ("no header", "bad date", "bad hour", "bad interval", "bad measure", "no measure",
           *[f"no {n}" for n in config.SERIES])

# How a table is laid out on write: partitions for pruning by period, sort
# within files for statistics on the key.
PARTITIONS = ("year", "month")
SORT = (*config.SERIES, "date", "hour")

# Gold tables with one row per hour or day, changed month by month.
MONTHLY = ("fct_hourly_grid_snapshot", "mart_daily_summary", "mart_carbon_intensity")
# Gold tables that are published to the serving database.
PUBLISHED = ("dim_date", "dim_fuel_type", "fct_hourly_grid_snapshot", "mart_daily_summary",
             "mart_carbon_intensity")

# Silver sources that the hourly fact joins on its key.
JOINED = ("demand", "generation", "prices", "weather", "realtime", "dayahead")

Month = tuple[int, int]


@dataclass
class LayerConfig:
    """``publish``: target of ``lake.publish`` (None: nothing is published);
    ``publish_prefix`` leads published table names, such as a schema.
    ``incremental``: read only files that are new since the last run.
    ``buckets``: silver tables that the hourly fact joins are bucketed and
    sorted by its key, this many buckets per month, so its joins read them
    without a shuffle; they are catalog tables named by ``catalog`` too."""

    lake_root: str
    landed: Mapping[str, list[str]] = field(default_factory=dict)
    fmt: str = lake.DEFAULT_FORMAT
    publish: Mapping[str, str] | None = None
    publish_prefix: str = ""
    incremental: bool = False
    buckets: int | None = None
    catalog: str = "voltaic_"


def _try(results: list, layer: str, table: str, fn) -> bool:
    """Run one step; whether it wrote its table."""
    try:
        rows = fn()
        results.append((layer, table, rows, None if rows is not None else "no input"))
        return rows is not None
    except Exception as exc:  # one failed table does not stop the rest
        results.append((layer, table, None, f"{type(exc).__name__}: {exc}"))
        return False


def in_months(df: DataFrame, months: Iterable[Month]) -> DataFrame:
    """Rows of the months, by the partition columns where there are any."""
    year, month = (F.col(c) if c in df.columns else f("date") for c, f in zip(PARTITIONS, (F.year, F.month)))
    tests = [(year == y) & (month == m) for y, m in months]
    return df.filter(reduce(lambda a, b: a | b, tests, F.lit(False)))


class Run:
    """One run over a lake: where tables are, and what changed."""

    def __init__(self, spark: SparkSession, cfg: LayerConfig):
        self.spark, self.cfg, self.root = spark, cfg, cfg.lake_root.rstrip("/")
        self.results: list = []
        self.at = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")
        #: Months with new rows, of each source read in part; a source read as
        #: a whole is not among them.
        self.months: dict[str, set[Month]] = {}

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def bucketed(self, layer: str, name: str) -> bool:
        return self.cfg.buckets is not None and layer == "silver" and name in JOINED

    def buckets(self, df: DataFrame, layer: str, name: str) -> dict:
        """How a bucketed table is laid out."""
        return {"table": f"{self.cfg.catalog}{layer}_{name}", "path": self.path(layer, name), "keys": [*config.series_of(df), *config.KEYS],
                "buckets": self.cfg.buckets, "partition_by": PARTITIONS}

    def read(self, layer: str, name: str) -> DataFrame:
        if self.bucketed(layer, name):
            how = self.buckets(lake.read_table(self.spark, self.path(layer, name), "parquet"), layer, name)
            return lake.register_bucketed(self.spark, **how)
        return lake.read_table(self.spark, self.path(layer, name), self.cfg.fmt)

    def write(self, df: DataFrame, layer: str, name: str, months: set[Month] | None = None, by_month: bool = True) -> int:
        """Replace a table, or just the given months of it."""
        if by_month and "date" in df.columns:
            df = df.select("*", *[f("date").alias(c) for c, f in zip(PARTITIONS, (F.year, F.month)) if c not in df.columns])
            if months is not None:
                df = in_months(df, months)
        if self.bucketed(layer, name):
            return lake.write_bucketed(df, dynamic=months is not None, **self.buckets(df, layer, name))
        parts = PARTITIONS if by_month and "date" in df.columns else ()
        return lake.write_table(df, self.path(layer, name), self.cfg.fmt, partition_by=parts,
                                sort_by=[c for c in SORT if c in df.columns], dynamic=months is not None)

    # --- bronze -------------------------------------------------------------

    def new_files(self, name: str, present: list[str]) -> tuple[DataFrame, list[str] | None]:
        """All landed files, and the paths of new ones; None if the source is
        to be read as a whole (first run, or a file has changed since it was
        read).  Files that were read need not stay."""
        files = probe.listing(self.spark, present)
        known = lake.optional(self.spark, self.path("ledger", name), self.cfg.fmt) if self.cfg.incremental else None
        if known is None or lake.optional(self.spark, self.path("bronze", name), self.cfg.fmt) is None:
            return files, None
        both = known.select("path", F.struct("length", "modified").alias("then")).join(files, "path", "left")
        if not both.filter(F.col("then") != F.struct("length", "modified")).isEmpty():
            if not both.filter(F.col("length").isNull()).isEmpty():
                raise ValueError(f"{name}: a file has changed and others that were read are gone; land all of them")
            return files, None
        return files, [r.path for r in files.join(known, "path", "left_anti").select("path").collect()]

    def bronze(self, name: str, paths: list[str]) -> int | None:
        spark, table = self.spark, self.path("bronze", name)
        present = reports.existing_paths(spark, paths)
        if not present:
            return None
        files, new = self.new_files(name, present)
        files = files.select("*", self.at.alias("loaded_at"))
        if new == []:
            self.months[name] = set()
            return 0
        df = READERS[name](spark, present if new is None else [probe.plain_path(p) for p in new])
        if new is not None and config.series_of(df) != config.series_of(self.read("bronze", name)):
            new, df = None, READERS[name](spark, present)
        missing = sorted(set(CONTRACTS.get(name, ())) - set(df.columns))
        if missing:
            raise ContractError(f"{name}: missing columns {missing}")
        source = F.col("_published_at") if "_published_at" in df.columns else name
        df = lake.with_lineage(df, source, self.at).withColumnRenamed("_reason", "status")
        df = df.withColumn("status", F.coalesce("status", F.lit("ok"))).select("*", F.year("date").alias("year"), F.month("date").alias("month"))

        def check(counts):
            if name in CONTRACTS and not counts["ok"]:
                raise ContractError(f"{name}: no rows")

        counts = lake.write_counted(
            df, table, self.cfg.fmt, partition_by=("status", *PARTITIONS), mode="overwrite" if new is None else "append",
            counts={s: F.count_if(F.col("status") == s) for s in ("ok", *REASONS)}, check=check if new is None else None)
        # A run that stops here reads the same rows once more: they repeat
        # path and place, and keep-last takes one.
        if new is None:
            lake.write_table(files, self.path("ledger", name), self.cfg.fmt)
        else:
            lake.write_table(files.filter(F.col("path").isin(new)), self.path("ledger", name), self.cfg.fmt, mode="append")
            loaded = self.read("bronze", name).filter((F.col("status") == "ok") & (F.col("_loaded_at") == self.at))
            self.months[name] = {(r.year, r.month) for r in loaded.select(*PARTITIONS).distinct().collect()}
        self.results.append(("rejects", name, counts["rows"] - counts["ok"], None))
        self.results += [("rejects", f"{name}/{why}", counts[why], None) for why in REASONS if counts[why]]
        return counts["ok"]

    def accepted(self, name: str) -> DataFrame:
        """Good bronze rows with their packed publication order."""
        df = self.read("bronze", name).filter(F.col("status") == "ok")
        if name in self.months:
            df = in_months(df, self.months[name])
        df = lake.drop_lineage(df).drop("status", *PARTITIONS)
        place = "_line_no" if "_line_no" in df.columns else "_row_id"
        return pack_order(df, place=place) if "_published_at" in df.columns else df

    # --- the layers ---------------------------------------------------------

    def __call__(self) -> DataFrame:
        landed = [n for n in READERS if self.cfg.landed.get(n)]
        bronze_now = [n for n in landed if _try(self.results, "bronze", n, lambda n=n: self.bronze(n, self.cfg.landed[n]))]
        if self.cfg.incremental and set(bronze_now) != set(landed):
            self.months = {}
        if self.cfg.incremental:
            # Sources that land nothing now keep what they have.
            for name in READERS:
                if name not in landed and lake.optional(self.spark, self.path("silver", name), self.cfg.fmt) is not None:
                    bronze_now.append(name)
                    self.months[name] = set()
        if set(self.months) != set(bronze_now) or not lake.exists(self.spark, self.path("gold", "fct_hourly_grid_snapshot")):
            # Some source was read as a whole: so is everything after bronze.
            self.months = {}
        changed = set().union(*self.months.values()) if self.months else None

        silver_now: dict[str, DataFrame] = {}
        for name in bronze_now:
            def silver(name=name):
                months = self.months.get(name)
                if months is not None and not months:
                    return 0
                return self.write(S.TRANSFORMS[name](self.accepted(name)), "silver", name, months)
            if _try(self.results, "silver", name, silver):
                silver_now[name] = self.read("silver", name)
        if "demand" in silver_now:
            self.gold_and_serving(silver_now, changed)
        return self.summary()

    def gold_and_serving(self, silver: dict[str, DataFrame], changed: set[Month] | None) -> None:
        series = config.series_of(silver["demand"])
        for name in [n for n in silver if config.series_of(silver[n]) != series]:
            self.results.append(("gold", name, None, f"ValueError: {name} and demand must both name a region, or neither"))
            del silver[name]
        gold_now: list[str] = []

        def gold(name: str, build: Callable[[], DataFrame]) -> bool:
            months = changed if name in MONTHLY else None
            done = _try(self.results, "gold", name, lambda: 0 if months is not None and not months else self.write(build(), "gold", name, months, name in MONTHLY))
            if done:
                gold_now.append(name)
            return done

        def touched(df: DataFrame) -> DataFrame:
            return df if changed is None else in_months(df, changed)

        gold("dim_date", lambda: G.dim_date(silver["demand"]))
        gold("dim_fuel_type", lambda: G.dim_fuel_type(self.spark))
        gold("dim_hour", lambda: G.dim_hour(self.spark))
        gold("dim_zone", lambda: G.dim_zone(self.spark))
        if gold("fct_hourly_grid_snapshot", lambda: _fact({n: touched(df) for n, df in silver.items()})):
            fact = self.read("gold", "fct_hourly_grid_snapshot")
            gold("mart_daily_summary", lambda: G.mart_daily_summary(touched(fact)))
            gold("mart_carbon_intensity", lambda: G.carbon_mart(touched(fact)))
            dayahead = silver.get("dayahead")
            part = V.serving_tables(touched(fact), dayahead if dayahead is None else touched(dayahead))
            for name, build in V.serving_tables(fact, dayahead).items():
                self.serving(name, part[name] if name in V.MONTHLY else build, fact, changed)
        if self.cfg.publish is not None:
            for name in [n for n in PUBLISHED if n in gold_now]:
                def publish(name=name):
                    table = self.read("gold", name)
                    lake.publish(table, self.cfg.publish_prefix + name, self.cfg.publish)
                    return next(rows for layer, t, rows, _ in self.results if (layer, t) == ("gold", name))
                _try(self.results, "publish", name, publish)

    def serving(self, name: str, build: Callable[[], DataFrame], fact: DataFrame, changed: set[Month] | None) -> None:
        def write():
            if changed is None or (name not in V.MONTHLY and name != "mart_renewable_penetration"):
                return self.write(build(), "serving", name, by_month=name in V.MONTHLY or name == "mart_renewable_penetration")
            if not changed:
                return 0
            if name in V.MONTHLY:
                return self.write(build(), "serving", name, changed)
            # Rolling means of the next month look back into this one, and
            # those of this month into the one before.
            reach = {_shift(m, 1) for m in changed} | changed
            rolled = V.renewable_penetration(in_months(fact, reach | {_shift(m, -1) for m in reach}))
            return self.write(V.declared_types(rolled), "serving", name, reach)

        _try(self.results, "serving", name, write)

    def summary(self) -> DataFrame:
        return self.spark.createDataFrame(self.results, "layer string, table_name string, rows long, error string")


def _shift(month: Month, by: int) -> Month:
    n = month[0] * 12 + month[1] - 1 + by
    return n // 12, n % 12 + 1


def run_layers(spark: SparkSession, cfg: LayerConfig) -> DataFrame:
    return Run(spark, cfg)()


def _fact(silver: Mapping[str, DataFrame]) -> DataFrame:
    realtime = silver.get("realtime")
    side = snapshot_side(hourly_totals(realtime)) if realtime is not None else None
    return G.hourly_snapshot(silver["demand"], silver.get("generation"), silver.get("prices"), silver.get("weather"), realtime=side)
