"""Lake tables: lineage columns, bronze ingest, table read/write, optional
sources, seeds and publishing (S11, S12, S15-S22).

The table format is a setting (``parquet`` by default; ``delta`` when its
package is on the classpath).  Writes report their row count through an
``Observation`` collected while writing, so a table is never computed a
second time just to count it.
"""

from __future__ import annotations

import os
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINEAGE = ("_loaded_at", "_source")
DEFAULT_FORMAT = os.environ.get("VOLTAIC_TABLE_FORMAT", "parquet")


def with_lineage(df: DataFrame, source: str | Column | None = None, loaded_at: Column | None = None) -> DataFrame:
    """Load time and source.  Without ``source`` the file path of each
    row is used (the frame must come straight from a file read).
    ``loaded_at`` gives all rows of a run one time."""
    if source is None:
        source = F.col("_metadata.file_path")
    src = F.lit(source) if isinstance(source, str) else source
    when = F.current_timestamp() if loaded_at is None else loaded_at
    return df.select("*", when.alias("_loaded_at"), src.alias("_source"))


def drop_lineage(df: DataFrame) -> DataFrame:
    """Drop lineage columns if present (absent names are ignored)."""
    return df.drop(*LINEAGE)


def widen_numeric(df: DataFrame) -> DataFrame:
    """Int and long columns to double, others unchanged."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, (T.IntegerType, T.LongType)) else F.col(f.name)
                       for f in df.schema.fields])


def write_raw(df: DataFrame, path: str) -> None:
    """Landed CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def _fs(spark: SparkSession, path: str):
    """The file system of ``path`` and a function that makes its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _new(path: str) -> str:
    return path.rstrip("/") + ".__new"


def _old(path: str) -> str:
    return path.rstrip("/") + ".__old"


def restore(spark: SparkSession, path: str) -> None:
    """Undo a replacement that stopped between its two renames: the old table
    is back under its name."""
    fs, make = _fs(spark, path)
    if fs.exists(make(_old(path))):
        if not fs.exists(make(path)):
            fs.rename(make(_old(path)), make(path))
        else:
            fs.delete(make(_old(path)), True)


def _put_in_place(spark: SparkSession, path: str) -> None:
    """The staged table takes the place of the one at ``path``.  Readers
    find the old or the new one, but for the moment between two renames."""
    fs, make = _fs(spark, path)
    if fs.exists(make(path)):
        if not fs.rename(make(path), make(_old(path))):
            raise IOError(f"cannot move {path}")
    if not fs.rename(make(_new(path)), make(path)):
        restore(spark, path)
        raise IOError(f"cannot replace {path}")
    fs.delete(make(_old(path)), True)


def write_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT,
                partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
                mode: str = "overwrite", dynamic: bool = False) -> int:
    """Write a table and return its row count.

    ``partition_by`` (e.g. year, month) lets readers prune; ``sort_by``
    orders rows within each file (by date, hour) so file statistics skip
    row groups.  Rows are dealt out by range of both before they are
    written, so a directory gets its rows from a task or two and not from
    every task, and the number of files grows with the data.  ``dynamic``
    replaces only the partitions present in ``df`` (an increment).  The
    count is observed during the write.

    A whole table is written beside the old one and takes its place by
    rename when all of it is there, so a write that fails leaves the old
    table as it was.  (A transactional format does this by itself.)
    """
    return write_counted(df, path, fmt, partition_by, sort_by, mode, dynamic)["rows"]


def write_counted(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT,
                  partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
                  mode: str = "overwrite", dynamic: bool = False,
                  counts: Mapping[str, Column] | None = None,
                  check: Callable[[Mapping[str, int]], None] | None = None) -> dict[str, int]:
    """``write_table`` that also observes ``counts`` (aggregates over the rows
    written; a name has its aggregate).  ``check`` sees them before a
    replacement takes effect and may raise, which leaves the old table."""
    spark = df.sparkSession
    obs = Observation()
    if partition_by:
        df = df.repartitionByRange(*dict.fromkeys([*partition_by, *sort_by]))
    if sort_by:
        df = df.sortWithinPartitions(*dict.fromkeys([*partition_by, *sort_by]))
    wanted = {"rows": F.count(F.lit(1)), **(counts or {})}
    observed = df.observe(obs, *[c.alias(n) for n, c in wanted.items()])
    # An empty partitioned table is one file without rows, for its schema.
    if dynamic and partition_by and exists(spark, f"{path}/part-*"):
        dynamic = False
    staged = mode == "overwrite" and not dynamic and fmt != "delta"
    if staged:
        restore(spark, path)
    writer = observed.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(_new(path) if staged else path)
    seen = obs.get
    got = {n: int(seen.get(n) or 0) for n in wanted}
    if check is not None:
        check(got)
    if staged:
        if partition_by and not got["rows"]:
            df.limit(0).write.format(fmt).mode(mode).save(_new(path))
        _put_in_place(spark, path)
    return got


def register_bucketed(spark: SparkSession, table: str, path: str, keys: Sequence[str], buckets: int,
                      partition_by: Sequence[str] = ()) -> DataFrame:
    """Tell the session's catalog of the bucketed table at ``path``, and read
    it.  Files carry their bucket's number, so nothing is written."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    schema = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = lambda names: ", ".join(f"`{c}`" for c in names)
    parts = f"PARTITIONED BY ({by(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') {parts} "
              f"CLUSTERED BY ({by(keys)}) SORTED BY ({by(keys)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int,
                   partition_by: Sequence[str] = (), dynamic: bool = False) -> int:
    """A Parquet table whose files are buckets of ``keys``, sorted by
    them; returns the row count.

    Tables with one number of buckets join on the keys, and group by them,
    without a shuffle.  Rows are dealt to one task per bucket before the
    write, so a partition has at most ``buckets`` files.  Replacement and
    increments are those of ``write_table``; ``table`` names it in the catalog.
    """
    spark, obs = df.sparkSession, Observation()
    df = df.repartition(buckets, *keys).observe(obs, F.count(F.lit(1)).alias("rows"))
    if dynamic:
        register_bucketed(spark, table, path, keys, buckets, partition_by)
        df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
        return int(obs.get.get("rows", 0))
    restore(spark, path)
    draft = f"{table}__new"
    spark.sql(f"DROP TABLE IF EXISTS {draft}")
    fs, make = _fs(spark, path)
    fs.delete(make(_new(path)), True)
    writer = df.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", _new(path))
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(draft)
    spark.sql(f"DROP TABLE {draft}")
    rows = int(obs.get.get("rows", 0))
    if partition_by and not rows:
        df.limit(0).write.mode("overwrite").parquet(_new(path))
    _put_in_place(spark, path)
    register_bucketed(spark, table, path, keys, buckets, partition_by if rows else ())
    return rows


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def optional(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame | None:
    """The table at ``path``, or None if nothing is there.  Any other
    error of the read is raised."""
    restore(spark, path)
    return read_table(spark, path, fmt) if exists(spark, path) else None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder (or a match of a glob) is at ``path``."""
    fs, make = _fs(spark, path)
    return bool(fs.globStatus(make(path)))


def ingest(spark: SparkSession, raw_path: str, table_path: str,
           schema: T.StructType | str | None = None, widen: bool = False,
           fmt: str = DEFAULT_FORMAT) -> int | None:
    """Landed CSV to a bronze table, replacing it; lineage columns are
    dropped.  With no schema every cell is text (typing is silver's job).
    Returns the row count, or None when nothing is landed."""
    if not exists(spark, raw_path):
        return None
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = drop_lineage(reader.csv(raw_path))
    if widen:
        df = widen_numeric(df)
    return write_table(df, table_path, fmt)


FUEL_SEED_SCHEMA = ("fuel_type string, fuel_category string, is_renewable boolean, "
                    "carbon_factor_gco2_kwh int, display_color string, display_order int")
ZONE_SEED_SCHEMA = "zone_code string, zone_name string, latitude double, longitude double"


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A seed CSV with a header and a fixed schema."""
    return spark.read.option("header", True).schema(schema).csv(path)


def publish(df: DataFrame, table: str, target: Mapping[str, str] | None = None) -> None:
    """Replace a serving table.

    ``target`` with ``format=jdbc`` writes through JDBC; url, user and
    password come from the options (never from code).  Without a target
    the table is saved in the session catalog.
    """
    if target and target.get("format") == "jdbc":
        opts = {k: v for k, v in target.items() if k != "format"}
        df.write.format("jdbc").options(dbtable=table, **opts).mode("overwrite").save()
    else:
        df.write.mode("overwrite").saveAsTable(table)
