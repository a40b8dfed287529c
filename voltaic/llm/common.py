"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text that a Python task holds as objects at one time, and the
#: UTF-8 bytes after which a chunk is closed early.
CHUNK_ROWS = 256
CHUNK_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; NULL keys count as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session that sets none gets a scratch folder; elsewhere a
    missing folder is an error, since executors cannot see each other's disks.
    """
    sc = spark.sparkContext
    shared = sc.getCheckpointDir()
    if shared is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if sc.master.split("[")[0] != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="voltaic-checkpoint-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Parquet tables in the shared folder, for wide rows, that cut lineage.

    ``remove`` deletes those that nothing reads any more; what a returned
    DataFrame still reads stays until the folder is cleaned.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.tables = spark, []

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{shared_folder(self.spark)}/table-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.tables.append(path)
        return self.spark.read.parquet(path)

    def remove(self, keep: int = 0) -> None:
        """Delete the tables, but for the ``keep`` last written."""
        old, self.tables = self.tables[: len(self.tables) - keep], self.tables[len(self.tables) - keep :]
        for path in old:
            target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of bounded rows and bounded text bytes.

    A row longer than ``CHUNK_BYTES`` is a slice of its own; no text is cut.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(sizes):
            if i > start and (i - start >= CHUNK_ROWS or size + n > CHUNK_BYTES):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(sizes):
            yield batch.slice(start, len(sizes) - start)


def per_text(df: DataFrame, text: str, keep: list[str], out: str, fn: Callable[[list], list[pa.Array]]) -> DataFrame:
    """Apply ``fn`` to every text; only the named columns reach Python.

    ``fn`` takes a list of texts (None for NULL) and returns one Arrow array
    for each column of the DDL string ``out``. The result has the ``keep``
    columns and then those of ``out``; other columns of ``df`` are not read,
    so names that clash with ``out`` do no harm.
    """
    source = df.select(*[F.col(f"`{k}`") for k in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    fields = [source.schema[k] for k in keep]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], out])

    names = [*keep, *[part.split()[0].strip("`") for part in _split_ddl(out)]]

    def run(batches):
        for part in chunks(batches, "__text"):
            arrays = [part.column(i) for i in range(len(keep))] + fn(part.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, schema)


def _split_ddl(ddl: str) -> list[str]:
    """Split a DDL string at its top-level commas."""
    parts, depth, now = [], 0, ""
    for c in ddl:
        depth += (c in "<(") - (c in ">)")
        if c == "," and depth == 0:
            parts.append(now)
            now = ""
        else:
            now += c
    return [p for p in [*parts, now] if p.strip()]
