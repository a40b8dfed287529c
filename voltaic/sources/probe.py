"""What files are there, and what do their first lines say.

Both are Spark jobs over the file list: the listing reads no byte of a file,
and the heads read the first lines of each file on the executors and stop.
"""

from __future__ import annotations

from typing import Callable, Iterable, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config

# A file is a task of its own in the probe: opening one counts as this many
# bytes, as does a whole partition, so no two files share a partition and no
# file is cut into several.
_WHOLE_FILE = str(1 << 50)
# Lines of a file that reach Python at one time, and those a probe looks at.
BATCH_LINES = 64
HEAD_LINES = 2048
# Below this many files, (path, header) rows are certainly small: a path and a
# header take some hundred bytes.
FEW_FILES = 10_000


def listing(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path``, ``length`` and ``modified`` of every file below ``paths``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    m = "_metadata."
    return files.select(F.col(m + "file_path").alias("path"), F.col(m + "file_size").alias("length"),
                        F.col(m + "file_modification_time").alias("modified"))


def heads(spark: SparkSession, paths: str | Sequence[str], find: Callable[[Iterable[str]], str | None]) -> DataFrame:
    """``path`` and ``head``, what ``find`` takes from the first lines of each
    file that is not empty (NULL: nothing).

    ``find`` is handed the lines one by one, at most ``HEAD_LINES``; once it
    returns, nothing more of the file is read, however long it is.
    """
    own = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, _WHOLE_FILE)
    lines = (own.read.option("recursiveFileLookup", True).text(paths)
             .select(F.col("_metadata.file_path").alias("path"), "value"))

    def first(batches):
        path = None

        def some():
            nonlocal path
            seen = 0
            for batch in batches:
                for start in range(0, batch.num_rows, BATCH_LINES):
                    part = batch.slice(start, BATCH_LINES)
                    path = part.column(0)[0].as_py()
                    yield from part.column(1).to_pylist()
                    seen += part.num_rows
                    if seen >= HEAD_LINES:
                        return

        head = find(some())
        if path is not None:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([head], pa.string())], names=["path", "head"])

    return lines.mapInArrow(first, "path string, head string")


def path_part(path: Column, name: str) -> Column:
    """The value of a ``name=value`` folder in a path, NULL without one."""
    value = F.regexp_extract(path, f"/{name}=([^/]+)/", 1)
    return F.when(value != "", F.url_decode(value))


def series_in(spark: SparkSession, paths: str | Sequence[str], marks: Callable[[str], Sequence[str]] | None = None) -> list[str]:
    """The series (regions) that the files carry, in a folder of their path or
    in their text: ``marks(name)`` lists texts (blanks do not count, and a line
    ends in a comma) of which a file that has the series holds one in its
    first lines."""
    names = list(config.SERIES)
    shown = [F.coalesce(F.bool_or(path_part(F.col("path"), n).isNotNull()), F.lit(False)).alias(f"p{i}") for i, n in enumerate(names)]
    row = listing(spark, paths).agg(*shown).first()
    found = {n for i, n in enumerate(names) if row[i]}
    for name in names:
        if marks is None or name in found:
            continue
        texts = [t.lower() for t in marks(name)]
        find = lambda lines, texts=texts: next((t for line in lines for t in texts if t in line.lower().replace(" ", "") + ","), None)
        if not heads(spark, paths, find).where("head is not null").isEmpty():
            found.add(name)
    return [n for n in names if n in found]


def plain_path(path: str) -> str:
    """A path of the listing as a reader takes it: decoded, and without glob
    characters taken for patterns."""
    out = unquote(path)
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in out)
