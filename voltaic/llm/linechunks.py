"""Line dedup by content-defined line chunks, in DataFrame functions only.

A rolling hash over two line hashes runs along the lines with content. Where it
is a multiple of ``DIVISOR`` it chooses a chunk: the two lines and the blank
ones between them. Both ends of a chunk depend on its own lines alone, so
foreign text before or after moves no boundary; with a divisor of 1, every two
neighbours are a chunk, and a repeated passage of any length is covered by its
chunks whatever stands around it. A chunk that occurs more than once in the
corpus is removed everywhere but at its first occurrence (smallest key, then
position); hashes find candidates, and equality of the chunks' own text
decides. Chunks that go and touch are one span.

Only rows that share a chunk hash send their chunk text through a shuffle, and
copies of it combine before. Per-chunk rows carry numbers, counts are combined
before their shuffle, and the joins have a unique small side, so that a chunk
held by a third of all documents stays spread (adaptive skew join).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaic.llm.common import Scratch, cut

#: One in this many pairs of neighbouring lines is a chunk.
DIVISOR = 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for ``body``; lambdas inside see it as a variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _chunks(text: Column, divisor: int) -> Column:
    """Array of (start, n, hash) of the chunks of a text."""
    def pair(lines: Column, i: Column, j: Column) -> Column:
        line = lambda k: F.xxhash64(F.get(lines, k))
        return F.struct(i.alias("start"), (j - i + 1).alias("n"), F.xxhash64(line(i), line(j), j - i).alias("hash"))

    def full(lines: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.trim(F.get(lines, i)) != "")

    every = let(_lines(text), lambda lines: let(full(lines), lambda at: F.transform(F.slice(at, 2, F.size(at)), lambda j, k: pair(lines, F.get(at, k), j))))
    return every if divisor == 1 else F.filter(every, lambda c: F.pmod(c["hash"], F.lit(divisor)) == 0)


def _without(text: Column, drops: Column) -> Column:
    """The text without the line spans in ``drops``, sorted (start, n) structs."""
    def piece(lines: Column, i: Column) -> Column:
        start = F.coalesce(F.get(drops, i - 1)["start"] + F.get(drops, i - 1)["n"], F.lit(0))
        return F.slice(lines, start + 1, F.coalesce(F.get(drops, i)["start"], F.size(lines)) - start)

    return let(_lines(text), lambda lines: F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(drops)), lambda i: piece(lines, i))), "\n"))


def drop_repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with repeated multi-line chunks removed from ``text``.

    Returns all columns of ``docs``, whatever their names, and ``__left`` and
    ``__removed``, the number of lines kept and taken out (NULL and 0 for a
    NULL text). A NULL text stays NULL; an empty one stays empty; a text of
    which nothing is left is empty. Where a later occurrence overlaps the
    first one, the first stays whole. Rows that repeat both key and text count
    as one document, and all of them keep what it keeps; rows with one key and
    several texts are ordered by a hash of the text. A NULL key comes before
    all others. An empty table gives an empty result.
    """
    slim = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where("t is not null")
    slim = slim.withColumn("h", F.xxhash64("t"))
    spans = cut(slim.select("k", "h", F.inline(_chunks(F.col("t"), divisor))))
    # Cut, so that each join below has an exchange of its own on either side,
    # which the adaptive skew join can split at a hot chunk.
    repeated = cut(spans.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1").select("hash"))
    candidates = spans.join(repeated, "hash", "left_semi").groupBy("k", "h").agg(F.collect_set(F.struct("start", "n", "hash")).alias("spans"))
    same = lambda a, b: a["k"].eqNullSafe(b["k"]) & (a["h"] == b["h"])
    body = lambda lines, c: F.array_join(F.slice(lines, c["start"] + 1, c["n"]), "\n")
    found = slim.join(candidates, same(slim, candidates)).select(
        slim["k"], slim["h"], let(_lines(F.col("t")), lambda lines: F.transform("spans", lambda c: F.struct(c["start"].alias("start"), c["n"].alias("n"), c["hash"].alias("hash"), body(lines, c).alias("chunk")))).alias("spans")
    )
    scratch = Scratch(docs.sparkSession)
    found = scratch.table(found.select("k", "h", F.inline("spans")))
    first = F.min(F.struct("k", "h", "start", "n")).alias("first")
    # If the least and the greatest text of a hash are one, all its chunks are.
    known = scratch.table(found.groupBy("hash").agg(first, (F.min("chunk") == F.max("chunk")).alias("alike")))
    later = found.select("k", "h", "start", "n", "hash").join(known.where("alike").select("hash", "first"), "hash").drop("hash")
    mixed = known.where("not alike").select("hash")
    if not mixed.isEmpty():
        other = scratch.table(found.join(mixed, "hash", "left_semi").drop("hash"))
        later = later.unionByName(other.join(scratch.table(other.groupBy("chunk").agg(first)), "chunk").drop("chunk"))
    later = later.where(~F.struct("k", "h", "start").eqNullSafe(F.struct("first.k", "first.h", "first.start")))
    inside = F.col("k").eqNullSafe(F.col("first.k")) & (F.col("h") == F.col("first.h"))
    # The least and the last line of a chunk that go.
    low = F.when(inside, F.greatest("start", F.col("first.start") + F.col("first.n"))).otherwise(F.col("start"))
    later = later.select("k", "h", low.alias("a"), (F.col("start") + F.col("n")).alias("b")).where("a < b").distinct()
    order = Window.partitionBy("k", "h").orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("new", F.coalesce((F.col("a") > before).cast("int"), F.lit(0))).withColumn("island", F.sum("new").over(order))
    islands = later.groupBy("k", "h", "island").agg(F.min("a").alias("start"), (F.max("b") - F.min("a")).cast("int").alias("n"))
    drops = cut(islands.groupBy("k", "h").agg(F.array_sort(F.collect_list(F.struct("start", "n"))).alias("drops")))
    scratch.remove()
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    rows = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), quoted(key).alias("key"), quoted(text).alias("text"))
    joined = rows.join(drops, rows["key"].eqNullSafe(drops["k"]) & (F.xxhash64(rows["text"]) == drops["h"]), "left")
    cleaned = F.when(F.col("drops").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("drops")))
    removed = F.coalesce(F.aggregate("drops", F.lit(0), lambda n, d: n + d["n"]), F.lit(0)).cast("long")
    left = F.size(_lines(F.col("text"))) - removed
    return joined.select(
        *[(cleaned if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns], left.cast("long").alias("__left"), removed.alias("__removed")
    )


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the remaining ``text``, and the lines kept and removed."""
    out = drop_repeated_chunks(docs.select(key, text), key, text)
    return out.select(key, text, F.col("__left").alias("n_lines"), F.col("__removed").alias("n_removed"))


#: The same rule, for a divisor of 1, in DuckDB SQL.
ORACLE_SQL = """
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, ls, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM split),
filled AS (SELECT doc_id, ls, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM lines WHERE trim(line, ' ') <> ''),
chunks AS (SELECT doc_id, i, j, array_to_string(ls[i : j], chr(10)) AS chunk FROM filled WHERE j IS NOT NULL),
placed AS (
  SELECT doc_id, i, j, first(doc_id) OVER w AS first_doc, first(i) OVER w AS first_i, first(j) OVER w AS first_j
  FROM chunks WINDOW w AS (PARTITION BY chunk ORDER BY doc_id, i)),
drops AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = first_doc THEN greatest(i, first_j + 1) ELSE i END, j + 1)) AS i
  FROM placed WHERE doc_id <> first_doc OR i <> first_i),
marked AS (SELECT lines.doc_id, lines.line, lines.i, drops.i IS NOT NULL AS gone FROM lines LEFT JOIN drops ON lines.doc_id = drops.doc_id AND lines.i = drops.i),
kept AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text,
    count(*) FILTER (WHERE NOT gone) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
  FROM marked GROUP BY doc_id)
SELECT documents.doc_id, kept.text, kept.n_lines, coalesce(kept.n_removed, 0) AS n_removed
FROM documents LEFT JOIN kept ON documents.doc_id = kept.doc_id
"""
