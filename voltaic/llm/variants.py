"""Spelling variants by a dictionary of trie-node pairs.

The nodes of the trie of all words, and of the trie of all reversed words, are
numbered. A word without its i-th code point is then a pair of integers: the
node of its first i code points and the reversed node of what follows the
skipped one. Two words differ by one replaced code point if and only if they
have such a pair in common. A word split in two without a skip is a pair too,
and it meets the skipped pairs of exactly those words that have one code point
more. Integer joins thus give exact neighbours, and no pair of words is ever
compared.

Words with one skipped pair differ in one code point, so a pair has at most as
many words as the alphabet has code points, whatever the size of the corpus.
Each pair sends on a count and the best neighbour of each of its words, never
the links themselves.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import Scratch, chunks, cut

#: Letters of a run, code points and occurrences of a word, the
#: divisor of the hash that marks a misspelling, and how much more often the
#: form of a word occurs.
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_CHARS = 5
LEAST_COUNT = 3
DIVISOR = 97
RATIO = 2
#: Distinct words that a task counts before it sends them on.
HELD = 100_000

_RUN = re.compile(RUN)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of (key, text) rows with the number of their occurrences."""
    held: Counter = Counter()
    emit = lambda: pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
    for part in chunks(batches, "text"):
        for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            start = zlib.crc32(f"{key}:".encode())
            # bytes.lower changes A-Z only.
            for run, n in Counter(_RUN.findall((text or "").encode().lower().decode())).items():
                h = zlib.crc32(run.encode(), start)
                if h % DIVISOR == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                if len(run) >= LEAST_CHARS:
                    held[run] += n
            if len(held) >= HELD:
                yield emit()
                held.clear()
    if held:
        yield emit()


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """Distinct words of whole texts with their occurrences ``n`` (``least`` or more)."""
    slim = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return slim.mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def number_nodes(words: Iterator[str], depth: int, shard: int) -> Iterator[list[int]]:
    """Numbers of the trie nodes from the root to each of the sorted ``words``.

    Nodes up to ``depth`` are numbered by their code points, which every task
    does alike; deeper ones are counted per shard. Words that share ``depth``
    code points must be in one shard.
    """
    before, path, count = "", [0], 0
    for word in words:
        same = 0
        while same < min(len(word), len(before)) and word[same] == before[same]:
            same += 1
        del path[same + 1 :]
        for i in range(same, len(word)):
            if i < depth:
                path.append(path[i] << 8 | ord(word[i]))
            else:
                count += 1
                path.append(1 << 62 | shard << 40 | count)
        before = word
        yield list(path)


def _numbered(words: DataFrame, word: str, depth: int, out: str) -> DataFrame:
    """``words`` with the array ``out`` of node numbers along ``word``."""
    def run(batches):
        shard, columns = TaskContext.get().partitionId(), None
        held: list = []

        def stream():
            for batch in batches:
                for part in chunks(iter([batch]), "word"):
                    for row in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()):
                        held.append(row)
                        yield row[1]

        ready = []
        for path in number_nodes(stream(), depth, shard):
            ready.append((held.pop(0)[::2], path))
            if len(ready) == 4096:
                yield emit(ready)
                ready = []
        if ready:
            yield emit(ready)

    def emit(ready):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r, _ in ready], pa.string()), pa.array([r[1] for r, _ in ready], pa.int64()), pa.array([p for _, p in ready], pa.list_(pa.int64()))], names=["own", "n", out])

    dealt = words.select(F.col("word").alias("own"), F.col(word).alias("word"), "n").repartition(F.substring(word, 1, depth)).sortWithinPartitions("word")
    return dealt.mapInArrow(run, f"own string, n long, {out} array<long>")


def trie_pairs(words: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """The node pairs of words (``word``, ``n``; distinct): ``p``, ``s``, ``word``,
    ``n``, ``skip`` (whether a code point is left out) and ``once``.

    Leaving out either of two equal neighbours gives one text; ``once`` marks
    the first of them, and every pair without a skip.
    """
    depth = min(least, 5)
    reverse = words.withColumn("turned", F.reverse("word"))
    both = cut(_numbered(words, "word", depth, "heads")).join(cut(_numbered(reverse, "turned", depth, "tails")).drop("n"), "own")
    size = F.length("own")
    skips = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("heads", i).alias("p"), F.get("tails", size - 1 - i).alias("s"), F.lit(True).alias("skip"),
        ((i == 0) | (F.substring("own", i + 1, F.lit(1)) != F.substring("own", i, F.lit(1)))).alias("once")))
    splits = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("heads", i).alias("p"), F.get("tails", size - i).alias("s"), F.lit(False).alias("skip"), F.lit(True).alias("once")))
    return both.select(F.col("own").alias("word"), "n", F.inline(F.concat(skips, splits))).select("p", "s", "word", "n", "skip", "once")


def neighbours(words: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """For each of ``words`` with a near one: ``near``, their number, and the
    largest (``best_n``, ``best``; of equal ones the first in code-point order)."""
    scratch = Scratch(words.sparkSession)
    pairs = scratch.table(trie_pairs(words, least))
    # A pair of node numbers has at most one unskipped word, and at most one
    # skipped word for each code point.
    met = pairs.groupBy("p", "s").agg(F.collect_list(F.when(F.col("skip"), F.struct((-F.col("n")).alias("m"), "word", "once"))).alias("skips"), F.max(F.when(~F.col("skip"), F.struct((-F.col("n")).alias("m"), "word"))).alias("whole"))
    met = met.where((F.size("skips") > 1) | ((F.size("skips") > 0) & F.col("whole").isNotNull()))
    met = met.withColumn("skips", F.array_sort("skips")).select(
        "whole", "skips", F.filter("skips", lambda x: x["once"]).alias("longer"))
    bare = lambda x: F.struct(x["m"].alias("m"), x["word"].alias("word"))

    def of_skip(x):
        others = F.size("skips") - 1
        first, second = F.get("skips", F.lit(0)), F.get("skips", F.lit(1))
        mate = F.when(others > 0, F.when(first["word"] == x["word"], bare(second)).otherwise(bare(first)))
        shorter = F.when(x["once"], F.col("whole"))
        return F.struct(x["word"].alias("word"), (others + F.when(shorter.isNotNull(), 1).otherwise(0)).cast("long").alias("near"), F.least(mate, shorter).alias("best"))

    of_whole = F.when(F.col("whole").isNotNull(), F.array(F.struct(F.col("whole.word").alias("word"), F.size("longer").cast("long").alias("near"), F.when(F.size("longer") > 0, bare(F.get("longer", F.lit(0)))).alias("best")))).otherwise(F.array())
    found = met.select(F.inline(F.concat(F.transform("skips", of_skip), of_whole))).where("near > 0")
    out = found.groupBy("word").agg(F.sum("near").alias("near"), F.min("best").alias("best"))
    out = cut(out.select("word", "near", (-F.col("best.m")).alias("best_n"), F.col("best.word").alias("best")))
    scratch.remove()
    return out


def follow(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of the chain of ``form`` from each word.

    A form occurs at least twice as often as its word, so chains have no
    cycle and their length is a logarithm of the counts; each round doubles
    the steps taken.
    """
    now = cut(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(now.join(ahead, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        now = moved.select("word", "root")
        if not moved.agg(F.max("moved")).first()[0]:
            return now


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """Words of whole texts with the more frequent spelling that each varies.

    Returns ``word``, ``n``, ``n_near`` (words one inserted, deleted or
    replaced code point away), ``form`` (the near word of largest n, if that
    is ``ratio`` times the word's or more; ties: smallest in code-point order;
    else NULL), ``form_n`` (its n) and ``root`` (the last of the chain of
    forms; the word itself without one).

    Words are runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z in lower
    case; one run in ``DIVISOR`` loses a code point, by a hash of key and run.
    A NULL text has no words; a NULL key counts as the empty text. Repeated
    rows count as often as they occur; a run of any length is a word. Without
    words, as for an empty table, the result is empty. Other columns are
    ignored, whatever their names.
    """
    words = cut(count_words(docs, key, text, least_count))
    known = words.join(neighbours(words), "word", "left")
    keeps = F.col("best_n") >= ratio * F.col("n")
    known = cut(known.select("word", "n", F.when(keeps, F.col("best")).alias("form"), F.coalesce("near", F.lit(0)).alias("n_near"), F.when(keeps, F.col("best_n")).alias("form_n")))
    return known.join(follow(known), "word").select("word", "form", "root", "n", "n_near", "form_n")


def _crc32(text: str) -> str:
    """The unsigned crc32 of the UTF-8 bytes of a text in DuckDB SQL."""
    step = "list_reduce(list_prepend(xor(crc, b), [1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[]), lambda v, u: xor(v >> 1, 3988292384 * (v & 1)))"
    codes = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i - 1 AS INT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda crc, b: {step}), 4294967295::BIGINT)"


ORACLE_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{RUN}')) AS run FROM documents),
hashed AS (SELECT run, sum(m) AS m, h FROM (SELECT run, m, {_crc32("k || ':' || run")} AS h FROM (SELECT k, run, count(*) AS m FROM runs WHERE length(run) >= {LEAST_CHARS} GROUP BY k, run)) GROUP BY run, h),
spelled AS (SELECT CASE WHEN h % {DIVISOR} = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, m FROM hashed),
words AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM spelled WHERE length(word) >= {LEAST_CHARS} GROUP BY word HAVING sum(m) >= {LEAST_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
skips AS (SELECT word, n, i, substr(word, 1, CAST(i AS INT) - 1) AS a, substr(word, CAST(i AS INT) + 1) AS b FROM places),
shorter AS (SELECT DISTINCT word, n, a || b AS other FROM skips),
links AS (
  SELECT x.word, x.n, y.word AS near, y.n AS m FROM skips AS x JOIN skips AS y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT shorter.word, shorter.n, words.word, words.n FROM shorter JOIN words ON words.word = shorter.other
  UNION ALL SELECT words.word, words.n, shorter.word, shorter.n FROM shorter JOIN words ON words.word = shorter.other),
best AS (SELECT word, n, near, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, near) AS k FROM links),
known AS (
  SELECT words.word, words.n, coalesce(best.n_near, 0) AS n_near, CASE WHEN m >= {RATIO} * words.n THEN near END AS form, CASE WHEN m >= {RATIO} * words.n THEN m END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word AND best.k = 1),
chain AS (SELECT word, word AS here, 0 AS step FROM known UNION ALL SELECT chain.word, known.form, step + 1 FROM chain JOIN known ON known.word = chain.here WHERE known.form IS NOT NULL),
roots AS (SELECT word, arg_max(here, step) AS root FROM chain GROUP BY word)
SELECT known.word, form, root, n, n_near, form_n FROM known JOIN roots ON roots.word = known.word
"""
