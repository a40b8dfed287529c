"""Quality classifier: kernel ridge by random Fourier features, calibrated.

A text becomes a short vector of statistics. Random Fourier features turn it
into ``n_features`` cosines whose inner product approximates a Gaussian
kernel. Each partition sums its share of the normal equations, Spark adds the
shares, and the driver solves one small system for ridge weights. Isotonic
regression on a fold that the weights have not seen maps raw scores to
probabilities; it works on counts per score bin, so it takes every labelled
row and a bounded table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import chunks, cut, fold, per_text

#: Columns of the statistics vector, in order.
STATISTICS = [
    "log_words", "log_word_bytes", "symbols", "upper", "digits", "marks", "shouts",
    "distinct_words", "vocabulary_growth", "distinct_lines", "entropy", "log_longest_word",
]
N_FEATURES = 192
RIDGE = 1e-3
BINS = 4096
SEED = 20
#: Score from which a document counts as good.
THRESHOLD = 0.7

_CLASS = np.zeros((256, 5))
for _i, _chars in enumerate((b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?\"'()-", b"!")):
    _CLASS[list(_chars), _i] = 1


def statistics(text: str | None) -> np.ndarray:
    """The statistics vector of a whole text; zeros for NULL, empty or blank."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return np.zeros(len(STATISTICS))
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    distinct, sizes = len(set(words)), list(map(len, words))
    chars = sum(sizes)
    share = count[count > 0] / len(raw)
    return np.array([
        np.log1p(n), np.log1p(chars / n), *np.sqrt(count @ _CLASS / chars),
        distinct / n, np.log1p(distinct) / np.log1p(n), len(set(lines)) / len(lines),
        -(share * np.log2(share)).sum(), np.log1p(max(sizes)),
    ])


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``stats`` (array) of every row of ``docs``."""
    def run(texts):
        return [pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))]

    return per_text(docs, text, [key], "stats array<double>", run)


def isotonic(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the nearest non-decreasing sequence."""
    blocks: list[list[float]] = []
    for w, m in zip(weight, mean):
        blocks.append([w, m, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, n2 = blocks.pop()
            w1, m1, n1 = blocks.pop()
            blocks.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2])
    return np.repeat([b[1] for b in blocks], [int(b[2]) for b in blocks])


@dataclass
class Model:
    """Everything a score needs; about 25 kB at any input size."""

    centre: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        # Far outliers lie at the edge, so that they stay unlike the bulk but finite.
        z = np.clip((stats - self.centre) / self.scale, -8, 8)
        cosines = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([cosines, np.ones((len(z), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(stats):
            return np.zeros(0)
        return np.interp(self.raw(stats), self.knots, self.values)


def _matrix(column: pa.Array, width: int = len(STATISTICS)) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sum_rows(df: DataFrame, by: list[str]) -> DataFrame:
    """Element-wise sum of the array column ``row`` per group."""
    keys = [df.schema[c] for c in by]

    def add(table: pa.Table) -> pa.Table:
        rows = table.column("row").combine_chunks()
        total = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1).sum(0)
        return pa.table({**{c: table.column(c)[:1] for c in by}, "row": pa.array([total], pa.list_(pa.float64()))})

    schema = ", ".join(f"{k.name} {k.dataType.simpleString()}" for k in keys) + ", row array<double>"
    return df.groupBy(*by).applyInArrow(add, schema)


def fit(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", n_features: int = N_FEATURES, ridge: float = RIDGE) -> Model:
    """Fit on rows whose key has crc32 mod 4 other than 2.

    Remainders 0 and 1 fit the weights and 3 calibrates. A key with several
    labels has their mean; NULL labels and keys without a text teach nothing.
    Without labelled rows every score is 0.5.
    """
    d = len(STATISTICS)
    scales = stats.agg(*[f(F.get("stats", F.lit(i))) for i in range(d) for f in (F.avg, F.stddev_pop)]).first()
    pairs = np.array([0.0 if x is None else x for x in scales]).reshape(d, 2)
    rng = np.random.default_rng(SEED)
    model = Model(
        pairs[:, 0], np.maximum(pairs[:, 1], 1e-6), rng.normal(0, 1 / np.sqrt(d), (d, n_features)), rng.uniform(0, 2 * np.pi, n_features),
        np.zeros(n_features + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]),
    )
    learn = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (fold(key, 4) != 2)).groupBy(key).agg(F.avg(label).alias("y"))
    rows = cut(stats.join(learn, key).select(fold(key, 4).alias("fold"), "y", "stats"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_features + 1, n_features + 2))
        for batch in batches:
            z = model.features(_matrix(batch.column(1)))
            total += z.T @ np.concatenate([z, batch.column(0).to_numpy()[:, None]], axis=1)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    partial = rows.where("fold <> 3").select("y", "stats").mapInArrow(sums, "i int, row array<double>")
    partial = _sum_rows(partial.withColumn("part", F.spark_partition_id() % 32), ["i", "part"])
    solved = _sum_rows(partial.select("i", "row"), ["i"]).collect()
    if not solved:
        return model
    total = np.zeros((n_features + 1, n_features + 2))
    for r in solved:
        total[r.i] = r.row
    a, b = total[:, :-1], total[:, -1]
    penalty = np.diag([ridge * a[-1, -1]] * n_features + [1e-9])
    model.weights = np.linalg.solve(a + penalty, b)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.raw(_matrix(batch.column(1)))
            at = np.clip(((s + 1) / 3 * BINS).astype(np.int64), 0, BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(0)], names=["bin", "y"])

    bins = rows.where("fold = 3").select("y", "stats").mapInArrow(raw, "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect()
    if bins:
        model.knots = np.array([(r.bin + 0.5) / BINS * 3 - 1 for r in bins])
        model.values = np.clip(isotonic(np.array([r.n for r in bins]), np.array([r.y for r in bins])), 0, 1)
    else:
        model.values = np.array([0.0, 1.0])
    return model


def score_statistics(stats: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` of a table of statistics vectors."""
    key_type = stats.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], names=[key, "score"])

    return stats.select(key, "stats").mapInArrow(run, f"`{key}` {key_type}, score double")


def text_score(text: Column, model: Model) -> Column:
    """The score of a text column; only the text reaches Python."""
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = chunks([pa.RecordBatch.from_arrays([batch], names=["text"])])
            own = [model.score(np.array([statistics(t) for t in p.column(0).to_pylist()])) for p in parts]
            yield pa.array(np.concatenate(own) if own else [], pa.float64())

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "double")(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Score every document by a model fitted to the labelled ones.

    Returns ``key``, ``held_out`` (crc32 of the key mod 4 is 2), ``score``
    (probability that the label is 1) and ``predicted`` (1 from a score of
    0.7). One row per input row; a NULL key is never held out; NULL and empty
    texts are scored by their zero vector; an empty table gives an empty
    result; other columns are ignored. Only the text enters a score.
    """
    stats = cut(document_statistics(docs, key, text))
    scored = score_statistics(stats, fit(stats, labels, key, label), key)
    return scored.select(key, (fold(key, 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their columns.

    Statistics are gathered once for the fit and once beside the row that they
    judge, which costs less than a shuffle of whole texts; all columns but the
    text stay out of Python, whatever their names and types.
    """
    stats = cut(document_statistics(docs, key, text))
    model = fit(stats, labels, key, label)
    return docs.where(text_score(F.col(f"`{text}`"), model) >= THRESHOLD)
