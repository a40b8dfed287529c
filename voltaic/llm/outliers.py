"""Quality rules: base rules, then robust multivariate outliers.

Each text gives a few counts. Two base rules fail texts outright. The others
become a transformed vector (``transformed``), and a minimum covariance
determinant (MCD) estimate per language and source says how far the vector
lies from the bulk of its group: a squared Mahalanobis distance beyond the
``CUTOFF`` quantile of chi-square rejects the text.

The estimate follows the nested scheme for large samples. Every group is dealt
into blocks of bounded size, each block finds its own h-subset by
concentration steps, the block estimates are averaged, and full concentration
steps over all rows of the group refine the average. Sizes and estimates meet
their group's rows in slices. So no group, however large, meets in one task,
and every row takes part.

Estimates add the unit matrix to a covariance. ``judge`` first puts every axis
in units in which that floor is ``RIDGE`` of the axis's robust variance over
all rows, so a group's own covariance sets the distance. An axis without
robust variance (most texts have no symbols or repeats) keeps the unit of
``transformed``, and the floor is its spread.

A group of fewer than ``MIN_GROUP`` rows uses the estimate of its language,
and a language of fewer rows the estimate of all rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import cut, per_text

#: Fixed values of the base rules.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: Share of a group's rows in the h-subset, rows of a block, least rows of a
#: group with an estimate of its own, and concentration steps over all rows.
SUPPORT = 0.75
BLOCK = 2000
MIN_GROUP = 100
STEPS = 2
#: Slices in which the rows of a group meet its one row of sizes or estimates.
SLICES = 256
#: Share of an axis's robust variance over all rows that the unit floor is.
RIDGE = 0.01
#: Chi-square quantile beyond which a vector is an outlier.
CUTOFF = 0.9999
DIM = 4
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of ``window`` words that occurs again in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    h = np.zeros(n, np.uint64)
    for i in range(window):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + n]
    order = np.sort(h)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(h, twice))
    # Equal hashes propose; the words themselves decide.
    rows = ids[at[:, None] + np.arange(window)]
    _, back, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    at = at[times[back.ravel()] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    edge[at] += 1
    edge[at + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """The values of ``COUNTS`` for a whole text; NULL counts as empty."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    blanks = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
    symbols = sum(raw.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words)


def document_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the counts, prefixed with ``__`` so that no name clashes."""
    def run(texts):
        columns = zip(*[counts(t) for t in texts])
        return [pa.array(c, pa.int64()) for c in columns]

    return per_text(docs, text, keep, ", ".join(f"__{c} long" for c in COUNTS), run)


def transformed() -> list[Column]:
    """The vector, each part in units of a spread that clean texts have anyway.

    Shares are drawn towards a common value in short texts, where they vary
    by chance: log mean word length, log symbols per hundred words, share of
    words in repeated windows, share of lines that repeat (per 60 characters).
    """
    c = {x: F.col(f"__{x}").cast("double") for x in COUNTS}
    return [
        F.log((c["word_chars"] + 500) / (c["n_words"] + 100)) / 0.08,
        F.log1p(100 * c["n_symbols"] / (c["n_words"] + 20)) / 0.7,
        c["n_repeat_words"] / (c["n_words"] + 50) / 0.12,
        F.log1p(c["n_dup_lines"] * 60 / (c["word_chars"] + 600)) / 0.15,
    ]


def chi2_cdf(x: float, k: int) -> float:
    """Distribution function of chi-square for an even number of freedoms."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(k // 2))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1.0
    while chi2_cdf(high, k) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def inflation(support: float = SUPPORT, k: int = DIM) -> float:
    """Factor that makes the covariance of the inner share consistent at the normal."""
    return support / chi2_cdf(chi2_quantile(support, k), k + 2)


def block_mcd(x: np.ndarray, support: float = SUPPORT) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance (plus unit floor) of the best h-subset of one block.

    Concentration steps from two deterministic starts, the rows nearest to
    the median by scaled and by plain distance; the smaller determinant wins.
    """
    n = len(x)
    h = max(1, math.ceil(support * n))
    centre = np.median(x, axis=0)
    mad = np.median(abs(x - centre), axis=0) * 1.4826
    best = None
    for scale in (np.maximum(mad, 1e-3), np.ones(x.shape[1])):
        d = (((x - centre) / scale) ** 2).sum(1)
        value = np.inf
        for _ in range(30):
            own = x[d <= np.partition(d, h - 1)[h - 1]]
            mean = own.mean(0)
            cov = (own - mean).T @ (own - mean) / len(own) * inflation(support) + np.eye(x.shape[1])
            det = np.linalg.slogdet(cov)[1]
            if det >= value - 1e-9:
                break
            value = det
            d = (((x - mean) @ np.linalg.inv(cov)) * (x - mean)).sum(1)
        if best is None or det < best[0]:
            best = det, mean, cov
    return best[1], best[2]


def _levels(lang: str, source: str) -> list[Column]:
    """Keys of a row's groups, finest first; NULL is a language or source like others."""
    name = lambda *c: F.to_json(F.struct(*[F.col(f"`{x}`").cast("string").alias(str(i)) for i, x in enumerate(c)]))
    return [F.concat(F.lit("2"), name(lang, source)), F.concat(F.lit("1"), name(lang)), F.lit("0")]


_X = [f"x{i}" for i in range(DIM)]
_MEAN = [f"m{i}" for i in range(DIM)]
_PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]
_INVERSE = [f"s{i}{j}" for i, j in _PAIRS]
_ESTIMATE = ", ".join(f"{c} double" for c in [*_MEAN, *_INVERSE])


def _distance() -> Column:
    """Squared Mahalanobis distance of x under the estimate beside it."""
    d = [F.col(x) - F.col(m) for x, m in zip(_X, _MEAN)]
    return sum((d[i] * d[j] * F.col(s) * (1 if i == j else 2) for (i, j), s in zip(_PAIRS, _INVERSE)), F.lit(0.0))


def _inverse(frame: pd.DataFrame, cov: np.ndarray) -> pd.DataFrame:
    inv = np.linalg.inv(cov)
    return frame.assign(**{s: inv[:, i, j] for (i, j), s in zip(_PAIRS, _INVERSE)})


def _square(frame: pd.DataFrame, names: list[str]) -> np.ndarray:
    out = np.zeros((len(frame), DIM, DIM))
    for (i, j), c in zip(_PAIRS, names):
        out[:, i, j] = out[:, j, i] = frame[c].to_numpy()
    return out


def beside(rows: DataFrame, groups: DataFrame, on: str, spread: Column, how: str = "inner") -> DataFrame:
    """``rows`` with the row of their group, ``groups`` having one row per group.

    A group may hold all rows, so its row is repeated for every slice, and
    rows meet it by group and slice (from the long column ``spread``).
    """
    sliced = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    own = rows.withColumn("slice", F.pmod(spread, F.lit(SLICES)).cast("int"))
    return own.join(sliced, [on, "slice"], how).drop("slice")


def estimates(rows: DataFrame, min_group: int = MIN_GROUP, block: int = BLOCK, steps: int = STEPS) -> DataFrame:
    """MCD estimate of each group: ``g``, mean and inverse covariance columns.

    ``rows`` has ``levels`` (array of group keys), ``id`` (any hashable
    column that spreads rows) and the vector ``x0``...
    """
    # Rows without an id may be alike, so these are told apart as they are read.
    hashed = F.xxhash64("id", *_X, F.when(F.col("id").isNull(), F.monotonically_increasing_id()))
    long = rows.withColumn("h", F.pmod(hashed, F.lit(1 << 30))).select(F.explode("levels").alias("g"), "h", *_X)
    sizes = cut(long.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") >= min_group))
    # Slices take other bits of the hash than blocks do.
    spread = F.shiftright("h", 20)
    dealt = beside(long, sizes, "g", spread).withColumn("block", F.col("h") % F.ceil(F.col("n") / block))

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        mean, cov = block_mcd(frame[_X].to_numpy())
        return pd.DataFrame([[key[0], *mean, *[cov[i, j] for i, j in _PAIRS]]], columns=["g", *_MEAN, *_INVERSE])

    blocks = dealt.select("g", "block", *_X).groupBy("g", "block").applyInPandas(one, f"g string, {_ESTIMATE}")
    start = blocks.groupBy("g").agg(*[F.avg(c).alias(c) for c in [*_MEAN, *_INVERSE]])

    def invert(frames):
        for f in frames:
            yield _inverse(f, _square(f, _INVERSE))

    def moments(frames):
        for f in frames:
            mean = f[_MEAN].to_numpy()
            cov = _square(f, _INVERSE) - mean[:, :, None] * mean[:, None, :]
            yield _inverse(f, cov * inflation() + np.eye(DIM))

    now = cut(start.mapInPandas(invert, f"g string, {_ESTIMATE}"))
    for _ in range(steps):
        far = beside(long, now, "g", spread).select("g", "h", *_X, _distance().alias("d"))
        edge = far.groupBy("g").agg(F.percentile_approx("d", F.lit(SUPPORT), F.lit(10000)).alias("edge"))
        near = beside(far, edge, "g", spread).where("d <= edge")
        sums = near.groupBy("g").agg(*[F.avg(x).alias(m) for x, m in zip(_X, _MEAN)], *[F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(s) for (i, j), s in zip(_PAIRS, _INVERSE)])
        now = cut(sums.mapInPandas(moments, f"g string, {_ESTIMATE}"))
    return now


def floor_units(rows: DataFrame, ridge: float = RIDGE) -> list[float]:
    """Unit of each axis in which the unit floor is ``ridge`` of its robust
    variance (by quartiles); 1 where the quartiles are equal or no row exists."""
    found = rows.agg(*[F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.75)), F.lit(10000)).alias(x) for x in _X]).first()
    spreads = [(found[x][1] - found[x][0]) / 1.349 if found[x] else 0.0 for x in _X]
    return [math.sqrt(ridge) * s if s > 0 else 1.0 for s in spreads]


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """Counts and verdict of every text.

    Returns ``key``, the counts, ``base_failed``, ``kept`` and ``distance``
    (squared, in the group's estimate; NULL for texts that a base rule
    fails). Texts that a base rule fails take no part in estimates. A NULL or
    empty text has no words and fails; a NULL language or source is a group
    value of its own; repeated rows each count and each get a verdict. If
    even all rows together are fewer than ``min_group``, no estimate exists
    and the base rules alone decide. An empty table gives an empty result.
    """
    out = {c: F.col(f"__{c}") for c in COUNTS}
    failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    keyed = docs.select(F.col(f"`{key}`").alias("__key"), F.array(*_levels(lang, source)).alias("__levels"), F.col(f"`{text}`").alias("__body"))
    stats = document_counts(keyed, ["__key", "__levels"], "__body")
    stats = cut(stats.select("*", failed.alias("failed"), *[t.alias(x) for t, x in zip(transformed(), _X)]))
    units = floor_units(stats.where(~F.col("failed")))
    stats = stats.withColumns({x: F.col(x) / u for x, u in zip(_X, units)})
    rows = stats.where(~F.col("failed")).select(F.col("__levels").alias("levels"), F.col("__key").alias("id"), *_X)
    estimate = estimates(rows, min_group)
    # Which estimate each group of the finest level uses; one row per group.
    groups = stats.select("__levels").distinct().select("__levels", F.posexplode("__levels").alias("level", "g"))
    chosen = beside(groups, estimate, "g", F.xxhash64("__levels")).groupBy("__levels").agg(F.min_by(F.struct(*_MEAN, *_INVERSE), "level").alias("e")).select("__levels", "e.*")
    judged = beside(stats, cut(chosen), "__levels", F.xxhash64("__key", *_X), "left").withColumn("d", F.when(~F.col("failed"), _distance()))
    fine = F.coalesce(F.col("d") <= chi2_quantile(CUTOFF, DIM), F.lit(True))
    return judged.select(
        F.col("__key").alias(key), *[out[c].alias(c) for c in COUNTS], F.col("failed").alias("base_failed"), (~F.col("failed") & fine).alias("kept"), F.col("d").alias("distance")
    )
