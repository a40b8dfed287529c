"""Language identification by a small convolutional network over bytes.

Filters of several widths slide over byte embeddings; each keeps its maximum
over a window of ``WINDOW`` bytes, and a softmax over the maxima names the
language. Training (numpy, Adam) happens on the driver on a bounded sample of
labelled windows. Prediction covers every whole text in consecutive windows:
since inputs are bytes, embedding times filter is a table per byte or byte
pair, so a window costs table look-ups, sums and a maximum.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import fold, per_text

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
#: The sample that trains: documents per language (in expectation), windows of
#: a document, and languages. More languages than this are an error.
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 4
MAX_LANGUAGES = 1000
EPOCHS = 6
BATCH = 64
SEED = 7
#: Windows that are held at one time in prediction.
WINDOWS = 64
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def windows(text: str) -> np.ndarray:
    """The lower-cased UTF-8 bytes in rows of WINDOW bytes, the last padded.

    Rows overlap by the widest filter less one, so no byte group is missed.
    """
    raw = text.lower().encode()
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(raw) - max(WIDTHS) + 1) // step))
    buffer = np.full(n * step + max(WIDTHS) - 1, 32, np.uint8)
    buffer[: len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.as_strided(buffer, (n, WINDOW), (step, 1))


@dataclass
class Network:
    """Parameters; about 10 kB for a few languages."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    _tables: list | None = field(default=None, repr=False)

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> Network:
        return cls(
            languages,
            rng.normal(0, 0.5, (256, EMBEDDING)),
            [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS)) for w in WIDTHS],
            np.zeros(FILTERS * len(WIDTHS)),
            rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))),
            np.zeros(len(languages)),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.weights, self.offset]

    def __getstate__(self):
        return self.__dict__ | {"_tables": None}

    # ---- training --------------------------------------------------------
    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Cross entropy of a batch of windows and the gradient of each parameter."""
        n = len(x)
        rows = np.arange(n)[:, None]
        by_position = np.ascontiguousarray(x.T)
        best, at = [], []
        for w, f in zip(WIDTHS, self.filters):
            size = WINDOW - w + 1
            table = np.einsum("be,wef->wbf", self.embedding, f)
            a = sum(np.take(table[k], by_position[k : k + size], axis=0) for k in range(w))
            best.append(a.max(0))
            at.append((a == best[-1]).argmax(0))
        z = np.concatenate(best, axis=1) + self.bias
        h = np.maximum(z, 0)
        p = softmax(h @ self.weights + self.offset)
        loss = -np.log(p[np.arange(n), y] + 1e-12).mean()
        d = p
        d[np.arange(n), y] -= 1
        d /= n
        g_weights, g_offset = h.T @ d, d.sum(0)
        d = (d @ self.weights.T) * (z > 0)
        g_bias = d.sum(0)
        g_embedding, g_filters = np.zeros_like(self.embedding), []
        for i, (w, f) in enumerate(zip(WIDTHS, self.filters)):
            own = d[:, i * FILTERS : (i + 1) * FILTERS]
            g = np.zeros((w, 256, FILTERS))
            for k in range(w):
                np.add.at(g[k], (x[rows, at[i] + k], np.arange(FILTERS)[None, :]), own)
            g_embedding += np.einsum("wbf,wef->be", g, f)
            g_filters.append(np.einsum("wbf,be->wef", g, self.embedding))
        return loss, [g_embedding, *g_filters, g_bias, g_weights, g_offset]

    # ---- prediction ------------------------------------------------------
    def tables(self) -> list:
        """Per width, look-up tables of byte pairs and single bytes."""
        if self._tables is None:
            self._tables = []
            for w, f in zip(WIDTHS, self.filters):
                single = np.einsum("be,wef->wbf", self.embedding, f).astype(np.float32)
                parts = [(k, (single[k][:, None] + single[k + 1][None]).reshape(-1, FILTERS)) for k in range(0, w - 1, 2)]
                self._tables.append((parts, single[w - 1] if w % 2 else None))
        return self._tables

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Log probability of each language for each window."""
        # Positions lead, so that the maximum runs over whole rows.
        x = np.ascontiguousarray(x.T)
        pair = x[:-1].astype(np.intp) * 256 + x[1:]
        best = []
        for w, (parts, last) in zip(WIDTHS, self.tables()):
            size = WINDOW - w + 1
            a = None
            for k, table in parts:
                b = np.take(table, pair[k : k + size], axis=0)
                a = b if a is None else np.add(a, b, out=a)
            if last is not None:
                a += np.take(last, x[w - 1 :], axis=0)
            best.append(a.max(0))
        h = np.maximum(np.concatenate(best, axis=1) + self.bias, 0)
        return np.log(softmax(h @ self.weights + self.offset) + 1e-9)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each whole text."""
        if not self.languages:
            return [(UNKNOWN, 0.0) for _ in texts]
        known = [i for i, t in enumerate(texts) if t and has_letter(t)]
        total = np.zeros((len(texts), len(self.languages)))
        share = np.zeros_like(total)
        count = np.zeros(len(texts), np.int64)
        rows, owners, held = [], [], 0

        def flush() -> None:
            nonlocal held
            x, own = np.concatenate(rows), np.concatenate(owners)
            for i in range(0, len(x), WINDOWS):
                log_p = self.log_probabilities(x[i : i + WINDOWS])
                np.add.at(total, own[i : i + WINDOWS], log_p)
                np.add.at(share, own[i : i + WINDOWS], np.exp(log_p))
            rows.clear()
            owners.clear()
            held = 0

        for i in known:
            x = windows(texts[i])
            count[i] = len(x)
            rows.append(x)
            owners.append(np.full(len(x), i))
            held += len(x)
            if held >= WINDOWS:
                flush()
        if rows:
            flush()
        out = [(UNKNOWN, 0.0)] * len(texts)
        for i in known:
            k = int(total[i].argmax())
            out[i] = (self.languages[k], float(min(1.0, share[i, k] / count[i])))
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(samples: list[tuple[str, bytes]], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Fit a network to (language, window bytes) samples.

    Each epoch crops every sample to a random length, so that short texts are
    as familiar as full windows. Languages weigh alike in the loss order.
    """
    rng = np.random.default_rng(seed)
    samples = sorted(samples)
    languages = sorted({lang for lang, _ in samples})
    net = Network.fresh(languages, rng)
    if len(languages) < 2:
        return net
    number = {lang: i for i, lang in enumerate(languages)}
    x = np.full((len(samples), WINDOW), 32, np.uint8)
    size = np.zeros(len(samples), np.int64)
    for i, (_, raw) in enumerate(samples):
        size[i] = min(len(raw), WINDOW)
        x[i, : size[i]] = np.frombuffer(raw[:WINDOW], np.uint8)
    y = np.array([number[lang] for lang, _ in samples])
    per = np.bincount(y, minlength=len(languages))
    chance = (1 / per[y]) / (1 / per[y]).sum()
    moment = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    steps = max(1, len(samples) // BATCH)
    for t in range(1, epochs * steps + 1):
        own = rng.choice(len(samples), min(BATCH, len(samples)), p=chance)
        batch = x[own].copy()
        for row, n in zip(batch, size[own]):
            keep = int(np.exp(rng.uniform(np.log(8), np.log(WINDOW))))
            start = int(rng.integers(0, max(1, n - keep + 1)))
            part = row[start : start + keep].copy()
            row[:] = 32
            row[: len(part)] = part
        _, grads = net.gradients(batch, y[own])
        rate = 0.02 * (1 - 0.9 * t / (epochs * steps))
        for p, g, m, v in zip(net.parameters(), grads, moment, square):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return net


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[str, bytes]]:
    """A bounded, repeatable sample of labelled windows for training.

    Takes rows with a language whose key has crc32 mod 5 other than 0. A
    language with more than ``SAMPLE_DOCS`` rows gives about that many, picked
    by a hash; a hard bound of twice the expected total follows. If there are
    more than ``MAX_LANGUAGES``, those with the most rows are learned.
    """
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{lang}`").cast("string").alias("l"))
    rows = rows.where(F.col("l").isNotNull() & F.col("t").isNotNull() & (fold("k", 5) != 0))
    sizes = {r.l: r.n for r in rows.groupBy("l").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l").limit(MAX_LANGUAGES).collect()}
    if not sizes:
        return []
    rate = F.create_map(*[F.lit(x) for l, n in sorted(sizes.items()) for x in (l, min(1.0, SAMPLE_DOCS / n))])
    chance = F.pmod(F.xxhash64("k", "l"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.withColumn("u", chance).where(F.element_at(rate, F.col("l")) > F.col("u"))

    def cutout(texts):
        out = []
        for t in texts:
            x = windows(t) if has_letter(t) else []
            every = max(1, len(x) // SAMPLE_WINDOWS)
            out.append([b for w in x[::every][:SAMPLE_WINDOWS] if (b := bytes(w).strip())])
        return [pa.array(out, pa.list_(pa.binary()))]

    own = per_text(chosen, "t", ["u", "l"], "w array<binary>", cutout).orderBy("u", "l").limit(2 * SAMPLE_DOCS * len(sizes))
    return [(r.l, bytes(w)) for r in own.collect() for w in r.w]


def identify(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row.

    ``und`` with score 0 for a NULL text, a text without a letter, and when
    nothing was learned. One row per input row; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(texts):
        out = shared.value.predict(texts)
        return [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())]

    return per_text(docs, text, [key], "lang_pred string, score double", run)


def learn_and_identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Train on a sample of the labelled rows, then predict every row.

    Returns ``key``, ``held_out`` (crc32 of the key mod 5 is 0; a NULL key
    counts as the empty text, which is held out), ``lang_pred``, ``score``.
    An empty table gives an empty result.
    """
    net = train(sample(docs, key, text, lang))
    return identify(docs, net, key, text).select(key, (fold(key, 5) == 0).alias("held_out"), "lang_pred", "score")
