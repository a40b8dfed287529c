"""Benchmark decontamination by the q-gram lemma.

A passage of m characters that occurs with at most e edits shares at least
``m - q + 1 - q * e`` of its q-grams with the text, all on diagonals (text
position minus passage position) that span e + 1 values. Shared q-grams are
counted in bands of 2 (e + 1) diagonals that overlap by half, so one band
holds them all. Bands that reach the bound are verified by banded alignment,
which gives the edit distance and the region; the filter loses no match.
Passages too short for the lemma are found exactly, as whole words.

Texts and passages are compared after lower-casing and with each run of white
space as one space.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import chunks, cut, per_text

#: Length of a q-gram, and edits allowed as a share of a passage's characters.
Q = 8
EDIT_RATE = 0.1
#: Shorter passages (after normalization) have too few q-grams for the lemma;
#: they are searched exactly, between word boundaries.
MIN_CHARS = 24
#: Characters of benchmark that are searched for at one time; each such block
#: is sent to the executors, so this bounds the broadcast.
BLOCK_CHARS = 1 << 20
#: Characters of text that are scanned at one time, and q-gram hits expanded
#: at one time. Longer texts are scanned in overlapping pieces.
PIECE = 1 << 18
HITS = 1 << 20
SLOTS = 1 << 18
MIX = np.uint64(0x9E3779B97F4A7C15)
ONE = 1 << 32


def normalize(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit polynomial hash of the q-gram at every position."""
    now, size = points.astype(np.uint64), 1
    out, done, left = None, 0, q
    while True:
        power = np.uint64(pow(int(MIX), size, 1 << 64))
        if left & 1:
            if out is None:
                out, done = now, size
            else:
                n = max(0, len(points) - done - size + 1)
                out, done = out[:n] * power + now[done : done + n], done + size
        left >>= 1
        if not left:
            return out[: max(0, len(points) - q + 1)]
        now = now[: max(0, len(now) - size)] * power + now[size:]
        size *= 2


@dataclass
class Hit:
    item: int
    start: int
    end: int
    distance: int


class Index:
    """Every q-gram of a bounded block of passages, with its positions."""

    def __init__(self, passages: list[str], q: int = Q, rate: float = EDIT_RATE):
        self.q = q
        self.texts = [codes(p) for p in passages]
        self.m = np.array([len(t) for t in self.texts], np.int64)
        self.longest = int(self.m.max(initial=0))
        self.e = np.maximum(0, np.minimum((self.m * rate).astype(np.int64), (self.m - q) // q))
        self.need = np.maximum(1, self.m - q + 1 - q * self.e)
        hashes = [grams(t, q) for t in self.texts]
        h = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
        at = np.concatenate([*[np.arange(len(x)) for x in hashes], np.zeros(0, np.int64)])
        order = np.argsort(h, kind="stable")
        self.post_item, self.post_at = item[order].astype(np.int32), at[order].astype(np.int32)
        self.keys, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.bits = max(16, min(24, int(len(self.keys) * 8 + 1).bit_length()))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self._slot(self.keys)] = True

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h * MIX) >> np.uint64(64 - self.bits)

    def _hits(self, h: np.ndarray):
        """(item, diagonal cell) of shared q-grams, in parts of bounded size."""
        at = np.flatnonzero(self.seen[self._slot(h)])
        key = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[key] == h[at]
        at, key = at[same], key[same]
        total = np.cumsum(self.count[key])
        start = 0
        while start < len(at):
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + HITS, "right")))
            n = self.count[key[start:end]]
            each = np.repeat(np.arange(start, end), n)
            post = self.first[key[each]] + np.arange(len(each)) - np.repeat(total[start:end] - n - base, n)
            item = self.post_item[post].astype(np.int64)
            diagonal = at[each] - self.post_at[post] + self.longest
            yield item, diagonal // (self.e[item] + 1)
            start = end

    def bands(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item and first cell of each band that reaches the lemma's bound."""
        none = np.zeros(0, np.int64)
        if not len(self.keys) or len(points) < self.q:
            return none, none
        h = grams(points, self.q)
        slot = lambda item, cell: (item * 40503 + cell) & (SLOTS - 1)
        tally = np.zeros(SLOTS, np.int64)
        for item, cell in self._hits(h):
            tally += np.bincount(slot(item, cell), minlength=SLOTS)
        # Slots may be shared, so these sums are upper bounds; exact counts follow.
        band = tally + np.roll(tally, -1)
        parts = []
        for item, cell in self._hits(h):
            s = slot(item, cell)
            keep = np.maximum(band[s], band[s - 1]) >= self.need[item]
            parts.append(np.unique(item[keep] * ONE + cell[keep], return_counts=True))
        if not parts:
            return none, none
        key, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        if not len(key):
            return none, none
        n = np.bincount(back, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
        beside = np.minimum(np.searchsorted(key, key + 1), len(key) - 1)
        n = n + np.where(key[beside] == key + 1, n[beside], 0)
        item, cell = key // ONE, key % ONE
        good = n >= self.need[item]
        return item[good], cell[good]

    def align(self, points: np.ndarray, item: np.ndarray, cell: np.ndarray) -> list[Hit]:
        """Least edit distance of each passage within its band, and where."""
        # A band whose first cell holds no shared q-gram is known by its second
        # cell alone, so the cell before is aligned too.
        width = int(3 * (self.e[item].max() + 1))
        low = (cell - 1) * (self.e[item] + 1) - self.longest
        pad = 2 * self.longest + width + 1
        text = np.concatenate([np.full(pad, -1), points.astype(np.int64), np.full(2 * pad, -1)])
        m = self.m[item]
        passage = np.full((len(item), int(m.max())), -2, np.int64)
        for k, i in enumerate(item):
            passage[k, : len(self.texts[i])] = self.texts[i]
        column = np.arange(width)
        ramp = column * ONE
        # A cell holds distance * 2^32 + the column where its path began.
        now = np.broadcast_to(column, (len(item), width)).copy()
        last = np.zeros_like(now)
        gather = (low + pad)[:, None] + column
        for i in range(1, passage.shape[1] + 1):
            best = now + (text[gather + (i - 1)] != passage[:, i - 1 : i]) * ONE
            best[:, :-1] = np.minimum(best[:, :-1], now[:, 1:] + ONE)
            now = np.minimum.accumulate(best - ramp, axis=1) + ramp
            done = m == i
            last[done] = now[done]
        at = last.argmin(axis=1)
        value = last[np.arange(len(item)), at]
        return [Hit(int(i), int(lo + v % ONE), int(lo + size + a), int(v // ONE)) for i, lo, size, a, v in zip(item, low, m, at, value)]

    def search(self, texts: list[str | None]) -> list[tuple[int, Hit]]:
        """The best hit of each passage in each whole text, as (text number, hit)."""
        found: dict[tuple[int, int], Hit] = {}
        block, size = [], 0
        lap = 2 * self.longest + self.q

        def flush() -> None:
            points = codes("\0".join(t for _, _, t in block))
            item, cell = self.bands(points)
            if len(item):
                starts = np.cumsum([0, *[len(t) + 1 for _, _, t in block]])
                for hit in self.align(points, item, cell):
                    e = int(self.e[hit.item])
                    if hit.distance > e:
                        continue
                    k = int(np.searchsorted(starts, (hit.start + hit.end) // 2, "right")) - 1
                    if not 0 <= k < len(block):
                        continue
                    doc, offset, t = block[k]
                    a, b = max(hit.start - starts[k], 0), min(hit.end - starts[k], len(t))
                    if b - a < len(self.texts[hit.item]) - e:
                        continue
                    hit = Hit(hit.item, int(offset + a), int(offset + b), hit.distance)
                    best = found.get((doc, hit.item))
                    if best is None or (hit.distance, hit.start, hit.end) < (best.distance, best.start, best.end):
                        found[doc, hit.item] = hit
            block.clear()

        for n, t in enumerate(texts):
            t = normalize(t)
            for offset in range(0, max(1, len(t)), PIECE):
                part = t[max(0, offset - lap) : offset + PIECE]
                block.append((n, max(0, offset - lap), part))
                size += len(part)
                if size >= PIECE:
                    flush()
                    size = 0
        if block:
            flush()
        return sorted(((doc, hit) for (doc, _), hit in found.items()), key=lambda x: (x[0], x[1].item))


class Short:
    """Short passages, by length and hash, to be found as whole words."""

    def __init__(self, passages: list[str]):
        self.passages = passages
        self.sizes = {}
        for m in sorted({len(p) for p in passages}):
            own = [i for i, p in enumerate(passages) if len(p) == m]
            h = np.array([grams(codes(passages[i]), m)[0] for i in own], np.uint64)
            order = np.argsort(h)
            self.sizes[m] = h[order], np.array(own)[order]

    def search(self, texts: list[str | None]) -> list[tuple[int, Hit]]:
        """The first place of each passage in each text, as (text number, hit)."""
        out = []
        for n, t in enumerate(texts if self.sizes else []):
            t = normalize(t)
            word = lambda i: 0 <= i < len(t) and t[i].isalnum()  # noqa: B023, E731
            found: dict[int, Hit] = {}
            for offset in range(0, len(t), PIECE):
                points = codes(t[offset : offset + PIECE + MIN_CHARS])
                for m, (keys, own) in self.sizes.items():
                    h = grams(points, m)
                    first = np.searchsorted(keys, h)
                    for a in np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == h).tolist():
                        start = offset + a
                        if word(start - 1) and word(start) or word(start + m - 1) and word(start + m):
                            continue
                        k = int(first[a])
                        while k < len(keys) and keys[k] == h[a]:
                            i = int(own[k])
                            if i not in found and self.passages[i] == t[start : start + m]:
                                found[i] = Hit(i, start, start + m, 0)
                            k += 1
            out += [(n, found[i]) for i in sorted(found)]
        return out


def find_passages(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    q: int = Q, rate: float = EDIT_RATE, detail: bool = False,
) -> DataFrame:
    """Benchmark passages found in documents.

    One row per input row and passage that occurs in it within the edit
    budget: ``key``, ``item_key``, ``start``, ``end`` (code points of the
    normalized text) and ``distance`` of the best region (least distance, then
    first). A passage under ``MIN_CHARS`` characters must occur exactly, with
    no letter or digit going on at either end. NULL and empty texts hold
    nothing, and NULL and empty passages are in none; repeated passages are
    searched once and each of their rows is reported. Empty tables give an
    empty result. Distinct passages are searched in blocks of about
    ``BLOCK_CHARS`` characters, so that what is collected and sent to the
    executors stays bounded however large the benchmark is. With ``detail``,
    ``__hash`` (of the document's text) follows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_key}`").alias("k"), F.col(f"`{item_text}`").alias("t")).where("t is not null")
    items = cut(per_text(items, "t", ["k"], "p string", lambda texts: [pa.array([normalize(t) for t in texts], pa.string())]).where("p <> ''"))
    passages = cut(items.select("p").distinct().select(F.monotonically_increasing_id().alias("i"), "p"))
    chars = passages.agg(F.sum(F.length("p"))).first()[0] or 0
    n_blocks = -(-chars // BLOCK_CHARS)
    source = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"), F.xxhash64(F.col(f"`{text}`")).alias("h"))
    schema = f"k {source.schema['k'].dataType.simpleString()}, i long, start long, end long, distance long, h long"
    out = None
    for block in range(n_blocks):
        own = passages.where(F.expr(f"pmod(xxhash64(p), {n_blocks}) = {block}")).orderBy("p").collect()
        long, short = ([r for r in own if (len(r.p) < MIN_CHARS) is less] for less in (False, True))
        if not own:
            continue
        shared = spark.sparkContext.broadcast([(kind([r.p for r in rows]), np.array([r.i for r in rows], np.int64)) for kind, rows in (((lambda p: Index(p, q, rate)), long), (Short, short)) if rows])

        def run(batches, shared=shared):
            for part in chunks(batches, "t"):
                texts = part.column(1).to_pylist()
                for index, ids in shared.value:
                    hits = index.search(texts)
                    rows = pa.array([n for n, _ in hits], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(rows), pa.array(ids[[h.item for _, h in hits]] if hits else [], pa.int64())]
                        + [pa.array([getattr(h, f) for _, h in hits], pa.int64()) for f in ("start", "end", "distance")]
                        + [part.column(2).take(rows)],
                        names=["k", "i", "start", "end", "distance", "h"],
                    )

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    out = spark.createDataFrame([], schema) if out is None else out
    named = items.join(passages, "p").select("i", F.col("k").alias("item"))
    out = out.join(named, "i").select("k", "item", "start", "end", "distance", "h")
    out = out.withColumnRenamed("h", "__hash") if detail else out.drop("h")
    return out.withColumnsRenamed({"k": key, "item": item_key})


def drop_contaminated(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without a found passage.

    If ``found`` was made with ``detail``, a row goes when its key and text
    are a found row's; else all rows with a found row's key go, and rows with
    a NULL key stay unless a found row has a NULL key too.
    """
    if "__hash" not in found.columns:
        leaked = found.select(F.col(key).alias("__leaked")).distinct()
        return docs.join(leaked, docs[key].eqNullSafe(leaked["__leaked"]), "left_anti")
    leaked = found.select(F.col(key).alias("__leaked"), F.col("__hash").alias("__of")).distinct()
    hashed = docs.withColumn("__hash", F.xxhash64(F.col(f"`{text}`")))
    return hashed.join(leaked, hashed[key].eqNullSafe(leaked["__leaked"]) & (hashed["__hash"] == leaked["__of"]), "left_anti").drop("__hash")
