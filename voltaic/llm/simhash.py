"""SimHash near-dedup with an exact, tiled comparison of fingerprints.

Fingerprints are cut into tiles by the population counts of their words (four
of 16 bits). Two fingerprints that differ in ``radius`` bits have counts that differ
by ``radius`` in sum at most, so a tile is compared with its neighbours within
that distance only (21 of them at radius 2, one direction of each pair) and
all other tile pairs are skipped. Within a pair of tiles, numpy forms every
exclusive-or and counts its bits: nothing is approximate.

Only distinct fingerprints enter tiles, so exact copies cost one entry. A pair
of blocks sends on a spanning forest of its links and not the links, so a
group of n near copies sends on the order of n rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import cut, per_text
from voltaic.llm.components import components

#: Fixed value: the seed of the shingle hash.
SEED = 42
#: Fingerprints of a block; a tile has as many blocks as it needs.
BLOCK = 2048
#: Cells of the exclusive-or matrix formed at one time.
CELLS = 1 << 20
#: Bytes of text, and shingles, that are handled at one time.
TEXT_BYTES = 4 << 20
SHINGLES = 1 << 16


def _pieces(raw: bytes):
    """Lists of the words of ``raw`` in order, each from a bounded span."""
    if len(raw) <= TEXT_BYTES:
        yield raw.split()
        return
    start = 0
    while start < len(raw):
        end = min(start + TEXT_BYTES, len(raw))
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
            end += 1
        yield raw[start:end].split()
        start = end


def _votes(hashes: bytes) -> np.ndarray:
    """How many of the joined 8-byte big-endian hashes set each bit, bit 63 first."""
    return np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)


def fingerprint(text: str | None, shingle: int, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text as a signed integer; 0 without words."""
    import xxhash

    digest = xxhash.xxh64_digest
    votes, total, tail = np.zeros(64, np.int64), 0, []
    for words in _pieces((text or "").encode().lower()):
        words = tail + words
        tail = words[-(shingle - 1):] if shingle > 1 else []
        if len(words) < shingle:
            tail = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[: len(words) - shingle].tolist()]
        ends = (ends[shingle - 1 :] - 1).tolist()
        for i in range(0, len(starts), SHINGLES):
            votes += _votes(b"".join([digest(joined[a:b], seed) for a, b in zip(starts[i : i + SHINGLES], ends[i : i + SHINGLES])]))
        total += len(starts)
    if not total and tail:
        votes, total = _votes(digest(b" ".join(tail), seed)), 1
    bits = np.packbits((2 * votes > total).astype(np.uint8))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``keep`` and ``fp`` (long) of every whole text; one row per input row."""
    def run(texts):
        return [pa.array([fingerprint(t, shingle, seed) for t in texts], pa.int64())]

    return per_text(docs, text, [key, *keep], "fp long", run)


def _tile(fp: Column, radius: int, words: int) -> Column:
    """Population counts of the ``words`` equal words as digits of one number.

    Digits are moved up by ``radius``, so that adding an offset never carries.
    """
    bits = 64 // words
    base = bits + 1 + 2 * radius
    digit = lambda i: F.bit_count(F.shiftrightunsigned(fp, bits * i).bitwiseAND(F.lit((1 << bits) - 1))) + radius
    return sum(digit(i).cast("long") * base**i for i in range(words))


def _offsets(radius: int, words: int) -> list[int]:
    """Tile differences within the radius, one of each opposite pair, and 0."""
    base = 64 // words + 1 + 2 * radius
    near = [()]
    for _ in range(words):
        near = [(*d, x) for d in near for x in range(-radius, radius + 1) if sum(map(abs, d)) + abs(x) <= radius]
    return [sum(x * base**i for i, x in enumerate(d)) for d in near if d >= (0,) * words]


def _hook(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Join the components of each (u, v); labels stay the smallest index."""
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (deeper := label[label]).tobytes() != label.tobytes():
            label = deeper
        u, v = u[apart], v[apart]


def block_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two blocks, or within one.

    Every pair of ``a`` and ``b`` (``b`` None: of ``a`` with itself) is
    compared; the result has the same components as all links would have.
    """
    nodes = a if b is None else np.concatenate([a, b])
    other, shift = (a, 0) if b is None else (b, len(a))
    label = np.arange(len(nodes))
    step = max(1, CELLS // max(1, len(other)))
    for i in range(0, len(a), step):
        u, v = np.nonzero(np.bitwise_count(a[i : i + step, None] ^ other[None, :]) <= radius)
        if b is None:
            u, v = u[u + i < v], v[u + i < v]
        if len(u):
            label = _hook(label, u + i, v + shift)
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def links(distinct: DataFrame, radius: int = 2, words: int = 4) -> DataFrame:
    """Links ``u``, ``v`` that connect all fingerprints within ``radius`` bits.

    ``distinct`` has one row per fingerprint (``fp``). Pairs that differ in
    ``radius`` or fewer bits end in one component of the result, and no
    others do. ``words`` (2, 4 or 8) sets how fine tiles are: with 4, about
    one pair in 60 is compared at radius 2, with 8 one in some thousand, at
    the price of more neighbours per tile. The result is the same.
    """
    tiled = distinct.select("fp", _tile(F.col("fp"), radius, words).alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    if words <= 4:
        # At most 17^4 = 83,521 tiles exist, so this side is bounded at any input size.
        sizes = F.broadcast(sizes)
    blocks = cut(
        tiled.join(sizes, "tile")
        .groupBy("tile", F.expr("pmod(xxhash64(fp), blocks)").alias("block"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    left = blocks.select("fps", "block", "tile", F.explode(F.array(*[F.lit(x).cast("long") for x in _offsets(radius, words)])).alias("off"))
    left = left.select(F.col("fps").alias("a"), F.col("block").alias("block_a"), (F.col("tile") + F.col("off")).alias("tile"), "off")
    pairs = left.join(blocks.withColumnRenamed("fps", "b"), "tile").where("off <> 0 or block_a <= block")
    pairs = pairs.select("a", F.expr("if(off = 0 and block_a = block, null, b)").alias("b"))

    def run(batches):
        for batch in batches:
            u, v = [], []
            for a, b in zip(batch.column(0), batch.column(1)):
                one = a.values.to_numpy().view(np.uint64)
                two = b.values.to_numpy().view(np.uint64) if b.is_valid else None
                x, y = block_links(one, two, radius)
                u.append(x)
                v.append(y)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)], names=["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2, words: int = 4, detail: bool = False) -> DataFrame:
    """Fingerprint and group of every document.

    Words are split at ASCII white space after lower-casing A-Z; a text with
    fewer words than ``shingle`` is one shingle, and one without words (NULL
    and empty too) has fingerprint 0, linked like any other. Returns ``key``,
    ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key
    reachable over links of ``radius`` or fewer differing bits. One row per
    input row, repeated keys included; a row with a NULL key has a component
    like others, NULL if no member has a key. An empty table gives an empty
    result; other columns are ignored. With ``detail``, ``__group`` (one value
    per group, whatever the keys) and ``__hash`` (of the text) follow.
    """
    hashed = docs.withColumn("__hash", F.xxhash64(F.col(f"`{text}`"))) if detail else docs
    fps = cut(fingerprints(hashed, key, text, shingle, keep=("__hash",) if detail else ()))
    first = cut(fps.groupBy("fp").agg(F.min(key).alias("first")))
    roots = components(links(first, radius, words)).withColumnsRenamed({"node": "fp"})
    linked = first.join(roots, "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component"))
    linked = linked.join(smallest, "root").select("fp", "root", "component")
    # Cut, so that the join with all documents has an exchange of its own on
    # either side, which the adaptive skew join can split at a hot fingerprint.
    group = [F.coalesce("root", "fp").alias("__group")] if detail else []
    known = cut(first.join(linked, "fp", "left").select("fp", F.coalesce("component", "first").alias("component_id"), *group))
    more = ["__group", "__hash"] if detail else []
    return fps.join(known, "fp").select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", *more)


def keep_one(docs: DataFrame, groups: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group: the one with the smallest key.

    Of rows that share that key the one with the smallest hash of the text
    stays, and of rows that share the text too the one with the smallest hash
    of all columns (but maps). A NULL key comes after all others, and groups
    whose keys are NULL or repeated stay apart. ``groups`` is
    ``simhash_groups`` with ``detail``; without it, groups do not tell which of
    a repeated key's texts is whose, and are found anew.

    Slim rows decide; a text crosses one join, and a second shuffle only if
    its row is repeated.
    """
    if "__group" not in groups.columns:
        groups = simhash_groups(docs, key, text, detail=True)
    rows = groups.groupBy("__group", F.col(key).alias("key"), F.col("__hash").alias("hash")).agg(F.count("*").alias("copies"))
    chosen = rows.groupBy("__group").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "hash", "copies")).alias("c"))
    chosen = cut(chosen.select("c.key", "c.hash", (F.col("c.copies") > 1).alias("repeated")))
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    whole = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), quoted(key).alias("key"), F.xxhash64(quoted(text)).alias("hash"))

    def kept(own: DataFrame) -> DataFrame:
        return whole.join(own, whole["key"].eqNullSafe(own["key"]) & (whole["hash"] == own["hash"]), "left_semi")

    out = kept(chosen.where("not repeated")).select("row")
    twice = chosen.where("repeated")
    if not twice.isEmpty():
        order = F.xxhash64(*[F.col("row").getField(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()])
        out = out.unionByName(kept(twice).groupBy("key", "hash").agg(F.min_by("row", order).alias("row")).select("row"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
