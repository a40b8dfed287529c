"""Substring dedup by prefix-partitioned suffix trees over words.

The suffixes of a corpus are the word sequences that start at each word. Only
the part of their tree below a depth of ``window`` words matters: two suffixes
meet there if and only if they share a window of that many words. Suffixes are
split into memory-sized groups by a prefix of variable length, and each group
has a subtree of its own:

* Of the seed-word sequences in a window, the one with the least hash (the
  first of equal ones) is the window's anchor, which depends on the window's
  words alone. The prefix of a suffix runs from its first word to the end of
  its anchor, and its group is named by the anchor. Neighbouring suffixes
  mostly share an anchor, so they travel together as one fragment of text.
* A group whose fragments are all alike is a tree without branches: each of
  its nodes has the group's documents, and no text is needed to see it. Groups
  of one document are dropped, for nothing below them repeats.
* Each other group is built in memory from its distinct fragments: suffixes
  are ordered by prefix doubling over exact words, and those that agree on
  ``window`` words lie below one deep internal node. Its least document is
  the first one that has the repeat.
* A group with more than ``group`` distinct fragments is split by longer
  prefixes in two steps, so no group is larger than memory. First, a fragment
  is cut into pieces of a few neighbouring windows (7 of 43), and a piece is
  dealt by its core, the words that all these windows share: near copies have
  most pieces in common. Second, the distinct pieces of a core, if they differ
  and come from several documents, are split by the whole window. What comes
  back is what another piece or window has from an earlier document.

A document keeps the words that no repeat of an earlier document covers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import Scratch, chunks, cut

#: Words of a window, words of an anchor, and distinct fragments of a group.
WINDOW = 50
SEED_WORDS = 8
GROUP = 512
#: Slices in which the fragments with one piece meet what was found for it.
SLICES = 64
#: Bytes of text, window starts, and words of groups handled at one time.
PIECE_BYTES = 1 << 20
BLOCK = 1 << 16
BATCH_WORDS = 1 << 19
#: Stands for a NULL key: before all others.
NO_KEY = -(2**63)

_SPACE = b" \t\n\v\f\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACE)] = True
_BYTE = np.random.default_rng(11).integers(1, 2**63, 256, np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD1342543DE82EF95)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]).cumprod(dtype=np.uint64)


_SPAN = BLOCK + 1024
_POWER = _powers(_OTHER, _SPAN)
_INVERSE = _powers(np.uint64(pow(int(_OTHER), -1, 2**64)), _SPAN)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of bounded pieces of ``raw``, cut at white space."""
    start = 0
    while start < len(raw):
        end = min(start + PIECE_BYTES, len(raw))
        while end < len(raw) and raw[end] not in _SPACE:
            end += 1
        yield start, raw[start:end]
        start = end


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word of ``raw``."""
    hashes, starts, ends = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for offset, piece in pieces(raw):
        data = np.frombuffer(piece, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~_IS_SPACE[data]
        edge = np.diff(inside)
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(a):
            continue
        size = b - a
        first = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(first, size)
        spelled = _BYTE[data[np.flatnonzero(inside[1:-1])]] * _powers(_ODD, int(size.max()))[place]
        hashes.append(_mix(np.add.reduceat(spelled, first) + size.astype(np.uint64)))
        starts.append(a + offset)
        ends.append(b + offset)
    return tuple(map(np.concatenate, (hashes, starts, ends)))


def _grams(words: np.ndarray, seed: int) -> np.ndarray:
    """Hash of the ``seed`` words from each word on."""
    gram = np.zeros(len(words) - seed + 1, np.uint64)
    for j in range(seed):
        gram = gram * _ODD + words[j : len(words) - seed + 1 + j]
    return _mix(gram)


def anchors(words: np.ndarray, valid: np.ndarray, window: int, seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Fragments of a sequence of word hashes, a block of window starts at a time.

    ``valid`` marks the starts of whole windows. Yields arrays: the first and
    last window start of each fragment, the hash of its anchor and the hash of
    its words. Adjacent windows with one anchor are one fragment.
    """
    span = window - seed + 1
    for base in range(0, len(words) - window + 1, BLOCK):
        own = words[base : base + BLOCK + window - 1]
        n = len(own) - window + 1
        good = np.flatnonzero(valid[base : base + n])
        if not len(good):
            continue
        gram = _grams(own, seed)
        # The least hash in each window of grams; the place breaks ties.
        least, width = gram & ~np.uint64(0xFFFFFF) | np.arange(len(gram), dtype=np.uint64), 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: n], least[span - width : span - width + n])
        chosen = (least[good] & np.uint64(0xFFFFFF)).astype(np.int64)
        new = np.ones(len(good), bool)
        new[1:] = (np.diff(chosen) != 0) | (np.diff(good) != 1)
        at = np.flatnonzero(new)
        low, high = good[at], good[np.append(at[1:], len(good)) - 1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * _POWER[: len(own)], dtype=np.uint64)])
        whole = (sums[high + window] - sums[low]) * _INVERSE[low]
        yield low + base, high + base, gram[chosen[at]], _mix(whole + (high - low).astype(np.uint64))


def fragments_of(texts: list, window: int, seed: int) -> dict[str, np.ndarray]:
    """Row number, hashes, word span and byte span of all fragments of texts."""
    raws = [(t or "").encode() for t in texts]
    words, starts, ends = word_hashes(b"\n".join(raws))
    opens = np.cumsum([0, *[len(r) + 1 for r in raws]])
    edge = np.searchsorted(starts, opens)
    row = np.repeat(np.arange(len(raws)), np.diff(edge))
    valid = np.zeros(len(words), bool)
    if len(words) >= window:
        valid[: len(words) - window + 1] = row[: len(words) - window + 1] == row[window - 1 :]
    parts = list(anchors(words, valid, window, seed))
    low, high, h, f = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    own = row[low]
    return {"row": own, "h": h.view(np.int64), "f": f.view(np.int64), "lo": low - edge[own], "hi": high - edge[own],
            "b": starts[low] - opens[own], "e": ends[high + window - 1] - opens[own]}


def pieces_of(bodies: list[str], h: np.ndarray, window: int, seed: int) -> dict[str, np.ndarray]:
    """Cut fragments into pieces: row number, hashes of core and words, first
    window and number of windows.

    ``h`` is the hash of each fragment's anchor. How far a window starts before
    its anchor depends on its words alone, and so does the piece that it is in:
    the windows that start ``low`` to ``high`` words before the anchor. All of
    them have the words of the core, from the anchor less ``low`` on.
    """
    span = window - seed + 1
    step = math.isqrt(span - 1) + 1
    low = np.arange(0, span, step)
    high = np.minimum(low + step, span) - 1
    raws = [b.encode() for b in bodies]
    words, starts, _ = word_hashes(b"\n".join(raws))
    edge = np.searchsorted(starts, np.cumsum([0, *[len(r) + 1 for r in raws]]))
    row = np.repeat(np.arange(len(raws)), np.diff(edge))
    gram = _grams(words, seed)
    hit = np.flatnonzero(gram == h[row[: len(gram)]])
    anchor = (hit[np.unique(row[hit], return_index=True)[1]] - edge[:-1])[:, None]
    first = np.maximum(anchor - high, 0)
    last = np.minimum(anchor - low, np.diff(edge)[:, None] - window)
    i, j = np.nonzero(first <= last)
    first, last, anchor = first[i, j], last[i, j], anchor[i, 0]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _POWER[np.arange(len(words)) - edge[row]], dtype=np.uint64)])
    spelled = lambda a, b: (sums[edge[i] + b] - sums[edge[i] + a]) * _INVERSE[a]
    core = _mix(spelled(anchor - low[j], anchor - high[j] + window) + j.astype(np.uint64))
    whole = _mix(spelled(first, last + window) + (last - first).astype(np.uint64))
    return {"row": i, "g": core.view(np.int64), "p": whole.view(np.int64), "at": first, "n": last - first + 1}


def deep_nodes(codes: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """The node at ``depth`` words above each suffix, in the order of the suffixes.

    ``codes`` numbers the words of all texts of a batch one after another;
    ``starts`` are the suffixes, each with ``depth`` words of its own text, and
    ``group`` their groups. Suffixes of one group have the same node if and
    only if they agree on ``depth`` words. Ranks of twice as many words come
    from pairs of ranks, so no word is compared twice.
    """
    def ranked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)

    rank, width = codes.astype(np.int64), 1
    while 2 * width <= depth:
        rank = ranked(rank[:-width], rank[width:])
        width *= 2
    node = ranked(rank[starts], rank[starts + depth - width])
    return ranked(group.astype(np.int64), node)


def earliest(texts: pa.Array, group: np.ndarray, first: np.ndarray, window: int) -> list[np.ndarray]:
    """For fragments of some groups: fragment, first and last window, earliest key.

    ``first`` is the least key that has the fragment. Runs of windows with one
    earliest key are one row.
    """
    lists = pc.ascii_split_whitespace(texts)
    codes = lists.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    windows = size - window + 1
    opens = np.cumsum(size) - size
    fragment = np.repeat(np.arange(len(size)), windows)
    place = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    node = deep_nodes(codes, opens[fragment] + place, group[fragment], window)
    least = np.full(node.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, first[fragment])
    least = least[node]
    new = np.ones(len(node), bool)
    new[1:] = (fragment[1:] != fragment[:-1]) | (least[1:] != least[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(node)) - 1
    return [fragment[at], place[at], place[last], least[at]]


def _subtrees(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Build the groups of a partition, sorted by group, some at a time."""
    def build(table: pa.Table) -> pa.RecordBatch:
        column = lambda name: table.column(name).to_numpy()
        group = np.unique(column("g"), return_inverse=True)[1]
        i, a, b, least = earliest(table.column("body").combine_chunks(), group, column("first"), window)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (column("h")[i], column("f")[i], a.astype(np.int32), b.astype(np.int32), least)], names=["h", "f", "a", "b", "first"])

    held, words = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.list_value_length(pc.ascii_split_whitespace(batch.column(batch.schema.get_field_index("body"))))
        ends = np.cumsum(size.to_numpy(zero_copy_only=False), dtype=np.int64)
        group = batch.column(batch.schema.get_field_index("g")).to_numpy()
        start = 0
        for i in np.flatnonzero(np.diff(group, prepend=held[-1].column("g")[-1].as_py() if held else group[:1]) != 0):
            # A group ends before row i; it is built with those before it.
            if words + (ends[i - 1] if i else 0) - (ends[start - 1] if start else 0) >= BATCH_WORDS:
                held.append(pa.Table.from_batches([batch.slice(start, i - start)]))
                yield build(pa.concat_tables(held))
                held, words, start = [], 0, i
        if start < len(batch):
            held.append(pa.Table.from_batches([batch.slice(start)]))
            words += int(ends[-1] - (ends[start - 1] if start else 0))
    if held:
        yield build(pa.concat_tables(held))


def _pieces(batches: Iterator[pa.RecordBatch], window: int, seed: int) -> Iterator[pa.RecordBatch]:
    """The pieces of fragments, each named by its core and its words."""
    for part in chunks(batches, "body"):
        column = lambda name: part.column(part.schema.get_field_index(name))
        found = pieces_of(column("body").to_pylist(), column("h").to_numpy().view(np.uint64), window, seed)
        row = pa.array(found["row"])
        yield pa.RecordBatch.from_arrays([pa.array(found["g"]), pa.array(found["p"]), column("h").take(row), column("f").take(row), pa.array(found["at"].astype(np.int32)), pa.array(found["n"].astype(np.int32)), column("first").take(row)], names=["g", "p", "h", "f", "at", "n", "first"])


def _by_window(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The single windows of pieces, named by two hashes of their words."""
    import xxhash

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    for batch in chunks(batches, "body"):
        rows = []
        for g, p, first, at, n, body in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("g", "p", "first", "at", "n", "body")]):
            words = body.encode().split()
            for i in range(n):
                one = b" ".join(words[at + i : at + i + window])
                rows.append((xxhash.xxh64_intdigest(one) - 2**63, xxhash.xxh64_intdigest(one, 1) - 2**63, g, p, i, first))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["w", "w2", "g", "p", "at", "first"])


def keep_words(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Number of words, of words in ``spans`` (start, end), and the others joined."""
    spans = sorted(spans)
    kept, total, removed, i = [], 0, 0, 0
    for _, piece in pieces(raw):
        words = piece.split()
        at = 0
        while at < len(words):
            while i < len(spans) and spans[i][1] <= total + at:
                i += 1
            if i < len(spans) and spans[i][0] <= total + at:
                end = min(spans[i][1] - total, len(words))
                removed += end - at
            else:
                end = min(spans[i][0] - total, len(words)) if i < len(spans) else len(words)
                kept.append(b" ".join(words[at:end]))
            at = end
        total += len(words)
    return total, removed, b" ".join(kept).decode()


def _split(bodies: DataFrame, scratch: Scratch, window: int, seed: int) -> DataFrame:
    """Windows ``a`` to ``b`` of fragments of split groups that a fragment with
    the smaller key ``first`` has too.

    A piece's own least key holds for all of it, so of the windows of distinct
    pieces only those come back that a piece with a smaller key has too. Each
    node is an aggregate, and no group meets in one task.
    """
    parts = scratch.table(bodies.mapInArrow(lambda batches: _pieces(batches, window, seed), "g long, p long, h long, f long, at int, n int, first long"))
    parts = parts.withColumn("slice", F.pmod("f", F.lit(SLICES)))
    place = F.min(F.struct("first", "h", "f", "at", "n"))
    distinct = scratch.table(parts.groupBy("g", "p").agg(place.alias("place"), F.max("first").alias("last"), F.collect_set("slice").alias("slices")).select("g", "p", "place.*", "last", "slices"))
    # Cores of several documents whose pieces differ.
    cores = distinct.groupBy("g").agg(F.min("first").alias("least"), F.max("last").alias("last"), F.count("p").alias("pieces"))
    cores = cut(cores.where("least < last and pieces > 1").select("g"))
    texts = distinct.join(cores, "g").drop("last", "slices").join(bodies.select("h", "f", "body"), ["h", "f"]).select("g", "p", "first", "at", "n", "body")
    windows = scratch.table(texts.mapInArrow(lambda batches: _by_window(batches, window), "w long, w2 long, g long, p long, at int, first long"))
    least = windows.groupBy("w", "w2").agg(F.min("first").alias("least"), F.max("first").alias("last"))
    least = cut(least.where("least < last").drop("last"))
    single = windows.join(least, ["w", "w2"]).where("least < first").select("g", "p", F.struct(F.col("at").alias("a"), F.col("at").alias("b"), F.col("least").alias("first")).alias("run"))
    whole = distinct.where("first < last").select("g", "p", F.struct(F.lit(0).alias("a"), (F.col("n") - 1).alias("b"), "first").alias("run"))
    found = single.unionByName(whole).groupBy("g", "p").agg(F.collect_list("run").alias("found"))
    # A piece of very many fragments meets them in several tasks.
    found = found.join(distinct.select("g", "p", "slices"), ["g", "p"]).select("g", "p", "found", F.explode("slices").alias("slice"))
    back = parts.select("g", "p", "slice", "h", "f", "at", F.col("first").alias("own")).join(found, ["g", "p", "slice"])
    back = back.select("h", "f", "at", "own", F.inline("found")).where("first < own")
    return back.select("h", "f", (F.col("at") + F.col("a")).alias("a"), (F.col("at") + F.col("b")).alias("b"), "first")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED_WORDS, group: int = GROUP) -> DataFrame:
    """Repeats of earlier documents: ``k``, ``t`` and ``spans``.

    ``k`` is the key (NULL: ``NO_KEY``), ``t`` the hash of the text, and
    ``spans`` the word spans (start, end) whose windows also start in a
    document with a smaller key; spans may overlap. Documents without one
    have no row.
    """
    if not 1 <= seed < window or window + BLOCK > _SPAN:
        raise ValueError(f"seed must be under the window, and the window at most {_SPAN - BLOCK} words")
    scratch = Scratch(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_KEY)).alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("t"), F.col(f"`{text}`").cast("string").alias("__text")).where("__text is not null")
    names = ["h", "f", "lo", "hi", "b", "e"]

    def find(batches):
        for part in chunks(batches, "__text"):
            found = fragments_of(part.column(2).to_pylist(), window, seed)
            row = pa.array(found["row"])
            yield pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), *[pa.array(found[n] if n in "hf" else found[n].astype(np.int32)) for n in names]], names=["k", "t", *names])

    every = scratch.table(slim.mapInArrow(find, "k long, t long, h long, f long, lo int, hi int, b int, e int"))
    # Groups of several documents; of one fragment, or of more.
    groups = every.groupBy("h").agg(F.min("k").alias("first"), F.max("k").alias("last"), (F.min("f") != F.max("f")).alias("branches"))
    groups = cut(groups.where("first < last").select("h", "first", "branches"))
    shared = scratch.table(every.join(groups, "h"))
    span = F.struct("lo", (F.col("hi") + window).alias("end"))
    alike = shared.where("not branches and first < k").select("k", "t", span.alias("span"))

    # One place to read each distinct fragment of the other groups from.
    branching = shared.where("branches")
    place = F.min(F.struct("k", "t", "b", "e"))
    distinct = scratch.table(branching.groupBy("h", "f").agg(place.alias("p")).select("h", "f", "p.*"))
    heavy = cut(distinct.groupBy("h").count().where(F.col("count") > group).select("h", F.lit(True).alias("heavy")))
    wanted = distinct.join(heavy, "h", "left").groupBy("k", "t").agg(F.collect_list(F.struct("h", "f", "b", "e", F.col("heavy").isNotNull().alias("heavy"))).alias("parts"))
    body = lambda p: F.substring(F.col("__text").cast("binary"), p["b"] + 1, p["e"] - p["b"]).cast("string")
    read = slim.dropDuplicates(["k", "t"]) if _repeats(slim) else slim
    bodies = read.join(wanted, ["k", "t"]).select(F.inline(F.transform("parts", lambda p: F.struct(p["h"].alias("g"), p["h"].alias("h"), p["f"].alias("f"), F.col("k").alias("first"), body(p).alias("body"), p["heavy"].alias("heavy")))))
    bodies = scratch.table(bodies)
    dealt = bodies.where("not heavy").select("g", "h", "f", "first", "body").repartition("g").sortWithinPartitions("g")
    runs = dealt.mapInArrow(lambda batches: _subtrees(batches, window), "h long, f long, a int, b int, first long")
    split = _split(bodies.where("heavy").select("h", "f", "first", "body"), scratch, window, seed)
    # The fragment's own key holds for all of it: ``b`` NULL is its last window.
    whole = bodies.where("heavy").select("h", "f", F.lit(0).alias("a"), F.lit(None).cast("int").alias("b"), "first")
    runs = cut(runs.unionByName(split).unionByName(whole).groupBy("h", "f").agg(F.collect_list(F.struct("a", "b", "first")).alias("runs")))
    found = branching.select("k", "t", "h", "f", "lo", "hi").join(runs, ["h", "f"])
    found = found.select("k", "t", "lo", "hi", F.inline("runs")).where("first < k")
    last = F.coalesce(F.col("lo") + F.col("b"), F.col("hi"))
    found = found.select("k", "t", F.struct((F.col("lo") + F.col("a")).alias("lo"), (last + window).alias("end")).alias("span"))
    spans = cut(alike.unionByName(found).groupBy("k", "t").agg(F.collect_set("span").alias("spans")))
    scratch.remove()
    return spans


def _repeats(slim: DataFrame) -> bool:
    """Whether some key and text occur in several rows."""
    return not slim.groupBy("k", "t").count().where("count > 1").isEmpty()


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED_WORDS, group: int = GROUP) -> DataFrame:
    """Every document without the words that repeat an earlier document.

    A word goes if a window of ``window`` words that covers it occurs in a
    document with a smaller ``key`` too; windows are judged on the input.
    Returns, per input row: ``key``, ``n_words``, ``n_removed`` and ``kept``,
    the words left joined by one space.

    Words are split at ASCII white space. A NULL or empty text, and one of
    white space, has no words and an empty ``kept``; one with fewer words than
    a window keeps all. Rows with one key never remove each other's words,
    whether their texts are alike or not; rows that repeat key and text have
    equal results. ``key`` is an integer; a NULL key comes before all others.
    Very long texts are handled in pieces. An empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    spans = repeated_spans(docs, key, text, window, seed, group)
    rows = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").cast("string").alias("__text"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_KEY)).alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("t"))
    rows = rows.join(spans, ["k", "t"], "left").select("__key", "__text", "spans")

    def run(batches):
        for part in chunks(batches, "__text"):
            done = [keep_words((t or "").encode(), [(s["lo"], s["end"]) for s in found or []]) for t, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))]], names=["__key", "n_words", "n_removed", "kept"])

    out = rows.mapInArrow(run, f"__key {rows.schema['__key'].dataType.simpleString()}, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("__key", key)


def _sql(window: int) -> str:
    return f"""
WITH worded AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {window} + 2)) AS s FROM worded),
windows AS (SELECT doc_id, s, array_to_string(ws[s : s + {window - 1}], ' ') AS body FROM starts),
judged AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY body) < doc_id AS again FROM windows),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM worded),
covered AS (
  SELECT words.doc_id, words.i, words.word,
    coalesce(max(CAST(again AS INT)) OVER (PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW), 0) AS gone
  FROM words LEFT JOIN judged ON words.doc_id = judged.doc_id AND words.i = judged.s),
kept AS (
  SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS kept
  FROM covered GROUP BY doc_id)
SELECT worded.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM worded LEFT JOIN kept ON worded.doc_id = kept.doc_id
"""


ORACLE_SQL = _sql(WINDOW)
