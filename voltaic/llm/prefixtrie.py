"""Prefix trie of conversations, with node totals in flat arrays.

A node stands for a distinct sequence of first turns. Its digest is the
exclusive-or of a 128-bit hash of each turn with its place, so the digests of
a conversation's prefixes are a running aggregate that can start anywhere: a
conversation of any length is cut into parts that different tasks handle.

Nodes are dealt to shards by subtree. In a shard, a minimal perfect hash gives
each digest of a level a slot, which holds the digest so that every look-up is
verified. Counts are scattered into flat arrays by slot, and the totals of a
level are added to the level above through an array of parent slots, deepest
level first; a shard holds two levels at a time.

Two kinds of node need no shard of their own:

* The tail of a conversation that no other shares is a chain. Its first node
  goes to a shard as a leaf; the others follow from their depth.
* Nodes with more than one in ``SPLIT`` of all members form the crown, at most
  ``SPLIT`` nodes at each depth. Subtrees below it are dealt to shards, so a
  first turn that a third of all conversations share is no hot group; the
  shards' totals are added up by crown node, and the crown is one more shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaic.llm.common import Scratch, cut

#: A crown node has more than one in SPLIT of all members, and more than LEAST.
SPLIT = 4096
LEAST = 64
#: Mean number of nodes of a shard, and member numbers of a block.
SHARD_NODES = 512
ENDS = 4096

WORD = "[^\\x20\\x09-\\x0D]+"
NODE = ["depth", "x", "y"]


class SlotTable:
    """A minimal perfect hash of distinct 128-bit digests, with the digests.

    At each step, digests alone at their place in a bit array get a slot, the
    rank of that bit; the others go on to the next, smaller array.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []
        self.x, self.y = np.empty_like(x), np.empty_like(y)
        taken = 0
        while len(x):
            place = self._place(x, y, len(self.steps), 2 * len(x) + 1)
            alone = np.bincount(place, minlength=2 * len(x) + 1) == 1
            rank = np.cumsum(alone) - 1 + taken
            won = alone[place]
            if not won.any() and len(self.steps) > 200:
                raise ValueError("repeated digests have no perfect hash")
            self.steps.append((alone, rank))
            slots = rank[place[won]]
            self.x[slots], self.y[slots] = x[won], y[won]
            taken += int(won.sum())
            x, y = x[~won], y[~won]

    @staticmethod
    def _place(x: np.ndarray, y: np.ndarray, step: int, size: int) -> np.ndarray:
        h = x + (y ^ np.uint64(0x9E3779B97F4A7C15 * (step + 1) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return ((h ^ (h >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def find(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The slots of digests; -1 for those that the table does not hold."""
        slot = np.full(len(x), -1)
        left = np.arange(len(x))
        for step, (alone, rank) in enumerate(self.steps):
            place = self._place(x[left], y[left], step, len(alone))
            hit = alone[place]
            slot[left[hit]] = rank[place[hit]]
            left = left[~hit]
        held = slot >= 0
        held[held] = (self.x[slot[held]] == x[held]) & (self.y[slot[held]] == y[held])
        return np.where(held, slot, -1)


_IN = ["shard", "depth", "x", "y", "px", "py", "top", "conv", "n", "words", "kids", "leaves", "saved"]
_OUT = ["depth", "x", "y", "px", "py", "top", "conv", "parent", "n", "kids", "leaves", "saved"]
_OUT_DDL = "depth long, x long, y long, px long, py long, top boolean, conv long, parent long, n long, kids long, leaves long, saved long"


def level(own: dict[str, np.ndarray], below: dict[str, np.ndarray] | None) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray] | None]:
    """Totals of one level, and the level below with its parents' numbers."""
    table = SlotTable(own["x"].view(np.uint64), own["y"].view(np.uint64))
    slot = table.find(own["x"].view(np.uint64), own["y"].view(np.uint64))
    flat = {name: np.empty_like(own[name]) for name in own}
    for name in own:
        flat[name][slot] = own[name]
    if below is not None:
        up = np.flatnonzero(~below["top"])
        parent = table.find(below["px"][up].view(np.uint64), below["py"][up].view(np.uint64))
        if (parent < 0).any():
            raise ValueError("a node has no parent in its shard")
        flat["kids"] += np.bincount(parent, minlength=len(slot))
        np.add.at(flat["leaves"], parent, below["leaves"][up])
        np.add.at(flat["saved"], parent, below["saved"][up])
        below["parent"][up], below["known"][up] = flat["conv"][parent], True
    flat["leaves"][flat["kids"] == 0] = 1
    flat["saved"] += (flat["n"] - 1) * flat["words"]
    flat["parent"], flat["known"] = np.zeros(len(slot), np.int64), np.zeros(len(slot), bool)
    return flat, below


def _accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node totals of shards; rows come by shard and then deepest level first."""
    def out(nodes: dict[str, np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array(nodes[c], mask=~nodes["known"]) if c == "parent" else pa.array(nodes[c]) for c in _OUT]
        return pa.RecordBatch.from_arrays(columns, names=_OUT)

    below = None
    for own in _levels(batches):
        at = (own.pop("shard")[0], own["depth"][0])
        if below is not None and at != (shard, depth - 1):
            yield out(below)
            below = None
        shard, depth = at
        now, done = level(own, below)
        if done is not None:
            yield out(done)
        below = now
    if below is not None:
        yield out(below)


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The rows of each shard and depth as arrays."""
    held: list[dict[str, np.ndarray]] = []
    join = lambda parts: {c: np.concatenate([p[c] for p in parts]) for c in _IN}
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in _IN}
        new = np.flatnonzero((np.diff(rows["shard"]) != 0) | (np.diff(rows["depth"]) != 0)) + 1
        for i, j in zip([0, *new], [*new, batch.num_rows]):
            part = {c: rows[c][i:j].copy() for c in _IN}
            if held and (held[-1]["shard"][-1], held[-1]["depth"][-1]) != (part["shard"][0], part["depth"][0]):
                yield join(held)
                held = []
            held.append(part)
    if held:
        yield join(held)


def ranked(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns as hashes, with their rank in the conversation from 1.

    Rows are dealt by range of (conversation, turn, hashes), so a long
    conversation is many parts; parts are ranked by themselves, and moved on
    by the number of rows in earlier parts. Returns a table with ``conv``,
    ``part``, ``rank``, ``a``, ``b`` (hashes of role and text) and ``words``.
    """
    who, what = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    slim = conversations.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.xxhash64(who, what).alias("a"), F.xxhash64(F.lit("second"), what, F.lit(1), who).alias("b"), F.regexp_count(what, F.lit(WORD)).cast("long").alias("words")).where("conv is not null")
    scratch = Scratch(conversations.sparkSession)
    parts = scratch.table(slim.repartitionByRange("conv", "turn", "a", "b").withColumn("part", F.spark_partition_id()))
    sizes = parts.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut(sizes.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    inside = Window.partitionBy("conv", "part").orderBy("turn", "a", "b")
    out = parts.withColumn("rank", F.row_number().over(inside)).join(sizes, ["conv", "part"])
    out = scratch.table(out.select("conv", "part", (F.col("rank") + F.col("before")).alias("rank"), "a", "b", "words"))
    scratch.remove(keep=1)
    return out


def rebuild(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations with their first turns taken from another one.

    Of conversation c, the first h turns (h: crc32 of its number, modulo
    ``most``) come from conversation c - c % ``every``, all if it has fewer
    and none if it is absent; then follow c's own turns after its first h.
    Takes ``ranked`` turns and returns them with ``place`` for ``rank``, and
    the conversations (``conv``, ``length``), turnless ones too.
    """
    sizes = cut(turns.groupBy("conv").agg(F.max("rank").alias("size")))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h")
    plan = sizes.select("conv", "size", h, (F.col("conv") - F.col("conv") % every).alias("base"))
    plan = plan.join(sizes.select(F.col("conv").alias("base"), F.col("size").alias("others")), "base", "left")
    plan = cut(plan.select("conv", "base", "h", "size", F.least("h", F.coalesce("others", F.lit(0))).alias("taken")))
    first = turns.where((F.col("rank") < most) & (F.col("conv") % every == 0)).select(F.col("conv").alias("base"), F.col("rank").alias("place"), "a", "b", "words")
    heads = plan.where("h > 0").join(first, "base").where("place <= h").select("conv", F.lit(-1).alias("part"), "place", "a", "b", "words")
    own = turns.join(plan.select("conv", "h", "taken"), "conv").where("rank > h")
    own = own.select("conv", "part", (F.col("rank") - F.col("h") + F.col("taken")).alias("place"), "a", "b", "words")
    lengths = plan.select("conv", (F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("length"))
    return heads.unionByName(own), lengths


def prefixes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """The node of each prefix of each conversation: ``conv``, ``depth``, the
    digest (``x``, ``y``) and its parent's (``px``, ``py``), ``words`` of the
    last turn, and ``last``, whether the conversation ends there."""
    hashed = rows.select("conv", "part", F.col("place").alias("depth"), "words", F.xxhash64("place", "a", "b").alias("u"), F.xxhash64("b", F.lit("second"), "place", "a").alias("v"))
    parts = hashed.groupBy("conv", "part").agg(F.bit_xor("u").alias("u"), F.bit_xor("v").alias("v"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long"))
    parts = cut(parts.select("conv", "part", zero("u").alias("bu"), zero("v").alias("bv")))
    inside = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = hashed.select("*", F.bit_xor("u").over(inside).alias("x"), F.bit_xor("v").over(inside).alias("y")).join(parts, ["conv", "part"])
    xor = lambda a, b: F.col(a).bitwiseXOR(F.col(b))
    run = run.select("conv", "depth", xor("x", "bu").alias("x"), xor("y", "bv").alias("y"), "u", "v", "words")
    run = run.select("conv", "depth", "x", "y", xor("x", "u").alias("px"), xor("y", "v").alias("py"), "words")
    return run.join(lengths, "conv").select(*run.columns, (F.col("depth") == F.col("length")).alias("last"))


def end_digests(members: DataFrame) -> DataFrame:
    """SHA-256 of the ascending members that end at each node, joined by commas.

    ``members`` has ``conv`` and the node. Numbers are sorted and written in
    blocks by many tasks; the blocks of a node then pass through one running
    hash, which is sequential by nature and holds one block at a time.
    """
    def block(batches):
        held: list = []
        text = lambda: (*held[0][:3], held[0][3], ",".join(str(r[3]) for r in held))
        for batch in batches:
            out = []
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if held and (held[-1][:3] != row[:3] or len(held) >= ENDS):
                    out.append(text())
                    held = []
                held.append(row)
            if out:
                yield rows(out, ["depth", "x", "y", "first", "ends"])
        if held:
            yield rows([text()], ["depth", "x", "y", "first", "ends"])

    def digest(batches):
        node, sha = None, None
        for batch in batches:
            out = []
            for depth, x, y, ends in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)]):
                if (depth, x, y) == node:
                    sha.update(b",")
                else:
                    if node is not None:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (depth, x, y), hashlib.sha256()
                sha.update(ends.encode())
            if out:
                yield rows(out, [*NODE, "ends_sha256"])
        if node is not None:
            yield rows([(*node, sha.hexdigest())], [*NODE, "ends_sha256"])

    def rows(out: list, names: list[str]) -> pa.RecordBatch:
        types = [pa.int64() if n in (*NODE, "first") else pa.string() for n in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    order = [*NODE, "conv"]
    blocks = members.select(*[F.col(c).cast("long") for c in order]).repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = blocks.mapInArrow(block, "depth long, x long, y long, first long, ends string")
    return blocks.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, "depth long, x long, y long, ends_sha256 string")


def trie(steps: DataFrame, lengths: DataFrame, split: int = SPLIT, least: int = LEAST, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Totals of every node: the node, its parent, ``conv`` (smallest member),
    ``parent`` (the parent's), ``n``, ``kids``, ``leaves`` and ``saved``.

    ``steps`` are ``prefixes``, ``lengths`` all conversations. No conversation
    gives no node.
    """
    scratch = Scratch(steps.sparkSession)
    long = lambda v: F.lit(v).cast("long")
    nodes = steps.groupBy(*NODE).agg(F.min("px").alias("px"), F.min("py").alias("py"), F.min("conv").alias("conv"), F.count("*").alias("n"), F.min("words").alias("words"))
    root = lengths.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).where("n > 0")
    root = root.select(*[long(0).alias(c) for c in (*NODE, "px", "py")], "conv", "n", long(0).alias("words"))
    nodes = scratch.table(nodes.unionByName(root))
    members, count = lengths.count(), nodes.count()
    bound = max(least, -(-members // split))
    # The root is always of the crown, and every parent of a crown node is.
    crown = cut(nodes.where((F.col("n") > bound) | (F.col("depth") == 0)))
    other = nodes.where((F.col("n") <= bound) & (F.col("depth") > 0))

    # The first node below the crown names the subtree of a conversation.
    inside = steps.join(crown.select(*NODE), NODE).groupBy("conv").agg((F.max("depth") + 1).alias("at"))
    entry = lengths.join(inside, "conv", "left").select("conv", F.coalesce("at", F.lit(1)).alias("depth"))
    shards = max(1, -(-count // shard_nodes))
    entry = steps.join(entry, ["conv", "depth"]).select("conv", F.col("depth").alias("entry"), F.pmod(F.xxhash64("x", "y"), F.lit(shards)).alias("shard"))
    tail = nodes.where("n = 1 and depth > 0").groupBy("conv").agg(F.min("depth").alias("tail"), F.max("depth").alias("end"))
    entry = cut(entry.join(tail, "conv", "left"))
    placed = scratch.table(other.join(entry, "conv"))
    single = F.col("n") == 1
    deep = placed.where(single & (F.col("depth") > F.col("tail")))
    deep = deep.select(*NODE, "px", "py", F.lit(False).alias("top"), "conv", F.col("conv").alias("parent"), "n", (F.col("depth") < F.col("end")).cast("long").alias("kids"), long(1).alias("leaves"), long(0).alias("saved"))
    mine = placed.where(~single | (F.col("depth") == F.col("tail")))
    mine = mine.select("shard", *NODE, "px", "py", (F.col("depth") == F.col("entry")).alias("top"), "conv", "n", "words", F.when(single, (F.col("depth") < F.col("end")).cast("long")).otherwise(0).alias("kids"), F.when(single, long(1)).otherwise(0).alias("leaves"), long(0).alias("saved"))
    sums = lambda df: df.select(*_IN).mapInArrow(_accumulate, _OUT_DDL)
    below = scratch.table(sums(mine.repartition("shard").sortWithinPartitions("shard", F.desc("depth"))))

    above = below.where("top").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    started = crown.join(above, NODE, "left").select(long(0).alias("shard"), *NODE, "px", "py", (F.col("depth") == 0).alias("top"), "conv", "n", "words", *[F.coalesce(c, long(0)).alias(c) for c in ("kids", "leaves", "saved")])
    top = sums(started.repartition(1).sortWithinPartitions(F.desc("depth")))
    owner = crown.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv").alias("owner"))
    below = below.join(owner, ["depth", "px", "py"], "left").select(*[F.when(F.col("top"), F.col("owner")).otherwise(F.col("parent")).alias(c) if c == "parent" else F.col(c) for c in _OUT])
    out = cut(below.unionByName(top).unionByName(deep).drop("top"))
    scratch.remove()
    return out


def conversation_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", every: int = 20, most: int = 4) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the
    parent's smallest member; NULL at the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes of the subtree), ``saved_tokens`` (over the
    subtree, members but one times words of the node's last text) and
    ``ends_sha256`` (of the ascending members that end at the node).

    NULL turns come first; turns with one number follow the order of their
    hashes, so ties have one result, and repeated rows are turns like others.
    NULL roles and texts are empty; words are split at ASCII white space. Rows
    without a conversation number belong to none and are left out. An empty
    table has no node. Other columns are ignored, whatever their names.
    """
    rows, lengths = rebuild(ranked(conversations, conv, turn, role, text), every, most)
    scratch = Scratch(conversations.sparkSession)
    lengths, steps = cut(lengths), scratch.table(prefixes(rows, lengths))
    nodes = trie(steps, lengths)
    zero = [F.lit(0).cast("long").alias(c) for c in NODE]
    ends = cut(end_digests(steps.where("last").select("conv", *NODE).unionByName(lengths.where("length = 0").select("conv", *zero))))
    scratch.remove()
    return nodes.join(ends, NODE, "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def _crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII text in DuckDB SQL."""
    step = "list_reduce(list_prepend(xor(crc, b), [1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[]), lambda v, u: xor(v >> 1, 3988292384 * (v & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), lambda crc, b: {step}), 4294967295::BIGINT)"


ORACLE_SQL = f"""
WITH own AS (
  SELECT conv_id, md5(coalesce(role, '') || chr(1) || coalesce(text, '')) AS t, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
rebuilt AS (
  SELECT convs.conv_id, 0 AS part, own.r, own.t, own.words FROM convs JOIN own ON own.conv_id = convs.base AND own.r <= convs.h
  UNION ALL SELECT convs.conv_id, 1, own.r, own.t, own.words FROM convs JOIN own ON own.conv_id = convs.conv_id AND own.r > convs.h),
placed AS (SELECT conv_id, t, words, row_number() OVER (PARTITION BY conv_id ORDER BY part, r) AS d FROM rebuilt),
path AS (SELECT conv_id, words, d, string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY d) AS key, count(*) OVER (PARTITION BY conv_id) AS n FROM placed),
steps AS (
  SELECT conv_id, words, d, key, d = n AS last FROM path
  UNION ALL SELECT convs.conv_id, 0, 0, '', convs.conv_id NOT IN (SELECT conv_id FROM placed) FROM convs),
nodes AS (
  SELECT key, d, min(conv_id) AS conv_id, count(*) AS n, min(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends
  FROM steps GROUP BY key, d),
children AS (SELECT substr(key, 1, 32 * (d - 1)) AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
known AS (SELECT nodes.*, coalesce(children.n, 0) AS kids FROM nodes LEFT JOIN children ON nodes.key = children.key),
up AS (SELECT substr(key, 1, 32 * unnest(range(0, d + 1))) AS key, CAST(kids = 0 AS INT) AS leaf, (n - 1) * words AS saved FROM known),
sums AS (SELECT key, sum(leaf) AS leaves, sum(saved) AS saved FROM up GROUP BY key)
SELECT known.conv_id, known.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, known.n AS n_convs, known.kids AS n_children, sums.leaves::BIGINT AS n_leaves,
  sums.saved::BIGINT AS saved_tokens, known.ends AS ends_sha256
FROM known JOIN sums ON known.key = sums.key LEFT JOIN known AS parent ON known.d = parent.d + 1 AND parent.key = substr(known.key, 1, 32 * (known.d - 1))
"""
