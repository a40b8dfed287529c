import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from voltaic.llm import prefixtrie, queries

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """The nodes of (conv, turn, role, text) rows by brute force."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(x, key=lambda y: y[0])] for c, x in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - (abs(c) % 20) * (1 if c > 0 else -1), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in sorted(rebuilt.items()):
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own_members in members.items():
        cost = (len(own_members) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += cost
    sha = lambda node: hashlib.sha256(",".join(str(c) for c in members[node] if rebuilt[c] == node).encode()).hexdigest()
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n], sha(n)) for n, m in members.items()), key=repr)


def corpus(seed, convs, longest):
    r = random.Random(seed)
    text = lambda: " ".join(r.choice(["a", "b", "ç\tc"]) for _ in range(r.randrange(4)))
    rows = []
    for c in r.sample(range(-60, 6 * convs), convs):
        turns = [(r.choice(["user", "assistant", None]), r.choice([None, "", "x y", text()])) for _ in range(r.randrange(1, longest))]
        if c % 3 == 0:
            turns = [("system", "be kind")] * 2 + turns[: r.randrange(3)]
        rows += [(c, None if i == 0 and c % 5 == 0 else i, *t) for i, t in enumerate(turns)]
    rows += [(7_000, i, "user", "again and again") for i in range(60)] + [(7_001, i, "user", "again and again") for i in range(60)]
    rows += [(8_000, 1, "user", "same")] * 5 + [(8_001, 1, "user", "same")] * 7 + [(None, 1, "user", "nobody's")]
    r.shuffle(rows)
    return rows


def nodes_of(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    turns, lengths = prefixtrie.rebuild(prefixtrie.ranked(df))
    steps = prefixtrie.prefixes(turns, lengths)
    got = prefixtrie.trie(steps.cache(), lengths.cache(), **how)
    return sorted(map(tuple, got.select("conv", "depth", "parent", "n", "kids", "leaves", "saved").collect()), key=repr)


def test_equals_brute_force(spark):
    rows = corpus(1, 150, 9)
    got = prefixtrie.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("how", [{"split": 10, "least": 1, "shard_nodes": 7}, {"split": 1, "least": 0, "shard_nodes": 10**6}])
def test_crown_and_shards_change_nothing(spark, how):
    rows = corpus(2, 90, 6)
    assert nodes_of(spark, rows, **how) == [n[:-1] for n in plain(rows)]


def test_empty_turnless_and_clashing_names(spark):
    assert prefixtrie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefixtrie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []
    # crc32("3") % 4 is over 0, and conversation 0 is absent: no turn is left.
    assert zlib.crc32(b"3") % 4 > 0
    names = SCHEMA + ", conv long, part long, depth string, x string, n long, `x.y` int, s struct<`a b`: int>"
    got = prefixtrie.conversation_trie(spark.createDataFrame([(3, 0, "user", "x", 1, 2, "d", "e", 3, 4, (5,))], names))
    assert [tuple(r) for r in got.collect()] == [(3, 0, None, 1, 0, 1, 0, hashlib.sha256(b"3").hexdigest())]


def test_slots_are_minimal_perfect_and_verified():
    r = np.random.default_rng(4)
    for n in (0, 1, 2, 1000, 20_000):
        x, y = r.integers(0, 2**64, n, np.uint64), r.integers(0, 2**64, n, np.uint64)
        x[: n // 3] = 7  # digests that agree in one half
        table = prefixtrie.SlotTable(x, y)
        assert sorted(table.find(x, y)) == list(range(n))
        assert (table.find(x, y + np.uint64(1)) == -1).all()
    with pytest.raises(ValueError):
        prefixtrie.SlotTable(np.array([1, 1], np.uint64), np.array([2, 2], np.uint64))


def test_long_lists_of_ends_are_hashed_in_blocks(spark):
    rows = [(c, c % 3 and 1, c % 3, 5) for c in range(-4000, 30_000)]
    got = prefixtrie.end_digests(spark.createDataFrame(rows, "conv long, depth long, x long, y long"))
    want = {k: hashlib.sha256(",".join(str(c) for c in range(-4000, 30_000) if c % 3 == k).encode()).hexdigest() for k in range(3)}
    assert {r.x: r.ends_sha256 for r in got.collect()} == want


def test_levels_join_batches():
    r = random.Random(1)
    rows = sorted((r.randrange(3), -r.randrange(4), *[r.randrange(99) for _ in range(4)], False, *[1] * 6) for _ in range(100))
    rows = [(s, -d, *rest) for s, d, *rest in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=prefixtrie._IN)
    got = [list(p["x"]) for p in prefixtrie._levels(iter([batch.slice(0, 0), *[batch.slice(i, 7) for i in range(0, 100, 7)]]))]
    groups = defaultdict(list)
    for s, d, x, *_ in rows:
        groups[s, d].append(x)
    assert got == list(groups.values())


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op12_prefix_trie(spark, sf).collect()), key=repr) == plain(rows)
