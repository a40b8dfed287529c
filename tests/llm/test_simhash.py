import numpy as np
from pyspark.sql import functions as F
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from voltaic.llm import simhash
from voltaic.llm.common import read
from voltaic.llm.components import components

SF = "/root/testdata/sf0.001"


def plain(text, k=3):
    """Bit by bit, as the definition says."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(keys, fps, radius=2):
    """Union of all pairs, and the smallest key of each group."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    small = {}
    for i, k in enumerate(keys):
        if k is not None:
            small[find(i)] = min(k, small.get(find(i), k))
    return [small.get(find(i)) for i in range(len(fps))]


TEXTS = [None, "", " \n", "a", "A b", "a b c", "a b c d", "é ñ ß x y", "a b c d e", "x " * 500, "Z\x0bq\x0cw\te"]


def test_fingerprint(monkeypatch):
    want = [plain(t) for t in TEXTS]
    assert [simhash.fingerprint(t, 3) % 2**64 for t in TEXTS] == want
    monkeypatch.setattr(simhash, "TEXT_BYTES", 3)
    monkeypatch.setattr(simhash, "SHINGLES", 2)
    assert [simhash.fingerprint(t, 3) % 2**64 for t in TEXTS] == want
    assert simhash.fingerprint("ab cd", 1) % 2**64 == plain("ab cd", 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=12), st.lists(st.tuples(st.integers(0, 11), st.integers(0, 63), st.integers(0, 63)), max_size=20))
def test_block_links_connect_what_pairs_connect(seeds, flips):
    fps = sorted(set(seeds) | {seeds[i % len(seeds)] ^ 1 << a ^ 1 << b for i, a, b in flips})
    a = np.array(fps, np.uint64)
    want = groups_of(fps, fps)
    for u, v in [simhash.block_links(a, None, 2)]:
        root = {x: x for x in fps}
        for x, y in zip(u.tolist(), v.tolist()):
            root[x] = y
        assert [root[x] for x in fps] == want
    half = len(fps) // 2
    u, v = simhash.block_links(a[:half], a[half:], 2)
    assert all((x in fps) and (y in fps) for x, y in zip(u.tolist(), v.tolist()))


def test_components(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 201), (201, 202), (202, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame([*chain, (None, 3)], "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 201: 200, 202: 200}


@pytest.mark.parametrize("words", [2, 4, 8])
def test_tile_neighbours(words):
    """Fingerprints within the radius are in equal or neighbouring tiles."""
    bits = 64 // words
    base = bits + 1 + 4
    tile = lambda x: sum(((x >> bits * i & (1 << bits) - 1).bit_count() + 2) * base**i for i in range(words))
    off = set(simhash._offsets(2, words))
    rng = np.random.default_rng(words)
    for x in [0, 2**64 - 1, *map(int, rng.integers(0, 2**63, 300))]:
        for a, b in rng.integers(0, 64, (5, 2)).tolist():
            y = x ^ 1 << a ^ 1 << b
            assert tile(x) - tile(y) in off or tile(y) - tile(x) in off


def test_finer_tiles_give_the_same_groups(spark):
    docs = read(spark, SF, "documents")
    assert sorted(simhash.simhash_groups(docs, words=8).collect()) == sorted(simhash.simhash_groups(docs).collect())


def test_equals_brute_force_on_a_whole_table(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 3)
    docs = read(spark, SF, "documents").toPandas()[["doc_id", "text"]]
    extra = pd.DataFrame({"doc_id": [None, 9000, 9001, 9001, 9002], "text": [None, "", docs.text[3], docs.text[3], "only"]})
    both = pd.concat([docs, extra])
    rows = [(None if pd.isna(k) else int(k), t, "x") for k, t in zip(both.doc_id, both.text)]
    got = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()
    fps = [plain(t) for _, t, _ in rows]
    want = sorted(zip([r[0] for r in rows], [f"{x:016x}" for x in fps], groups_of([r[0] for r in rows], fps)), key=str)
    assert sorted(map(tuple, got), key=str) == want


def test_empty_and_keep_one(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (2, "a b"), (3, "z"), (3, "z"), (None, "q r s t")], "doc_id long, text string")
    kept = simhash.keep_one(docs, simhash.simhash_groups(docs))
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, "a b c"), (2, "a b"), (3, "z"), (None, "q r s t")]
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_keep_one_of_repeated_rows(spark):
    """Of rows with one key and text the one with the least hash stays, in any order."""
    rows = [(1, "a b c d", "x", {"m": 1}), (1, "a b c d", "y", {"m": 2}), (1, "a b c d", "z", {"m": 3}), (2, "a b c d", "w", None), (None, "q r s t", "n", None), (None, "q r s t", "o", None), (9, "lone text of its own", "l", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `odd name.x` string, tags map<string,int>")
    got = sorted(map(str, simhash.keep_one(docs, simhash.simhash_groups(docs, detail=True)).collect()))
    assert len(got) == 3 and simhash.keep_one(docs, simhash.simhash_groups(docs, detail=True)).columns == docs.columns
    turned = docs.orderBy(F.desc("`odd name.x`")).repartition(3)
    assert sorted(map(str, simhash.keep_one(turned, simhash.simhash_groups(turned, detail=True)).collect())) == got
