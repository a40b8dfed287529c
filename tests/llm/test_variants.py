import random
import re
import zlib
from collections import Counter

import pytest

from voltaic.llm import queries, variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """Whether one inserted, deleted or replaced code point tells a from b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows, least=3):
    counts = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def plain(counts):
    """Rows (word, form, root, n, n_near, form_n) by comparing all words."""
    links = {w: [v for v in counts if near(v, w)] for w in counts}
    form = {}
    for w in counts:
        best = min(links[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(links[w]), counts.get(form[w])))
    return sorted(out)


def dense(seed, alphabet, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(alphabet) for _ in range(r.randrange(5, 9)))
    words = [word() for _ in range(n)]
    texts = [" ".join(r.choice(words[: r.randrange(1, n)]) for _ in range(r.randrange(200))) for _ in range(60)]
    return [*enumerate(texts), (None, texts[0]), (None, texts[1]), (3, texts[3]), (900, None), (901, ""), (902, "1 2, 3"), (903, "x" * 30_000 + " tail"), *[(k, "Äpfel ÄPFEL äpfel Über-über") for k in range(910, 914)]]


@pytest.mark.parametrize("seed, alphabet, n", [(1, "ab", 60), (2, "abc", 400), (3, "aàÿz", 150)])
def test_equals_brute_force(spark, seed, alphabet, n):
    rows = dense(seed, alphabet, n)
    got = variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain(plain_counts(rows))
    assert sorted(map(tuple, got.collect())) == want
    assert sum(w[1] is not None for w in want) > 3 or seed == 3


def test_chains_are_followed_to_their_end(spark):
    counts = {"a" * i + "bcdef": 2**i for i in range(20)} | {"lonely": 5}
    forms = [(w, {w2: w2 for w2 in counts}.get("a" + w)) for w in counts]
    got = variants.follow(spark.createDataFrame(forms, "word string, form string"))
    assert {r.word: r.root for r in got.collect()} == {w: "lonely" if w == "lonely" else "a" * 19 + "bcdef" for w in counts}


def test_a_shared_skip_is_one_link(spark):
    words = [("aaaaab", 9), ("aaaab", 50), ("aaaaaab", 4), ("aaabb", 50), ("caaab", 7)]
    got = variants.neighbours(spark.createDataFrame(words, "word string, n long"))
    counts = dict(words)
    want = {w: (len(x), *min((-counts[v], v) for v in x)) for w in counts if (x := [v for v in counts if near(v, w)])}
    assert {r.word: (r.near, -r.best_n, r.best) for r in got.collect()} == want


def test_trie_nodes_are_numbered_alike_across_shards():
    words = sorted({"".join(random.Random(i).choices("abc", k=5 + i % 4)) for i in range(300)})
    seen = {}
    for shard in range(2):
        own = [w for w in words if (w[:5] < "b") == (shard == 0)]
        for w, path in zip(own, variants.number_nodes(iter(own), 5, shard)):
            assert len(path) == len(w) + 1
            for i, node in enumerate(path):
                assert seen.setdefault(node, w[:i]) == w[:i]
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    assert len(seen) == len(prefixes)


def test_empty_table_and_clashing_names(spark):
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    names = "doc_id string, text string, key int, word string, n int, p int, `x.y` int, s struct<`a b`: int>"
    rows = [("q", "spelling spelling spelling", 1, "w", 2, 3, 4, (5,))]
    got = variants.spelling_variants(spark.createDataFrame(rows, names)).collect()
    assert [tuple(r) for r in got] == [("spelling", None, "spelling", 3, 0, None)]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op13_spelling_variants(spark, sf).collect())) == plain(plain_counts(rows))
