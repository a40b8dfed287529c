import hashlib
import random
import re

import numpy as np
import pytest

from voltaic.llm import queries, suffixtrees

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(rows, window):
    """(key, text) rows by brute force: (n_words, n_removed, kept) of each."""
    order = lambda k: (k is not None, k or 0)
    first = {}
    for k, t in rows:
        words = WORD.findall(t or "")
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            first[w] = min(first.get(w, order(k)), order(k))
    out = []
    for k, t in rows:
        words = WORD.findall(t or "")
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < order(k):
                gone |= set(range(i, i + window))
        out.append((k, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def corpus(seed, n, words, length):
    r = random.Random(seed)
    space = lambda: r.choice([" ", " ", " ", "\n", "\t ", "\x0b"])
    text = lambda m: "".join(r.choice(words) + space() for _ in range(m))
    shared = [text(length // 2) for _ in range(3)]
    rows = [(k, "".join(r.choice([text(r.randrange(length)), r.choice(shared)]) for _ in range(r.randrange(4)))) for k in r.sample(range(-50, 10 * n), n)]
    rows += [(k + 100_000, t) for k, t in rows[::5]]
    rows += [(200_000, None), (None, rows[0][1]), (None, shared[0] + "x " + shared[1]), (-99, ""), (200_001, " \n"), (rows[3][0], shared[0] + "y z"), rows[4], rows[4], (300_000, ("a " * 400)), (300_001, "\n" + "a  " * 200)]
    return rows


@pytest.mark.parametrize("window, seed, group", [(6, 2, 4096), (6, 2, 2), (5, 1, 3), (9, 8, 4096)])
def test_equals_brute_force(spark, window, seed, group):
    rows = corpus(window, 60, ["a", "b", "ç", "漢字"], 60)
    got = suffixtrees.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), window=window, seed=seed, group=group)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, window)


def test_production_window_with_near_copies(spark):
    r = random.Random(2)
    base = [[f"w{r.randrange(5000)}" for _ in range(r.randrange(40, 400))] for _ in range(30)]
    rows = []
    for i in range(120):
        words = list(base[i % 30] if i % 7 else base[0])
        for _ in range(i % 4):
            words[r.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    for group in (4096, 4):
        got = suffixtrees.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"), group=group)
        assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 50)


def test_split_groups_send_back_earlier_windows_only(spark, monkeypatch):
    """Near copies in groups that are all split: rows follow the size of a group."""
    r = random.Random(4)
    base = [f"w{i}" for i in range(60)]

    def copies(n):
        rows = []
        for i in range(n):
            words = list(base)
            words[r.randrange(60)] = f"c{i}"
            rows.append((i, " ".join(words)))
        return [*rows, (n, rows[0][1]), (None, rows[1][1]), (7, " ".join(base))]

    def needed(rows):
        """Distinct fragments, and their windows with an earlier fragment."""
        found = suffixtrees.fragments_of([t for _, t in rows], 10, 3)
        own, first = {}, {}
        for row, h, f, lo, hi in zip(*(found[c].tolist() for c in ("row", "h", "f", "lo", "hi"))):
            k = suffixtrees.NO_KEY if rows[row][0] is None else rows[row][0]
            body = tuple(rows[row][1].split()[lo : hi + 10])
            own[h, f] = min(k, own.get((h, f), (k,))[0]), body
        windows = [(k, body[a : a + 10]) for k, body in own.values() for a in range(len(body) - 9)]
        for k, w in windows:
            first[w] = min(first.get(w, k), k)
        return len(own) + sum(first[w] < k for k, w in windows), len(windows)

    made = []
    cut = suffixtrees.cut

    def counted(df):
        out = cut(df)
        if "runs" in out.columns:
            made.append(out.selectExpr("sum(size(runs))").first()[0])
        return out

    monkeypatch.setattr(suffixtrees, "cut", counted)
    for n in (80, 160):
        rows = copies(n)
        got = suffixtrees.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), window=10, seed=3, group=1)
        assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 10)
        most, windows = needed(rows)
        assert made[-1] <= most < windows
    assert made[1] < 3 * made[0]


def test_split_groups_share_pieces(spark, monkeypatch):
    """Near copies in groups that are all split: no row for each window of each fragment."""
    r = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(200):
        words = list(base)
        words[r.randrange(120)] = f"c{i}"
        rows.append((r.randrange(1000), " ".join(words)))
    rows += [(None, rows[0][1]), (2000, rows[1][1]), (2001, " ".join(base)), (-3, " ".join(base[7:101]))]
    made = []
    table = suffixtrees.Scratch.table

    def counted(self, df):
        out = table(self, df)
        if "at" in out.columns:
            made.append(out.count())
        return out

    monkeypatch.setattr(suffixtrees.Scratch, "table", counted)
    got = suffixtrees.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), group=1)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 50)
    found = suffixtrees.fragments_of([t for _, t in rows], 50, 8)
    own = {(h, f): hi - lo + 1 for h, f, lo, hi in zip(*(found[c].tolist() for c in ("h", "f", "lo", "hi")))}
    assert max(made) < sum(own.values()) / 3


@pytest.mark.parametrize("window, seed", [(50, 8), (6, 2), (9, 8), (5, 1)])
def test_pieces_meet_where_windows_do(window, seed):
    r = random.Random(window)
    texts = [" ".join(r.choice(["a", "b", "ç", "漢字"]) for _ in range(r.randrange(window, 4 * window))) for _ in range(12)]
    texts += [t.replace("b", "x" * 9, 1) for t in texts] + [" ".join(["a"] * 3 * window)]
    found = suffixtrees.fragments_of(texts, window, seed)
    bodies = [texts[row].encode()[b:e].decode() for row, b, e in zip(found["row"], found["b"], found["e"])]
    cut = suffixtrees.pieces_of(bodies, found["h"].view(np.uint64), window, seed)
    core, words, seen = {}, {}, []
    for row, g, p, at, n in zip(*(cut[c].tolist() for c in ("row", "g", "p", "at", "n"))):
        body = bodies[row].split()
        for i in range(at, at + n):
            core.setdefault(tuple(body[i : i + window]), set()).add(g)
            seen.append((row, i))
        words.setdefault((g, p), set()).add(tuple(body[at : at + n + window - 1]))
    assert all(len(x) == 1 for x in [*core.values(), *words.values()])
    assert sorted(seen) == [(row, i) for row, b in enumerate(bodies) for i in range(len(b.split()) - window + 1)]


def test_empty_table_and_clashing_names(spark):
    assert suffixtrees.drop_repeats(spark.createDataFrame([], "doc_id int, text string")).collect() == []
    names = "doc_id long, text string, k string, t string, spans string, first int, `x.y` int, h int, g int, __text string, s struct<`a b`: int>"
    rows = [(1, "a b c d", *["z"] * 3, 1, 2, 3, 4, "q", (1,)), (2, "b c d e", *["z"] * 3, 1, 2, 3, 4, "q", (1,))]
    got = suffixtrees.drop_repeats(spark.createDataFrame(rows, names), window=3, seed=2)
    assert sorted(map(tuple, got.collect())) == [(1, 4, 0, "a b c d"), (2, 4, 3, "e")]


def test_long_texts_go_in_pieces(monkeypatch):
    r = random.Random(5)
    text = "".join(r.choice(["aa", "b", "ccc", "é"]) + r.choice([" ", "\n\n", "\t"]) for _ in range(4000))
    whole = suffixtrees.fragments_of([text], 6, 2)
    hashes = suffixtrees.word_hashes(text.encode())
    monkeypatch.setattr(suffixtrees, "PIECE_BYTES", 37)
    assert all(np.array_equal(a, b) for a, b in zip(hashes, suffixtrees.word_hashes(text.encode())))
    spans = [(3, 9), (7, 20), (100, 3900)]
    words = text.split()
    assert suffixtrees.keep_words(text.encode(), spans) == (4000, 3817, " ".join(words[:3] + words[20:100] + words[3900:]))
    monkeypatch.setattr(suffixtrees, "BLOCK", 64)
    cut = suffixtrees.fragments_of([text], 6, 2)
    windows = lambda x: sorted((h, s) for h, lo, hi in zip(x["h"], x["lo"], x["hi"]) for s in range(lo, hi + 1))
    assert windows(cut) == windows(whole) and len(windows(cut)) == 3995
    assert all(suffixtrees.word_hashes(text.encode()[b:e])[0].tolist() == hashes[0][lo : hi + 6].tolist() for lo, hi, b, e in zip(cut["lo"], cut["hi"], cut["b"], cut["e"]))


def test_batches_keep_groups_whole(monkeypatch):
    import pyarrow as pa

    r = random.Random(3)
    rows = sorted((r.randrange(40), i, i * 7, r.randrange(99), " ".join(r.choice("ab") for _ in range(r.randrange(4, 9)))) for i in range(300))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["g", "h", "f", "first", "body"])
    cuts = lambda n: iter([batch.slice(i, n) for i in range(0, 300, n)] + [batch.slice(0, 0)])
    got = lambda n: sorted(x for b in suffixtrees._subtrees(cuts(n), 4) for x in zip(*[c.to_pylist() for c in b.columns]))
    whole = got(300)
    for words in (1, 50, 400):
        monkeypatch.setattr(suffixtrees, "BATCH_WORDS", words)
        assert got(1) == got(17) == whole
    least = {}
    for g, _, _, first, body in rows:
        for a in range(len(body.split()) - 3):
            w = (g, *body.split()[a : a + 4])
            least[w] = min(least.get(w, first), first)
    want = {(h, a): least[(g, *body.split()[a : a + 4])] for g, h, _, _, body in rows for a in range(len(body.split()) - 3)}
    assert {(h, a): first for h, _, lo, hi, first in whole for a in range(lo, hi + 1)} == want


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(k, n, m, hashlib.sha256(t.encode()).hexdigest()) for k, n, m, t in plain(rows, 50)]
    assert sorted(map(tuple, queries.op11_suffix_trees(spark, sf).collect()), key=repr) == want
