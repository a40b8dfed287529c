import random

import numpy as np
import pytest

from voltaic.llm import decontaminate as D


def substring_distance(p: str, t: str) -> int:
    """Sellers' table: the least edit distance of p to a substring of t."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rng, p, n):
    p = list(p)
    for _ in range(n):
        i, kind = rng.randrange(len(p)), rng.randrange(3)
        if kind == 0:
            p[i] = rng.choice("abcdeé")
        elif kind == 1:
            p.insert(i, rng.choice("abcdeé"))
        else:
            del p[i]
    return "".join(p)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "é", "ti", "s"]) for _ in range(rng.randint(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [prose(rng.randint(6, 30)) for _ in range(12)]
    texts = [None, "", "short", *[prose(60) for _ in range(10)]]
    for k in range(60):
        p = rng.choice(items)
        texts.append(prose(rng.randint(0, 40)) + " " + edited(rng, p, rng.randint(0, int(len(p) * 0.16))) + " " + prose(rng.randint(0, 40)))
    texts.append(items[0].upper().replace(" ", " \n\t"))
    return items, texts


def test_grams_are_position_wise():
    a, b = D.codes("xabcdefgabcdefg"), D.codes("abcdefg")
    for q in (1, 2, 3, 5, 7):
        h = D.grams(a, q)
        assert len(h) == len(a) - q + 1
        assert h[1] == h[8] == D.grams(b, q)[0]
    assert len(D.grams(b, 8)) == 0


@pytest.mark.parametrize("piece,hits", [(1 << 18, 1 << 20), (300, 50)])
def test_equals_brute_force(case, monkeypatch, piece, hits):
    monkeypatch.setattr(D, "PIECE", piece)
    monkeypatch.setattr(D, "HITS", hits)
    items, texts = case
    items = [D.normalize(p) for p in items]
    index = D.Index(items)
    got = {(n, h.item): h for n, h in index.search(texts)}
    want = {}
    for n, t in enumerate(texts):
        for i, p in enumerate(items):
            d = substring_distance(p, D.normalize(t))
            if d <= index.e[i]:
                want[n, i] = d
    assert {k: h.distance for k, h in got.items()} == want
    assert sum(d > 0 for d in want.values()) > 5
    for (n, i), h in got.items():
        assert substring_distance(items[i], D.normalize(texts[n])[h.start : h.end]) == h.distance


def test_frame(spark, case, monkeypatch):
    items, texts = case
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(3, texts[3], 0), (None, items[2], 0)], "doc_id long, text string, start int")
    bench = spark.createDataFrame([(i, p) for i, p in enumerate(items)] + [(50, None), (51, "tiny"), (52, "")], "item_id int, text string")
    one = sorted(map(tuple, D.find_passages(docs, bench).collect()), key=str)
    assert (None, 2, 0, len(items[2]), 0) in one
    assert all(r[1] < 50 for r in one)
    monkeypatch.setattr(D, "BLOCK_CHARS", 200)
    assert sorted(map(tuple, D.find_passages(docs, bench).collect()), key=str) == one
    assert D.find_passages(docs, bench.limit(0)).count() == 0
    assert D.find_passages(docs.limit(0), bench).count() == 0
    kept = D.drop_contaminated(docs, D.find_passages(docs, bench))
    leaked = {r[0] for r in one}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r.doc_id for r in docs.collect() if r.doc_id not in leaked), key=str)


def test_repeated_grams_do_not_crash():
    index = D.Index(["a" * 60, "ab" * 40])
    found = index.search(["a" * 3000, "ab" * 2000, "b" * 100])
    assert {(n, h.item, h.distance) for n, h in found} == {(0, 0, 0), (1, 1, 0)}
    assert np.all(index.need >= 1)


def test_short_passages_are_found_as_whole_words(monkeypatch):
    import re

    short = D.Short(["short text item", "über 9", "a", "x-y", "漢字"])
    texts = ["A Short\n text ITEM here", "short text items", "Über 9", "über 91", "b a", "ab ba", "(x-y)", "x-yz", None, "", "漢字", "漢字漢字", "a a a"]
    want = set()
    for n, t in enumerate(texts):
        t = D.normalize(t)
        for i, p in enumerate(short.passages):
            at = [m.start() for m in re.finditer(f"(?={re.escape(p)})", t) if not ((t[m.start() - 1 : m.start()].isalnum() and p[0].isalnum()) or (p[-1].isalnum() and t[m.start() + len(p) : m.start() + len(p) + 1].isalnum()))]
            if at:
                want.add((n, i, at[0]))
    for piece in (1 << 18, 5):
        monkeypatch.setattr(D, "PIECE", piece)
        assert {(n, h.item, h.start) for n, h in short.search(texts)} == want
    assert {(0, 0, 2), (2, 1, 0), (4, 2, 2), (6, 3, 1), (10, 4, 0)} <= want and not any(n in (1, 3, 7, 8, 9, 11) for n, _, _ in want)


def test_short_and_repeated_items_in_the_frame(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "there is a short text item inside"), (2, "short text items"), (3, None)], "doc_id long, text string")
    copies = [(i, "short  text ITEM") for i in range(300)] + [(900, "nothing of it"), (901, " "), (902, None)]
    bench = spark.createDataFrame(copies, "item_id int, text string")
    got = D.find_passages(docs, bench)
    assert sorted(map(tuple, got.collect())) == [(1, i, 11, 26, 0) for i in range(300)]
    built = []
    monkeypatch.setattr(D, "Short", lambda passages: built.append(passages) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        D.find_passages(docs, bench)
    assert built == [["nothing of it", "short text item"]]
