import random
from collections import defaultdict

import duckdb
import pytest

from voltaic.llm import linechunks as L
from voltaic.llm.common import read

SF = "/root/testdata/sf0.001"


def plain(rows):
    """The rule in plain Python over (key, text) rows with distinct keys."""
    seen, drops = {}, defaultdict(set)
    for key, text in sorted(((k, t) for k, t in rows if t is not None), key=lambda x: (x[0] is not None, x[0])):
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(" ")]
        for i, j in zip(full, full[1:]):
            first = seen.setdefault(tuple(lines[i : j + 1]), (key, i, j))
            if first != (key, i, j):
                drops[key] |= set(range(max(i, first[2] + 1) if first[0] == key else i, j + 1))
    out = []
    for key, text in rows:
        if text is None:
            out.append((key, None, None, 0))
        else:
            kept = [x for i, x in enumerate(text.split("\n")) if i not in drops[key]]
            out.append((key, "\n".join(kept), len(kept), len(drops[key])))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    lines = [f"line {i}" for i in range(40)] + ["", " "]
    shared = [[rng.choice(lines) + str(j) for _ in range(12)] for j in range(4)]
    out = [(0, None), (1, ""), (2, "\n\n\n"), (3, "one\ntwo"), (4, "one\ntwo"), (None, "one\ntwo\nthree")]
    for k in range(10, 60):
        body = [f"own {k} {i}" for i in range(rng.randint(0, 9))]
        body += rng.choice(shared)[rng.randint(0, 3) :] + [f"tail {k}"] + rng.choice(shared)
        out.append((k, "\n".join(body)))
    out.append((90, "\n".join(shared[0] * 30)))
    return out


def test_equals_plain_python(spark, rows):
    got = L.clean(spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, hash int"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows), key=str)
    assert sum(r[3] > 0 for r in plain(rows)) > 30


def test_foreign_text_hides_no_passage(spark):
    """Planted passages go, whatever their length; clean lines stay."""
    rng = random.Random(8)
    own = lambda k, n: [f"own line {k} {i} {rng.random()}" for i in range(n)]
    rows, planted = [], []
    for p in range(200):
        size = (2, 3, 5, 10)[p % 4]
        passage = [f"passage {p} line {i}" for i in range(size)]
        for copy in range(2):
            k = 2 * p + copy
            rows.append((k, "\n".join(own(k, rng.randint(0, 5)) + passage + own(k + 0.5, rng.randint(0, 5)))))
        planted.append((2 * p + 1, size))
    got = {r.doc_id: r for r in L.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k].n_removed for k in got if got[k].n_removed} == dict(planted)
    assert all("passage" not in got[k].text and got[k].text.count("own line") == dict(rows)[k].count("own line") for k, _ in planted)


def test_a_larger_divisor_takes_a_share_of_the_chunks(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    removed = [L.drop_repeated_chunks(df, divisor=d).agg({"__removed": "sum"}).first()[0] for d in (1, 2, 8)]
    assert removed[0] > removed[1] > removed[2] > 0


def test_chunks_that_share_a_hash_are_told_apart(spark, rows, monkeypatch):
    real = L.F.xxhash64
    monkeypatch.setattr(L.F, "xxhash64", lambda *c: L.F.pmod(real(*c), L.F.lit(7)) if len(c) == 3 else real(*c))
    got = L.clean(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows), key=str)


def test_clashing_names_stay(spark):
    names = "doc_id long, text string, k int, h string, __h int, __drops int, `x.y` int, drops int, row int, s struct<`a b`: int>"
    rows = [(1, "a\nb\nc", 1, "h", 2, 3, 4, 5, 6, (7,)), (2, "a\nb\nd", 1, "h", 2, 3, 4, 5, 6, (7,))]
    out = L.drop_repeated_chunks(spark.createDataFrame(rows, names))
    assert out.columns == ["doc_id", "text", "k", "h", "__h", "__drops", "x.y", "drops", "row", "s", "__left", "__removed"]
    got = sorted(map(tuple, out.collect()))
    assert [r[:2] + r[2:9] + (r[9][0],) + r[10:] for r in got] == [(1, "a\nb\nc", 1, "h", 2, 3, 4, 5, 6, 7, 3, 0), (2, "d", 1, "h", 2, 3, 4, 5, 6, 7, 1, 2)]


def test_repeated_rows_keys_and_columns(spark):
    df = spark.createDataFrame(
        [(1, "a\nb\nc\nd", "x", 7), (1, "a\nb\nc\nd", "y", 7), (2, "a\nb\nc\nd", "z", 7), (2, None, "z", 7)],
        "doc_id long, text string, start string, n int",
    )
    out = L.drop_repeated_chunks(df)
    assert out.columns == ["doc_id", "text", "start", "n", "__left", "__removed"]
    got = {(r.doc_id, r.start, r.text is None): r["__removed"] for r in out.collect()}
    assert got[1, "x", False] == got[1, "y", False] == 0
    assert got[2, "z", False] > 0 and got[2, "z", True] == 0
    assert L.drop_repeated_chunks(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = L.clean(read(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_equals_sql(spark):
    docs = read(spark, SF, "documents")
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(map(tuple, duckdb.sql(L.ORACLE_SQL).fetchall()))
    assert sorted(map(tuple, L.clean(docs).collect())) == want
    assert sum(r[3] for r in want) > 0
