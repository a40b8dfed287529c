import hashlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voltaic.llm import chat as C
from voltaic.llm.common import read

SF = "/root/testdata/sf0.01"
nasty = st.text(st.sampled_from(list("\\#</turn>: \nab é")), max_size=25) | st.lists(st.sampled_from(["\\", "###", "</turn>", "\n", ": ", "### Assistant: ", "x"]), max_size=6).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(nasty, nasty), max_size=5))
def test_round_trip(turns):
    text, spans = C.render(turns, "a")
    assert list(C.parse(text)) == turns
    assert [C.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "a"]
    assert text.count("\n### ") <= len(turns) + sum(t.count("\n") + r.count("\n") for r, t in turns)


def test_broken_text_is_an_error():
    text, _ = C.render([("user", "hi")])
    with pytest.raises(ValueError):
        list(C.parse(text[:-3]))


def test_fold():
    ev = lambda *x: [(k, r, t) for k, r, t in x]
    assert C.fold(ev(("message", "user", "a"), ("delta", None, "b"), ("delta", None, None))) == ("user", "ab")
    assert C.fold(ev(("message", "assistant", ""), ("delta", None, "x"), ("regenerate", None, None), ("delta", None, "y"))) == ("assistant", "y")
    assert C.fold(ev(("message", "user", "a"), ("edit", None, "c"), ("noise", "z", "q"), (None, None, None))) == ("user", "c")
    assert C.fold(ev(("message", "user", "a"), ("delete", None, None))) is None
    assert C.fold(ev(("delta", "user", "late"),)) == ("user", "late")


def test_event_log(spark, monkeypatch):
    rows = [
        (1, 0, 1, 0, "message", "user", "hi"), (1, 1, 1, 1, "message", "assistant", ""), (1, 1, 1, 5, "delta", None, "good"), (1, 1, 1, 3, "delta", None, "bad"),
        (1, 1, 1, 4, "regenerate", None, None), (1, 1, 1, 6, "delta", None, " day"), (1, 2, 1, 7, "message", "user", "gone"), (1, 2, 1, 8, "delete", None, None),
        (1, None, 1, 9, "message", "system", "first"), (None, 0, 1, 0, "message", None, None), (2, 0, 1, 0, "delete", None, None),
    ]
    log = spark.createDataFrame(rows, "conv_id long, turn long, part long, seq long, kind string, role string, text string")
    got = {r.conv_id: r for r in C.format_log(log).where("block >= 0").collect()}
    assert list(C.parse(got[1].formatted)) == [("user", "hi"), ("assistant", "good day")]
    assert [got[1].formatted[s.start : s.end] for s in got[1].loss_spans] == ["good day"]
    assert list(C.parse(got[None].formatted)) == [("", "")] and 2 not in got
    both = {r.conv_id: r for r in C.read_back(C.format_log(log)).collect()}
    assert both[1].n_turns == 3 and both[1].turns_sha256 == hashlib.sha256(b"system\nfirst\nuser\nhi\nassistant\ngood day\n").hexdigest()
    monkeypatch.setattr(C, "BLOCK_TURNS", 1)
    assert {r.conv_id: r for r in C.read_back(C.format_log(log)).collect()} == both
    assert C.read_back(C.format_log(log.limit(0))).count() == 0


def test_equals_plain_python_and_sql(spark):
    conversations = read(spark, SF, "conversations")
    got = sorted(map(tuple, C.read_back(C.format_log(C.events_of(C.with_probe(conversations)))).collect()))
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert got == sorted(map(tuple, duckdb.sql(C.ORACLE_SQL).fetchall()))
    by = defaultdict(list)
    for r in sorted(C.with_probe(conversations).collect(), key=lambda r: (r.conv_id, r.turn)):
        by[r.conv_id].append((r.role, r.text or ""))
    for c, n, sha, loss, loss_sha, size in got:
        said = "".join(t for r, t in by[c] if r == "assistant")
        assert n == len(by[c]) and sha == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in by[c]).encode()).hexdigest()
        assert loss == len(said) and loss_sha == hashlib.sha256(said.encode()).hexdigest()
        assert size == len(C.render(by[c])[0])
    assert got[0][0] == -7 and got[0][3] == 26


def test_repeated_and_null_rows(spark):
    rows = [(5, 0, "user", "b", 1), (5, 0, "user", "b", 1), (5, 0, "user", "a", 2), (5, 1, None, None, 3), (None, None, "user", "q", 4), (6, 0, "assistant", "z" * 500_000, 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    got = {r.conv_id: r for r in C.read_back(C.format_log(C.events_of(df))).collect()}
    assert got[5].n_turns == 4 and got[5].turns_sha256 == hashlib.sha256(b"user\na\nuser\nb\nuser\nb\n\n\n").hexdigest()
    assert got[None].n_turns == 1 and got[6].loss_chars == 500_000


def test_null_and_equal_turns_are_many_blocks(spark, monkeypatch):
    """Blocks follow the rank of a message: NULL or equal turns are no one group."""
    monkeypatch.setattr(C, "BLOCK_TURNS", 100)
    rows = [(1, None, "user", f"{i % 700:04d}") for i in range(1500)] + [(1, 3, "assistant", "same") for _ in range(1200)] + [(1, 10_000_000, "user", "end"), (2, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    blocks = C.format_log(C.events_of(df))
    assert blocks.where("conv_id = 1").count() >= 28 and blocks.agg({"n_turns": "max"}).first()[0] == 100
    got = {r.conv_id: r for r in C.read_back(blocks).collect()}
    order = sorted(rows[:-1], key=lambda r: (-1 if r[1] is None else r[1], r[2], r[3]))
    assert got[1].n_turns == 2701 and got[1].loss_chars == 4800
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in order).encode()).hexdigest()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert {r.conv_id: r for r in C.read_back(C.format_log(C.events_of(df))).collect()} == got
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_long_turns_close_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BATCH_CHARS", 1000)
    df = spark.createDataFrame([(1, i, "user", "y" * 600) for i in range(10)], "conv_id long, turn long, role string, text string")
    blocks = C.format_log(C.events_of(df))
    assert blocks.agg({"n_turns": "max"}).first()[0] == 2
    assert C.read_back(blocks).first().n_turns == 10
