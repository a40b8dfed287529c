import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from test_linechunks import plain as plain_chunks
from test_simhash import groups_of
from test_simhash import plain as plain_fingerprint

import __spark_entry__
import corpus_pipeline as P
from voltaic.llm import decontaminate, quality
from voltaic.llm.common import read
from voltaic.llm.queries import ORACLE, QUERIES, byte_vocabulary

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "text", "n_chars").collect()))


def test_every_stage_equals_brute_force(spark):
    docs = read(spark, SF, "documents")
    stages = dict(P.STAGES)
    columns = docs.columns

    out = stages["quality_classifier"](spark, docs, SF)
    assert out.columns == columns
    good = {r.doc_id for r in quality.classify(docs, read(spark, SF, "labels")).where("score >= 0.7").collect()}
    assert rows(out) == [r for r in rows(docs) if r[0] in good] and 100 < len(good) < 200

    docs, out = out, stages["line_dedup"](spark, out, SF)
    assert out.columns == columns
    want = plain_chunks([(k, t) for k, t, _ in rows(docs)])
    assert rows(out) == [(k, t, len(t)) for k, t, _, _ in want] and any(n for *_, n in want)

    docs, out = out, stages["simhash_dedup"](spark, out, SF)
    assert out.columns == columns
    before = rows(docs)
    keys = [k for k, _, _ in before]
    groups = groups_of(keys, [plain_fingerprint(t) for _, t, _ in before])
    assert rows(out) == [r for r, g in zip(before, groups) if r[0] == g] and len(set(groups)) < len(keys)

    docs, out = out, stages["benchmark_decontamination"](spark, out, SF)
    assert out.columns == columns
    items = [decontaminate.normalize(r.text) for r in read(spark, SF, "benchmark").collect()]
    leaked = {k for k, t, _ in rows(docs) if any(p in decontaminate.normalize(t) for p in items)}
    assert rows(out) == [r for r in rows(docs) if r[0] not in leaked]

    docs, out = out, stages["byte_bpe"](spark, out, SF)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_vocabulary().ranks, special_tokens={})
    want = [(k, coder.encode_ordinary(t), t.encode()) for k, t, _ in rows(docs)]
    digest = lambda x: hashlib.sha256(x).hexdigest()
    assert sorted(map(tuple, out.collect())) == [(k, len(x), digest(np.array(x, "<u4").tobytes()), digest(t)) for k, x, t in want]


def test_empty_and_odd_tables(spark):
    docs = read(spark, SF, "documents")
    odd = docs.limit(3).withColumn("score", F.lit("kept")).unionByName(docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars", F.lit("kept").alias("score")))
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        out = stage(spark, odd, SF)
        assert out.count() <= 4
        if name != P.STAGES[-1][0]:
            assert out.columns == odd.columns, name


def test_registered():
    queries = __spark_entry__.queries()
    assert set(QUERIES) < set(queries) and queries["pipeline"] is P.run
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


def test_null_and_repeated_ids_stay_apart(spark):
    """Documents with NULL or repeated ids are judged by their own texts."""
    stages = dict(P.STAGES)
    leak = read(spark, SF, "benchmark").orderBy("item_id").first().text
    a, b, c = ("one two three four five six", "red green blue black white pink", "north south east west up down")
    data = [(None, a), (None, b), (None, b), (1, a + " x y z"), (1, c), (2, c), (3, "q " * 9), (3, "q " * 9), (4, leak), (4, b + " seven"), (None, leak + " and more")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in data], "doc_id long, text string, lang string, source string, n_chars int")
    groups = groups_of(list(range(len(data))), [plain_fingerprint(t) for _, t in data])
    want = {}
    for (k, t), g in zip(data, groups):
        want.setdefault(g, []).append((k is None, k or 0, t))
    out = stages["simhash_dedup"](spark, docs, SF)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in out.collect()))
    assert len(got) == len(want) == len(set(groups))
    assert all(any(x in got for x in m) for m in want.values())
    assert all(min(m)[:2] in {x[:2] for x in m if x in got} for m in want.values())
    clean = stages["benchmark_decontamination"](spark, docs, SF)
    assert sorted((str(r.doc_id), r.text) for r in clean.collect()) == sorted((str(k), t) for k, t in data if leak not in t)


def test_stages_keep_columns_with_clashing_names(spark):
    docs = read(spark, SF, "documents").limit(60)
    odd = ["__h", "__drops", "__hash", "__score", "__left", "__removed", "x.y", "others", "c0", "k", "none"]
    docs = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in odd])
    for name, stage in P.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = [r.asDict() for r in out.collect()]
        assert got and all(r[c] == f"{c}{r['doc_id']}" for r in got for c in odd), name
