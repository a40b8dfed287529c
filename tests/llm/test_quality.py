import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltaic.llm import quality
from voltaic.llm.common import fold, read

SF = "/root/testdata/sf0.01"


def test_statistics():
    for blank in (None, "", " \n\t"):
        assert not quality.statistics(blank).any()
    s = dict(zip(quality.STATISTICS, quality.statistics("AB cd\nAB cd\n!! 12")))
    assert np.isclose(s["log_words"], np.log1p(6)) and np.isclose(s["distinct_words"], 4 / 6)
    assert np.isclose(s["upper"], np.sqrt(4 / 12)) and np.isclose(s["distinct_lines"], 2 / 3)
    assert np.isfinite(quality.statistics("\x00" * 10 + "é" * 100_000)).all()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.floats(0, 1)), min_size=1, max_size=30))
def test_isotonic(rows):
    w, m = map(np.array, zip(*rows))
    got = quality.isotonic(w, m)
    assert len(got) == len(m) and (np.diff(got) >= -1e-12).all()
    assert np.isclose((w * got).sum(), (w * m).sum())
    # The max-min formula of isotonic regression.
    mean = lambda i, j: (w[i : j + 1] * m[i : j + 1]).sum() / w[i : j + 1].sum()
    n = len(m)
    want = [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
    assert np.allclose(got, want)


def test_weights_equal_a_fit_in_one_place(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    stats = quality.document_statistics(docs)
    model = quality.fit(stats, labels)
    rows = stats.join(labels, "doc_id").where(fold("doc_id", 4) < 2).toPandas()
    z = model.features(np.array(rows.stats.tolist()))
    penalty = np.diag([quality.RIDGE * len(z)] * quality.N_FEATURES + [1e-9])
    want = np.linalg.solve(z.T @ z + penalty, z.T @ rows.quality.to_numpy())
    assert np.allclose(model.weights, want, atol=1e-6)


def test_held_out_accuracy_and_columns(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert got.score.between(0, 1).all()
    assert ((got.score >= 0.7).astype(int) == got.predicted).all()
    assert (got.predicted == got.quality).mean() > 0.95
    kept = quality.keep_good(docs.withColumn("score", F.lit("x")), labels)
    assert kept.columns == [*docs.columns, "score"]
    assert kept.count() == quality.classify(docs, labels).where("predicted = 1").count()


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (2, "", 2), (None, "some words here", 3), (3, "x" * 200_000, 4)], "doc_id long, text string, stats int")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    got = quality.classify(docs, none).collect()
    assert len(got) == 5 and all(r.score == 0.5 and r.predicted == 0 for r in got)
    some = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.classify(docs, some).collect())
    assert quality.classify(docs.limit(0), some).count() == 0


def test_keep_good_keeps_columns_of_any_name(spark):
    docs, labels = read(spark, SF, "documents").limit(150), read(spark, SF, "labels")
    odd = docs.select("*", F.struct(F.col("lang").alias("a b"), F.lit(1).alias("c.d")).alias("__score"), F.lit(2).alias("x.y"), F.create_map(F.lit("k"), F.lit(1)).alias("stats"))
    kept = quality.keep_good(odd, labels)
    assert kept.schema == odd.schema
    want = {r.doc_id for r in quality.classify(docs, labels).where("score >= 0.7").collect()}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == want and want and all(r["__score"]["a b"] == r.lang for r in rows)
