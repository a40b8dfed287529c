import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltaic.llm import outliers as O
from voltaic.llm.common import read

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside)


TEXTS = [
    None, "", " \n\t", "a", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 40, "l1 ü\nl1 ü\n\n \nl2\nl1 ü\nl2 ", "# * $ % & | < >   é",
    " ".join(f"w{i % 13}" for i in range(50)), "\x0ba\x0cb\r\nb\r\nb",
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert O.counts(text) == plain_counts(text)


def test_counts_on_documents(spark):
    for r in read(spark, "/root/testdata/sf0.001", "documents").select("text").collect()[:60]:
        assert O.counts(r.text) == plain_counts(r.text)


def test_chi_square():
    # Fixed values from published tables.
    assert abs(O.chi2_quantile(0.95, 4) - 9.488) < 1e-3
    assert abs(O.chi2_quantile(0.99, 6) - 16.812) < 1e-3
    assert O.inflation(0.999999) < 1.001


def test_block_mcd_resists_outliers():
    rng = np.random.default_rng(0)
    cov = np.array([[4, 1, 0, 0], [1, 3, 0, 0], [0, 0, 2, 0.5], [0, 0, 0.5, 5.0]])
    x = rng.multivariate_normal([1, 2, 3, 4], cov, 1500)
    bad = rng.multivariate_normal([40, -40, 40, -40], np.eye(4), 500)
    mean, est = O.block_mcd(np.concatenate([bad, x]))
    # A quarter is bad and the subset is three quarters: exactly the clean rows.
    assert np.allclose(mean, x.mean(0))
    assert np.allclose(est, np.cov(x.T, bias=True) * O.inflation() + np.eye(4))


def test_estimates_equal_steps_in_one_place(spark):
    """With one block per group, the same steps in numpy."""
    rng = np.random.default_rng(1)
    x = rng.normal(0, 2, (300, 4)) * np.where(rng.random((300, 1)) < 0.1, 10, 1)
    rows = spark.createDataFrame([(i, ["2a", "0"], *map(float, v)) for i, v in enumerate(x)], "id long, levels array<string>, x0 double, x1 double, x2 double, x3 double")
    got = O.estimates(rows, min_group=10, steps=1).toPandas().set_index("g")
    mean, cov = O.block_mcd(x)
    d = (((x - mean) @ np.linalg.inv(cov)) * (x - mean)).sum(1)
    own = x[d <= np.sort(d)[int(np.ceil(O.SUPPORT * len(x))) - 1]]
    want = np.linalg.inv(np.cov(own.T, bias=True) * O.inflation() + np.eye(4))
    for g in ("2a", "0"):
        assert np.allclose(got.loc[g, O._MEAN].astype(float), own.mean(0))
        assert np.allclose(O._square(got.loc[[g]], O._INVERSE)[0], want)


def test_estimates_of_several_blocks(spark):
    """Blocks averaged and refined over all rows, against the same in numpy."""
    rng = np.random.default_rng(7)
    x = rng.normal(0, 3, (900, 4)) * np.where(rng.random((900, 1)) < 0.1, 8, 1)
    rows = spark.createDataFrame([(i, ["2a", "0"] if i < 500 else ["2b", "0"], *map(float, v)) for i, v in enumerate(x)], "id long, levels array<string>, x0 double, x1 double, x2 double, x3 double")
    got = O.estimates(rows, min_group=10, block=150, steps=2).toPandas().set_index("g")
    h = rows.selectExpr("pmod(xxhash64(id, x0, x1, x2, x3, cast(null as bigint)), 1 << 30) as h").toPandas().h.to_numpy()
    for g, own in (("2a", np.arange(900) < 500), ("2b", np.arange(900) >= 500), ("0", np.ones(900, bool))):
        v, at = x[own], h[own] % -(-own.sum() // 150)
        assert len(set(at)) > 2
        parts = [O.block_mcd(v[at == b]) for b in sorted(set(at))]
        mean, cov = np.mean([p[0] for p in parts], 0), np.mean([p[1] for p in parts], 0)
        for _ in range(2):
            d = (((v - mean) @ np.linalg.inv(cov)) * (v - mean)).sum(1)
            near = v[d <= np.sort(d)[int(np.ceil(O.SUPPORT * len(v))) - 1]]
            mean, cov = near.mean(0), np.cov(near.T, bias=True) * O.inflation() + np.eye(4)
        assert np.allclose(got.loc[g, O._MEAN].astype(float), mean)
        assert np.allclose(O._square(got.loc[[g]], O._INVERSE)[0], np.linalg.inv(cov))


def test_hot_group_meets_in_slices(spark):
    """No task of a join holds a group whole."""
    rows = spark.range(20000).select(F.lit("0").alias("g"), F.xxhash64("id").alias("h"))
    one = spark.createDataFrame([("0", 7)], "g string, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = O.beside(rows, one, "g", F.col("h")).where("n = 7").groupBy(F.spark_partition_id().alias("p")).count().toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks["count"].sum() == 20000 and tasks["count"].max() < 10000


def test_verdicts_on_documents(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    got = O.judge(docs, min_group=50).join(labels, "doc_id").toPandas()
    assert (got.base_failed == ((got.n_words < 20) | (100 * got.n_repeat_words > 30 * got.n_words))).all()
    assert not (got.base_failed & got.kept).any()
    rest = got[~got.base_failed]
    assert rest[rest.quality == 1].kept.mean() > 0.99
    assert rest[(rest.quality == 0) & (rest.n_symbols > rest.n_words)].kept.mean() < 0.05


def test_edge_rows(spark):
    body = "some plain words that are not repeated here at all but number more than twenty so that the base rules pass them on"
    rows = [(None, body, None, "s", 1), (1, None, "en", None, 2), (2, "", None, None, 3), (3, body, "en", "s", 4), (3, body, "en", "s", 4), (4, "y" * 300_000, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long")
    got = O.judge(docs).toPandas()
    assert len(got) == 6 and got.kept.sum() == 3
    some = O.judge(docs, min_group=2).toPandas()
    assert len(some) == 6 and some.kept.sum() == 3
    assert O.judge(docs.limit(0)).count() == 0
    assert pd.isna(got.distance).all()


def test_a_groups_own_estimate_rejects(spark):
    """A word length that is common in one source is an outlier in another."""
    rng = np.random.default_rng(4)

    def body(mean):
        return " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(mean - 1, mean + 2))) for _ in range(200))

    rows = [(i, body(4 + i % 2), "en", "ab"[i % 2]) for i in range(400)]
    rows += [(1000, body(5), "en", "a"), (1001, body(5), "en", "b"), (1002, body(4), "en", "b"), (1003, body(4), "en", "a")]
    got = O.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).toPandas().set_index("doc_id")
    assert not got.base_failed.any()
    assert [bool(got.kept[k]) for k in (1000, 1001, 1002, 1003)] == [False, True, False, True]
    assert got.kept[got.index < 1000].mean() > 0.99


def test_floor_units(spark):
    rows = spark.createDataFrame([(float(i), float(i == 0), 0.0, 2.0 * i) for i in range(101)], "x0 double, x1 double, x2 double, x3 double")
    units = O.floor_units(rows, 0.01)
    assert np.allclose(units, [5 / 1.349, 1, 1, 10 / 1.349])
    assert O.floor_units(rows.limit(0)) == [1.0] * 4
