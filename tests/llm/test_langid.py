import numpy as np
from pyspark.sql import functions as F

from voltaic.llm import langid as L
from voltaic.llm.common import fold, read

SF = "/root/testdata/sf0.01"


def small_net(seed=0, n=3):
    return L.Network.fresh([f"l{i}" for i in range(n)], np.random.default_rng(seed))


def test_windows_cover_the_whole_text():
    for text in ("", "a", "ab" * 300, "é" * 253, "x" * 253, "y" * 256, "z" * 506, "w" * 507):
        w = L.windows(text)
        raw = text.encode()
        step = L.WINDOW - 3
        groups = {bytes(r[i : i + 4]) for r in w for i in range(L.WINDOW - 3)}
        assert all(raw[i : i + 4] in groups for i in range(len(raw) - 3))
        assert w.shape[1] == L.WINDOW and len(w) <= len(raw) // step + 1


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    net = small_net(3)
    x, y = rng.integers(0, 256, (4, L.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0])
    _, grads = net.gradients(x, y)
    for p, g in zip(net.parameters(), grads):
        for _ in range(4):
            i = tuple(rng.integers(0, s) for s in p.shape)
            if p is net.embedding:
                i = (int(x[0, rng.integers(0, L.WINDOW)]), i[1])
            old, eps = p[i], 1e-6
            p[i] = old + eps
            up, _ = net.gradients(x, y)
            p[i] = old - eps
            down, _ = net.gradients(x, y)
            p[i] = old
            assert abs((up - down) / (2 * eps) - g[i]) < 1e-5


def test_tables_equal_convolution():
    rng = np.random.default_rng(4)
    net = small_net(4)
    x = rng.integers(0, 256, (3, L.WINDOW)).astype(np.uint8)
    maxima = []
    for w, f in zip(L.WIDTHS, net.filters):
        e = net.embedding[x]
        a = np.stack([np.einsum("nwe,wef->nf", e[:, i : i + w], f) for i in range(L.WINDOW - w + 1)])
        maxima.append(a.max(0))
    h = np.maximum(np.concatenate(maxima, axis=1) + net.bias, 0)
    want = np.log(L.softmax(h @ net.weights + net.offset))
    assert np.allclose(net.log_probabilities(x), want, atol=1e-4)


def test_predictions_do_not_depend_on_batches(monkeypatch):
    net = small_net(5)
    texts = ["hello there " * 50, None, "12 34", "ünï", "a" * 5000]
    one = net.predict(texts)
    monkeypatch.setattr(L, "WINDOWS", 2)
    both = list(zip(one, [net.predict([t])[0] for t in texts]))
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-6 for a, b in both)
    assert one[1] == one[2] == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = read(spark, SF, "documents")
    got = L.learn_and_identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 150 and got.score.between(0, 1).all()
    assert (got.lang_pred == got.lang).mean() > 0.98


def test_sample_leaves_out_held_out_rows(spark):
    docs = read(spark, SF, "documents").withColumn("lang", F.when(fold("doc_id", 5) == 0, "zz").otherwise(F.col("lang")))
    assert "zz" not in {lang for lang, _ in L.sample(docs)}


def test_edge_rows(spark):
    rows = [(1, None, "en", 0.1), (2, "", None, 0.2), (2, "123", "en", 0.3), (None, "word", "de", 0.4), (4, "b" * 100_000, "de", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = L.learn_and_identify(docs).collect()
    assert len(got) == 5
    assert sum(r.lang_pred == "und" for r in got) == 3
    assert L.learn_and_identify(docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred = 'und'").count() == 5
    assert L.learn_and_identify(docs.limit(0)).count() == 0


def test_many_languages_are_no_error(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 2)
    rows = [(i, "some text here", ["aa", "bb", "bb", "cc", "cc", "cc"][i % 6]) for i in range(200)]
    got = L.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {lang for lang, _ in got} == {"bb", "cc"}
