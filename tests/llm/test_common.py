import zlib

import pyarrow as pa
import pytest

from voltaic.llm import common


def test_fold_is_crc32_of_the_key_as_text(spark):
    rows = [(1,), (-7,), (10**12,), (None,)]
    got = spark.createDataFrame(rows, "doc_id long").select("doc_id", common.fold("doc_id", 5).alias("f")).collect()
    assert {r.doc_id: r.f for r in got} == {k: zlib.crc32(b"" if k is None else str(k).encode()) % 5 for (k,) in rows}


def test_chunks_cut_rows_and_bytes_but_no_text(monkeypatch):
    monkeypatch.setattr(common, "CHUNK_ROWS", 3)
    monkeypatch.setattr(common, "CHUNK_BYTES", 10)
    texts = ["a", None, "bb", "c" * 50, "", "dddd", "eeee", "ffff", "é" * 3]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["k", "text"])
    parts = [p.column(1).to_pylist() for p in common.chunks(iter([batch, batch.slice(0, 0)]))]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) <= 3 for p in parts)
    assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p) <= 10 for p in parts)


def test_per_text_keeps_columns_and_ignores_clashing_ones(spark):
    df = spark.createDataFrame([(1, "ab", 9.5), (2, None, 8.5)], "doc_id long, text string, size double")
    size = lambda texts: [pa.array([len(t or "") for t in texts], pa.int64())]
    got = common.per_text(df, "text", ["doc_id"], "size long", size)
    assert sorted(map(tuple, got.collect())) == [(1, 2), (2, 0)]
    whole = common.per_text(df, "text", df.columns, "`__n` long", size)
    assert sorted(map(tuple, whole.collect())) == [(1, "ab", 9.5, 2), (2, None, 8.5, 0)]


def test_scratch_tables_are_removed(spark):
    scratch = common.Scratch(spark)
    one, two = scratch.table(spark.range(5)), scratch.table(spark.range(7))
    scratch.remove(keep=1)
    assert two.count() == 7 and len(scratch.tables) == 1
    with pytest.raises(Exception):
        spark.read.parquet(one.inputFiles()[0]).count()
    scratch.remove()
    assert scratch.tables == []


class FakeContext:
    master = "spark://host"

    def getCheckpointDir(self):
        return None


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Session:
        sparkContext = FakeContext()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError):
        common.shared_folder(Session())
