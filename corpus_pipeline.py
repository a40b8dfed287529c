"""A corpus pipeline: each stage works on the documents that the one before kept.

Stages take and return tables with the columns of ``documents`` (the last one
returns token digests). They keep extra columns, handle NULLs and empty
tables as their operators state, and need no caller to cache anything.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.llm import decontaminate, linechunks, quality, queries, simhash
from voltaic.llm.common import Scratch, read


def _apart(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage on key and text alone, all other columns packed into one, so
    that no name of theirs can clash with one that the stage uses."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in ("doc_id", "text")]
        packed = F.struct(F.lit(0).alias("none"), *[F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(others)])
        out = stage(spark, docs.select("doc_id", "text", packed.alias("others")), sf_dir)
        field = lambda c: F.col("others").getField(f"c{others.index(c)}")
        return out.select(*[(F.col(c) if c in ("doc_id", "text") else field(c)).alias(c) for c in docs.columns])

    return run


@_apart
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to ``labels``, scores as good."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated multi-line chunks in their texts.

    ``n_chars``, where present, is the length of the new text.
    """
    out = _apart(lambda spark, docs, sf_dir: linechunks.drop_repeated_chunks(docs))(spark, docs, sf_dir)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@_apart
def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.keep_one(docs, simhash.simhash_groups(docs, detail=True))


@_apart
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, decontaminate.find_passages(docs, read(spark, sf_dir, "benchmark"), detail=True))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every kept text."""
    return queries.encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: Model fits, fingerprints and token merges have no SQL form; a test compares
#: every stage with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; a table in the shared folder between
    stages cuts lineage."""
    scratch = Scratch(spark)
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        if i:
            docs = scratch.table(docs)
            scratch.remove(keep=1)
        docs = stage(spark, docs, sf_dir)
    return docs
