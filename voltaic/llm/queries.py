"""Registered queries of the text operators: ``opN_<name>`` and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.llm import bpe, chat, decontaminate, extract, langid, licenses, linechunks, outliers, prefixtrie, quality, simhash, suffixtrees, variants
from voltaic.llm.common import read


def byte_vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_crf_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.learn_and_extract(read(spark, sf_dir, "pages"))


def encode_documents(docs: DataFrame) -> DataFrame:
    return bpe.digests(bpe.encode_decode(docs, byte_vocabulary()))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(read(spark, sf_dir, "documents"))


def op3_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.learn_and_identify(read(spark, sf_dir, "documents"))


def op4_event_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = chat.events_of(chat.with_probe(read(spark, sf_dir, "conversations")))
    return chat.read_back(chat.format_log(log))


def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linechunks.clean(read(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and license passage in it."""
    return licenses.scan(read(spark, sf_dir, "documents"))


def op9_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark passage that occurs in it."""
    return decontaminate.find_passages(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"))


def op11_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the words of each document that no earlier document has too."""
    out = suffixtrees.drop_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per node of the prefix trie of all rebuilt conversations."""
    return prefixtrie.conversation_trie(read(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per frequent word of all documents, with the spelling that it varies."""
    return variants.spelling_variants(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_robust_outliers": op2_robust_outliers,
    "op3_byte_cnn": op3_byte_cnn,
    "op4_event_chat": op4_event_chat,
    "op5_line_chunks": op5_line_chunks,
    "op6_crf_extraction": op6_crf_extraction,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_license_scan": op8_license_scan,
    "op9_benchmark_passages": op9_benchmark_passages,
    "op10_simhash": op10_simhash,
    "op11_suffix_trees": op11_suffix_trees,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op4_event_chat": chat.ORACLE_SQL,
    "op5_line_chunks": linechunks.ORACLE_SQL,
    "op11_suffix_trees": suffixtrees.ORACLE_SQL,
    "op12_prefix_trie": prefixtrie.ORACLE_SQL,
    "op13_spelling_variants": variants.ORACLE_SQL,
}
