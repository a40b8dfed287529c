"""Sorts, limits, top-k and samples."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedupe import keep_last


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows by ``order``: planned as TakeOrderedAndProject, so
    each task keeps only its own top ``n`` and no full sort happens."""
    return df.orderBy(*order).limit(n)


def latest(df: DataFrame, n: int = 1, keys: Sequence[str] = ("date", "hour"),
           series: Sequence[str] = ()) -> DataFrame:
    """The ``n`` latest rows by key, newest first, of each series (region).

    Without a series a bounded top-k per task; the latest one per series is
    a keep-last aggregate; more per series rank the series' rows, which
    Spark cuts to the first ``n`` before the shuffle."""
    if not series:
        return top_n(df, n, [F.col(k).desc() for k in keys])
    if n == 1:
        return keep_last(df.select("*", *[F.col(k).alias(f"__{k}") for k in keys]), series, [f"__{k}" for k in keys], drop_order=True)
    w = Window.partitionBy(*series).orderBy(*[F.col(k).desc() for k in keys])
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def last_n_ascending(df: DataFrame, n: int, keys: Sequence[str] = ("date",),
                     series: Sequence[str] = ()) -> DataFrame:
    """The ``n`` latest rows by ``keys`` of each series, shown oldest first."""
    return latest(df, n, keys, series).orderBy(*series, *keys)


def preview(df: DataFrame, n: int, keys: Sequence[str] = ("date", "hour")) -> DataFrame:
    """First ``n`` rows in key order, so that every run shows the same ones."""
    return top_n(df, n, [F.col(k) for k in keys])


def sample_n(df: DataFrame, n: int, seed: int = 7, keys: Sequence[str] = ("date", "hour")) -> DataFrame:
    """A random sample of at most ``n`` rows, the same at every run.

    Rows are ordered by an md5 of their key and the seed, and the ``n``
    smallest are kept: a bounded top-k per task, never a global sort.  Every
    key has the same chance, and any engine with md5 picks the same rows.
    """
    text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return df.orderBy(F.md5(F.concat_ws("|", *text, F.lit(str(seed))).cast("binary")), *keys).limit(n)
