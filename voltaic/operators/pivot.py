"""Long to wide."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_measure(df: DataFrame, keys: Sequence[str], category: str, value: str,
                  values: Sequence[str], rest: str | None = None,
                  rename: Callable[[str], str] | None = None) -> DataFrame:
    """One row per ``keys``, one column per entry of ``values``.

    A cell is the sum of ``value`` over the rows of its category (one row,
    when ``df`` is unique on keys and category); a cell without a row is
    NULL.  ``rest`` names the entry that also takes every category that is
    not listed, so no row is lost; without it such rows are left out.

    The value list is fixed, so no job runs to discover it, and the pivot is
    one conditional aggregate per value: a single shuffle on ``keys`` with
    partial aggregation before it.
    """
    cat = F.col(category)
    listed = cat.isin(*[v for v in values if v != rest])
    out = []
    for v in values:
        hit = ~listed if v == rest else cat == F.lit(v)
        out.append(F.sum(F.when(hit, F.col(value))).alias(rename(v) if rename else v))
    return df.groupBy(*keys).agg(*out)
