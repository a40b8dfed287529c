"""Scalar column functions.  All are built-in Spark expressions, so they
stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

_COMPARE = {
    "<": lambda c, b: c < b,
    "<=": lambda c, b: c <= b,
    ">": lambda c, b: c > b,
    ">=": lambda c, b: c >= b,
    "=": lambda c, b: c == b,
}


def col_of(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify(c: ColumnLike, rules: Sequence[tuple[str, float, str]], default: str,
             null_label: str | None = None) -> Column:
    """CASE chain: the first rule ``(op, bound, label)`` that holds wins.

    A NULL input fails every comparison and so falls to ``default``, as a
    SQL CASE does.  ``null_label`` gives NULL its own label instead.
    """
    value = col_of(c)
    expr = None
    if null_label is not None:
        expr = F.when(value.isNull(), F.lit(null_label))
    for op, bound, label in rules:
        test = _COMPARE[op](value, F.lit(bound))
        expr = F.when(test, F.lit(label)) if expr is None else expr.when(test, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def classify_by(c: ColumnLike, spec) -> Column:
    """``classify`` with a ``(rules, default)`` pair from :mod:`voltaic.config`."""
    rules, default = spec
    return classify(c, rules, default)


def round_half_up(c: ColumnLike, digits: int = 2) -> Column:
    """Round half up in decimal, returned as double.

    The value is taken to decimal(30,8) before rounding, so the result
    does not depend on the binary expansion of the double (1.005 rounds
    to 1.01).  Decimal rounding is exact and the same on every executor.
    """
    return F.round(col_of(c).cast("decimal(30,8)"), digits).cast("double")


def safe_div(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(col_of(a), col_of(b))


def pct(part: ColumnLike, whole: ColumnLike, digits: int = 2) -> Column:
    """round(part / whole * 100, digits); NULL for a zero whole."""
    return round_half_up(safe_div(part, whole) * F.lit(100), digits)


def row_sum(cols: Iterable[ColumnLike]) -> Column:
    """Sum of columns within a row, left to right."""
    return reduce(add, [col_of(c) for c in cols])


def to_number(c: ColumnLike, dtype: str = "double") -> Column:
    """Non-numeric text to NULL instead of an error."""
    return F.trim(col_of(c).cast("string")).try_cast(dtype)


def hour_ending_ts(date: ColumnLike, hour: ColumnLike) -> Column:
    """Plot time of an hour-ending row: date + hour hours (hour 24 is the
    next midnight), as timestamp without time zone."""
    return (col_of(date).cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), col_of(hour).cast("int")))


def coalesce_zero(c: ColumnLike) -> Column:
    return F.coalesce(col_of(c), F.lit(0.0))
