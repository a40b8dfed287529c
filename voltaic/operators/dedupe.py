"""Keep the last published row per key."""

from __future__ import annotations

import re
from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OrderSpec = Sequence[str | tuple[str, bool]]

_NARROW = ("tinyint", "smallint", "int", "date", "boolean")
_MICROS = ("timestamp", "timestamp_ntz")
_WIDE = ("bigint",)
_NEGATABLE = ("float", "double")
# Multiplier that keeps the second column (shifted to 1 .. 2^64, NULL 0)
# below one step of the first.
_STEP = 2 * 10 ** 19


def _normalise(order: OrderSpec, descending: bool) -> list[tuple[str, bool]]:
    return [(o, descending) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]


def _big(n: int) -> Column:
    return F.lit(Decimal(n)).cast("decimal(20,0)")


def _integer(name: str, dtype: str) -> Column:
    """An order column as an exact integer in decimal(20,0)."""
    c = F.col(name)
    if dtype == "date":
        c = F.unix_date(c)
    elif dtype == "timestamp":
        c = F.unix_micros(c)
    elif dtype == "timestamp_ntz":
        # From the fields, so that no session time zone enters.
        seconds = F.unix_date(c.cast("date")).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
        c = seconds * 1000000 + (F.date_part(F.lit("SECOND"), c) * 1000000).cast("bigint")
    elif dtype == "boolean":
        c = c.cast("int")
    return c.cast("decimal(20,0)")


def _comparable(name: str, dtype: str, desc: bool) -> Column:
    """A struct that sorts as the column does, greatest first; NULL is least."""
    c = F.col(name)
    if desc:
        value = c
    elif dtype in (*_NARROW, *_MICROS, *_WIDE):
        value = -_integer(name, dtype)
    elif dtype in _NEGATABLE or dtype.startswith("decimal"):
        value = -c
    elif dtype == "string":
        # Complement of the UTF-8 bytes as hex digits; "G" puts a text
        # before the longer ones that it starts.
        value = F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    else:
        raise ValueError(f"cannot order {name} ({dtype}) ascending")
    return F.struct(c.isNotNull().alias("some"), value.alias("value"))


def order_key(df: DataFrame, order: OrderSpec, descending: bool = True) -> Column:
    """One column whose maximum is the first row by ``order``; never NULL.

    A NULL order value comes last, in either direction.  Whole decimals
    (``pack_order`` makes one), integers, dates and
    timestamps, alone or as a (date or timestamp or int, integer or
    timestamp) pair, are packed into one exact decimal, whose aggregate
    buffer is fixed width, so ``max_by`` stays a hash aggregate and nothing
    is sorted.  Whether a pair can be packed follows from its types alone.
    Other types and longer orders give a struct (a sort-based aggregate,
    still partial before its shuffle).
    """
    spec = _normalise(order, descending)
    types = dict(df.dtypes)
    missing = [c for c, _ in spec if c not in types]
    if missing or not spec:
        raise ValueError(f"order columns are missing: {missing or 'none given'}")
    kinds = [types[c] for c, _ in spec]
    if len(spec) == 1 and re.fullmatch(r"decimal\(\d+,0\)", kinds[0]):
        c = F.col(spec[0][0]).cast("decimal(38,0)")
        return F.coalesce(c if spec[0][1] else -c, F.lit(Decimal(1 - 10 ** 38)).cast("decimal(38,0)"))
    signed = [_integer(c, t) if d else -_integer(c, t) for (c, d), t in zip(spec, kinds)
              if t in (*_NARROW, *_MICROS, *_WIDE)]
    if len(spec) == 1 and signed:
        return F.coalesce(signed[0], _big(-10 ** 19))
    if len(spec) == 2 and len(signed) == 2 and kinds[0] not in _WIDE:
        high = F.coalesce(signed[0], _big(-4 * 10 ** 18))
        low = F.coalesce(signed[1] + _big(2 ** 63 + 1),
                         _big(0))
        return ((high * _big(_STEP)).cast("decimal(38,0)") + low).cast("decimal(38,0)")
    return F.struct(*[_comparable(c, t, d).alias(f"o{i}")
                      for i, ((c, d), t) in enumerate(zip(spec, kinds))])


def keep_last(df: DataFrame, keys: Sequence[str], order: OrderSpec,
              descending: bool = True, drop_order: bool = False) -> DataFrame:
    """One row per ``keys``: the first row by ``order`` (descending by default,
    i.e. the last published).  ``order`` must be a total order within a key,
    otherwise the survivor is not determined.  A NULL order value comes last,
    so a key whose only row has one keeps that row.

    Always one aggregate with ``max_by`` on ``order_key``: Spark combines
    map-side before the shuffle, so a key that holds a third of all rows
    costs one small partial row per task, not one huge sorted group.
    """
    keys = list(keys)
    order_cols = [c for c, _ in _normalise(order, descending)]
    rest = [c for c in df.columns if c not in keys and not (drop_order and c in order_cols)]
    best = order_key(df, order, descending)
    keyed = df.select(*keys, *rest, best.alias("__order"))
    if not rest:
        return keyed.select(*keys).distinct()
    return keyed.groupBy(*keys).agg(*[F.max_by(F.col(c), F.col("__order")).alias(c) for c in rest])


#: Files below which the dictionary of their paths is broadcast: a path takes
#: some hundred bytes.
FEW_FILES = 10_000
# A place in a file has at most 23 digits, the rank of a path 15.
_PLACES = 10 ** 23


def pack_order(df: DataFrame, path: str = "_published_at", place: str = "_row_id", out: str = "_order") -> DataFrame:
    """Publication order of rows read from files as one exact decimal.

    The distinct paths are sorted once, which gives each a number in path
    order; the number is joined back and packed with the row's place in its
    file.  ``keep_last`` on the result is a hash aggregate of fixed-width
    buffers, while an order by path text would sort all rows.  ``path`` and
    ``place`` go.  The dictionary is broadcast if it has few rows, which one
    count of it checks; a NULL path comes last.
    """
    paths = df.select(path).where(F.col(path).isNotNull()).distinct()
    few = paths.limit(FEW_FILES + 1).count() <= FEW_FILES
    # Numbers grow with the partition and with the row in it, and partitions
    # of a sorted frame are in order.
    ranks = paths.orderBy(path).select(path, (F.monotonically_increasing_id() + 1).alias("__rank"))
    joined = df.join(F.broadcast(ranks) if few else ranks, path, "left")
    rank = F.coalesce(F.col("__rank"), F.lit(0)).cast("decimal(15,0)")
    packed = rank * F.lit(Decimal(_PLACES)).cast("decimal(24,0)") + F.coalesce(F.col(place), F.lit(0)).cast("decimal(23,0)")
    return joined.withColumn(out, packed.cast("decimal(38,0)")).drop(path, place, "__rank")
