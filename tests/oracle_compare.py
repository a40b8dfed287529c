"""Run a registered query in Spark and its oracle SQL in DuckDB on the same
parquet tables, and compare row count, column names and values the way
the driver does (columns sorted by name, rows order-insensitive)."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from voltaic.sources.bindings import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, (bool,)):
        return bool(v)
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _norm(v.item())
    except ImportError:
        pass
    return v


def canonical(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, sf_dir: str, queries, oracle, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries[name](spark, sf_dir).toPandas()
    t1 = time.time()
    out = {"query": name, "spark_rows": len(sdf), "spark_sec": round(t1 - t0, 2)}
    if name not in oracle:
        out["status"] = "rows-only"
        return out
    odf = con.execute(oracle[name]).df()
    out["oracle_rows"] = len(odf)
    if sorted(sdf.columns) != sorted(odf.columns):
        out["status"] = "schema"
        out["detail"] = (sorted(set(sdf.columns) - set(odf.columns)),
                         sorted(set(odf.columns) - set(sdf.columns)))
        return out
    a, b = canonical(sdf), canonical(odf)
    if a == b:
        out["status"] = "match"
    else:
        out["status"] = "values"
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["detail"] = {"cols": sorted(sdf.columns), "diff": diff}
    return out


if __name__ == "__main__":
    from voltaic.session import local_session
    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] or None
    spark = local_session()
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for n in qs:
        if only and n not in only:
            continue
        try:
            r = compare(spark, n, sf, qs, orc, con)
        except Exception as exc:  # report and continue
            r = {"query": n, "status": "error", "detail": repr(exc)[:500]}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("mismatches:", bad)
