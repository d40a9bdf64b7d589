"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH / ERROR with row counts."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
import traceback
from decimal import Decimal

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from spark_elt.session import TABLES  # noqa: E402


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) if not (isinstance(x, float) and math.isnan(x)) else None for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    from spark_elt.plans.registry import ORACLES, QUERIES, load_all
    from spark_elt.session import build_session

    load_all()
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for key in keys or sorted(QUERIES):
        t0 = time.time()
        try:
            sdf = QUERIES[key](spark, sf_dir)
            spdf = sdf.toPandas()
            t1 = time.time() - t0
            if key not in ORACLES:
                print(f"ROWS   {key}: spark={len(spdf)} ({t1:.1f}s)")
                continue
            dpdf = con.execute(ORACLES[key]).fetchdf()
            if sorted(spdf.columns) != sorted(dpdf.columns):
                bad += 1
                print(f"SCHEMA {key}: spark={sorted(spdf.columns)} duck={sorted(dpdf.columns)}")
                continue
            a, b = rows_of(spdf), rows_of(dpdf)
            if a == b:
                print(f"OK     {key}: rows={len(a)} ({t1:.1f}s)")
            else:
                bad += 1
                sa, sb = set(a), set(b)
                print(f"DIFF   {key}: spark={len(a)} duck={len(b)} only_spark={list(sa - sb)[:2]} only_duck={list(sb - sa)[:2]}")
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR  {key}: {type(e).__name__}: {str(e)[:600]}")
            if "-v" in sys.argv:
                traceback.print_exc()
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
