"""Spark query vs DuckDB twin, cell by cell (mirrors the driver's correctness gate).

Usage: python tests/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def frame_rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(v) for v in rec))
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "TimestampNTZType": "TIMESTAMP", "TimestampType": "TIMESTAMP WITH TIME ZONE",
                 "BooleanType": "BOOLEAN", "DateType": "DATE", "FloatType": "FLOAT"}


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_types = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
               for f in sdf.schema.fields}
    s_pdf = sdf.toPandas()
    t1 = time.time()
    rel = con.sql(sql)
    d_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    d_pdf = rel.df()
    t2 = time.time()
    sc, sr = frame_rows(s_pdf)
    dc, dr = frame_rows(d_pdf)
    msg = f"{key}: spark {len(sr)} rows {t1 - t0:.1f}s, duck {len(dr)} rows {t2 - t1:.1f}s"
    if sc != dc:
        return False, msg + f" COLUMNS differ: spark-only {set(sc) - set(dc)} duck-only {set(dc) - set(sc)}"
    if len(sr) != len(dr):
        return False, msg + " ROWCOUNT differs"
    types = {c: (s_types[c], d_types[c]) for c in s_types if s_types[c] != d_types.get(c)}
    if types:
        return False, msg + f" TYPES differ: {types}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(c, x, y) for c, x, y in zip(sc, a, b) if x != y]
        return False, msg + f" {len(bad)} rows differ, first: {diff[:4]}"
    return True, msg + " OK"


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as e
    from vigil.session import local_session
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    fails = 0
    for k in (keys or list(qs)):
        if k not in sqls:
            print(f"{k}: no oracle (rows-only)")
            continue
        try:
            ok, msg = compare(spark, con, k, qs[k], sqls[k], sf_dir)
        except Exception as ex:  # noqa: BLE001
            ok, msg = False, f"{k}: ERROR {type(ex).__name__}: {str(ex)[:400]}"
        fails += not ok
        print(msg, flush=True)
    print(f"FAILURES: {fails}")


if __name__ == "__main__":
    main()
