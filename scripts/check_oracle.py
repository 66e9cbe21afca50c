"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

usage: python scripts/check_oracle.py [--sf DIR] [name ...]

Comparison mirrors the driver's gate: columns sorted by name, row count,
then an order-insensitive comparison of the values.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tastebud.plans.registry import all_queries  # noqa: E402
from tastebud.session import build_session  # noqa: E402
from tastebud.sources.catalog import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if hasattr(v, "tolist"):
        return tuple(norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows(df):
    cols = sorted(df.columns)
    out = [tuple(norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(out, key=repr)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    qs = all_queries()
    names = a.names or sorted(qs)
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    bad = 0
    for n in names:
        q = qs[n]
        t0 = time.time()
        try:
            sdf = q.fn(spark, a.sf)
            schema = [(f.name, f.dataType.simpleString()) for f in sdf.schema.fields]
            pdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"ROWS {n}: {len(pdf)} rows spark={ts:.1f}s (no oracle) schema={schema}")
            continue
        t0 = time.time()
        try:
            ddf = con.execute(q.sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        td = time.time() - t0
        sc, sr = rows(pdf)
        dc, dr = rows(ddf)
        if sc != dc:
            print(f"FAIL {n}: columns spark={sc} duck={dc}")
            bad += 1
            continue
        if len(sr) != len(dr):
            print(f"FAIL {n}: rows spark={len(sr)} duck={len(dr)}")
            bad += 1
            continue
        diff = [(x, y) for x, y in zip(sr, dr) if x != y]
        if diff:
            print(f"FAIL {n}: {len(diff)} differing rows of {len(sr)}; first {diff[:3]}")
            bad += 1
            continue
        print(f"OK   {n}: {len(sr)} rows spark={ts:.1f}s duck={td:.1f}s "
              f"dtypes spark={list(pdf.dtypes.astype(str))} duck={list(ddf.dtypes.astype(str))}")
    print(f"{len(names) - bad}/{len(names)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
