"""Run every registered query on Spark and its oracle SQL on DuckDB, compare.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
Prints one line per query: rows on both sides, column names, value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.plans.registry import oracle_sql, queries  # noqa: E402
from tessera.session import get_spark  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c]) for c in cols) for _, r in pdf.iterrows()]
    return cols, sorted(out, key=repr)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    spark = get_spark()
    spark.sparkContext.setLogLevel("ERROR")
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            spd = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:24s} rows={len(spd):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            opd = con.sql(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} SQL ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows_of(spd)
        oc, orows = rows_of(opd)
        ok = sc == oc and sr == orows
        bad += not ok
        print(f"{name:24s} spark={len(spd):7d} oracle={len(opd):7d} "
              f"{'OK' if ok else 'MISMATCH'} {ts:.1f}s"
              + ("" if sc == oc else f" cols {sc} vs {oc}"))
        if not ok and sc == oc:
            a, b = set(sr), set(orows)
            print("   only spark:", list(a - b)[:2])
            print("   only oracle:", list(b - a)[:2])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
