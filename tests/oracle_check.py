"""Run registered queries in Spark and their DuckDB oracle side by side; print per-query results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as e
    from opinio.session import build_session

    spark = build_session("local[8]", 8)
    qs, oracle = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as ex:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {type(ex).__name__}: {str(ex)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"{name:32s} rows-only  n={len(rows)} {ts:.1f}s")
            continue
        try:
            res = con.execute(oracle[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as ex:  # noqa: BLE001
            print(f"{name:32s} DUCK-ERROR {str(ex)[:300]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        ok = sorted(cols) == sorted(dcols) and len(rows) == len(drows) and h1 == h2
        status = "OK" if ok else "MISMATCH"
        print(f"{name:32s} {status:8s} spark={len(rows)} duck={len(drows)} {ts:.1f}s")
        if not ok:
            bad += 1
            if sorted(cols) != sorted(dcols):
                print("   cols", sorted(cols), sorted(dcols))
            s1, s2 = set(l1), set(l2)
            for x in list(s1 - s2)[:3]:
                print("   spark-only", x[:300])
            for x in list(s2 - s1)[:3]:
                print("   duck-only ", x[:300])
    print("FAILED" if bad else "ALL OK", bad)
    spark.stop()


if __name__ == "__main__":
    main()
