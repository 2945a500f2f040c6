"""Run registered queries in Spark and their oracle SQL in DuckDB; compare like the driver.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""
from __future__ import annotations

import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(float(v)) if v == v else "NaN"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from spendlake.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in orc:
            print(f"ROWS {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            r = con.execute(orc[name])
            ocols = [d[0] for d in r.description]
            orows = r.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        print(f"{'OK  ' if ok else 'FAIL'} {name}: spark {len(rows)} rows, oracle {len(orows)} rows {ts:.1f}s")
        if not ok:
            bad += 1
            if sorted(cols) != sorted(ocols):
                print("   cols spark:", sorted(cols)); print("   cols duck :", sorted(ocols))
            s1, s2 = set(l1), set(l2)
            print("   only spark:", sorted(s1 - s2)[:3])
            print("   only duck :", sorted(s2 - s1)[:3])
    spark.stop()
    print("bad", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
