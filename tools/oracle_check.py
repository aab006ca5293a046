"""Run registered queries in Spark and their DuckDB twins; compare results.

Usage: python tools/oracle_check.py [sf_dir] [name-substring ...]

Compares row count, column names and an order-insensitive multiset of rows
(floats rounded to 6 significant decimals).  Mirrors the correctness gate.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from netlens.plans.catalog import load_all  # noqa: E402
from netlens.session import build_session  # noqa: E402
from netlens.sources.testdata import TABLES  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict(recursive=True))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return v


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    reg = load_all()
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, (fn, sql) in reg.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"ok   {name}: spark rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql)
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        msg = []
        if sorted(scols) != sorted(ocols):
            msg.append(f"cols spark={sorted(scols)} oracle={sorted(ocols)}")
        if len(srows) != len(orows):
            msg.append(f"rows spark={len(srows)} oracle={len(orows)}")
        elif not msg and rows_key(srows, scols) != rows_key(orows, ocols):
            a, b = rows_key(srows, scols), rows_key(orows, ocols)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            msg.append(f"values differ e.g. {diff}")
        if msg:
            bad += 1
            print(f"FAIL {name}: " + "; ".join(msg))
        else:
            print(f"ok   {name}: rows={len(srows)} {ts:.1f}s")
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
