"""Run catalogue queries on Spark and their SQL twins on DuckDB, compare.

Usage: python tests/oracle_harness.py [sf_dir] [key ...]
Compares row count, column names, and the sorted rows (doubles compared
after rounding to 6 decimals, which both sides already apply).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    problems = []
    if sorted(spark_cols) != sorted(duck_cols):
        problems.append(f"columns differ: spark={sorted(spark_cols)} duck={sorted(duck_cols)}")
        return problems
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=repr)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=repr)
    if len(s) != len(d):
        problems.append(f"rows differ: spark={len(s)} duck={len(d)}")
    else:
        bad = [(a, b) for a, b in zip(s, d) if a != b]
        if bad:
            problems.append(f"{len(bad)} rows differ, first: spark={bad[0][0]} duck={bad[0][1]} cols={order}")
    return problems


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as entry
    from shopcast.session import get_spark
    spark = get_spark()
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    keys = keys or list(qs)
    ok = 0
    for k in keys:
        t = time.time()
        try:
            df = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            continue
        ts = time.time() - t
        if k not in sqls:
            print(f"ROWS {k}: {len(srows)} rows (no SQL twin) {ts:.1f}s")
            ok += 1
            continue
        try:
            cur = con.execute(sqls[k])
            dcols = [c[0] for c in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:600]}")
            continue
        probs = compare(srows, scols, drows, dcols)
        if probs:
            print(f"FAIL {k}: " + "; ".join(probs))
        else:
            ok += 1
            print(f"OK   {k}: {len(srows)} rows {ts:.1f}s")
    print(f"{ok}/{len(keys)} passed")


if __name__ == "__main__":
    main(sys.argv)
