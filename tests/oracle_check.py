"""Run registered queries against their DuckDB oracles (like the driver does).

usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, schema and value agreement, seconds.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm_value(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return norm_value(v.item())
    if isinstance(v, bool):
        return int(v)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from recspark.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and continue
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(rows)} rows, {dt:.1f}s (no oracle)")
            continue
        try:
            res = con.execute(sqls[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:
            print(f"FAIL {name}: oracle error {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(cols) == sorted(ocols)
        same_n = len(rows) == len(orows)
        same_v = same_cols and canon(rows, cols) == canon(orows, ocols)
        ok = same_cols and same_n and same_v
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: rows {len(rows)}/{len(orows)} cols {same_cols} "
              f"values {same_v} {dt:.1f}s" + ("" if same_cols else f" {sorted(cols)} vs {sorted(ocols)}"))
        if same_cols and same_n and not same_v:
            a, b = canon(rows, cols), canon(orows, ocols)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print("     first diffs:", diff)
    print(f"done, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
