"""Audit physical plans of the registered queries.

usage: python tests/plan_audit.py [sf_dir] [name ...]
For each query prints: scans per table, exchanges, joins by strategy, and
flags cartesian / nested-loop joins and row-at-a-time Python UDFs.
"""

from __future__ import annotations

import collections
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def audit(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = collections.Counter(re.findall(r"FileScan \w+ [^\[]*\[.*?\] .*?Location: \w+ \[file:[^\]]*?/(\w+)\.parquet", plan))
    if not scans:
        scans = collections.Counter(re.findall(r"/(\w+)\.parquet", plan))
    joins = collections.Counter(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|CartesianProduct|BroadcastNestedLoopJoin)", plan))
    return {"scans": dict(scans), "exchanges": plan.count("Exchange "), "joins": dict(joins),
            "flags": [b for b in BAD if b in plan],
            "pandas": plan.count("FlatMapGroupsInPandas") + plan.count("MapInPandas"),
            "wgl": plan.count("WindowGroupLimit")}


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.001"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from recspark.session import get_session
    spark = get_session("local[4]", shuffle_partitions=4)
    qs = E.queries()
    for n in names or list(qs):
        try:
            a = audit(qs[n](spark, sf_dir))
        except Exception as e:
            print(f"{n}: ERROR {type(e).__name__} {str(e)[:200]}")
            continue
        print(f"{n}: {a}")


if __name__ == "__main__":
    main()
