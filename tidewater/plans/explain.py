"""Plan review: physical operators per registered query.

    python -m tidewater.plans.explain [--sf DIR] [--no-broadcast] [key ...]

Prints, per key, the count of shuffles, broadcasts, join kinds, windows,
aggregates and scans in the executed plan, plus the scans' pushed filters
and read schemas with ``-v``.  ``--no-broadcast`` plans as if every side were
large (as at 100 TB): no broadcast hints, no automatic broadcast, no AQE.
"""

from __future__ import annotations

import argparse
import re
import sys
from collections import Counter

MARKERS = ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
           "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
           "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "WindowGroupLimit",
           "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Expand", "Generate",
           "FileScan", "ArrowEvalPython", "BatchEvalPython")


def summary(plan: str) -> Counter:
    return Counter({m: plan.count(m) for m in MARKERS if plan.count(m)})


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--no-broadcast", action="store_true")
    ap.add_argument("-v", action="store_true")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    from ..operators import joins
    from ..session import build_session
    from .catalog import QUERIES, load_all
    load_all()
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1"} if a.no_broadcast else None
    spark = build_session(extra=extra)
    if a.no_broadcast:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set(joins.BROADCAST_CONF, "0")
    for k in a.keys or sorted(QUERIES):
        plan = QUERIES[k](spark, a.sf)._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        print(f"{k:28s} " + " ".join(f"{m.split()[-1]}={n}" for m, n in s.items()), flush=True)
        if a.v:
            for m in re.findall(r"(PushedFilters: \[[^\]]*\]|ReadSchema: struct<[^>]*>)", plan):
                print("    ", m)
    return 0


if __name__ == "__main__":
    sys.exit(main())
