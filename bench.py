"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into Spark's ``noop`` sink (full execution, no
collection to the driver).  Prints one JSON line.  ``BENCH_ALL=1`` runs every
registered key; ``BENCH_KEYS=a,b`` a chosen set.  Each figure is the median of
``BENCH_RUNS`` (default 3) runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "e2e_visitor",          # log lines -> flag repair -> UV / bounce / PV -> visitor stats
    "e2e_product",          # interval joins -> 7-way union -> product stats -> dims
    "e2e_province",         # interval join -> 6 dims -> province stats
    "e2e_keyword",          # SQL: declared table -> LATERAL split -> windowed count
    "keyword_stats",        # tokenizer over whole documents -> windowed count
    "e2e_traffic",          # tsv parse -> sliding speed bands -> top 5
    "e2e_danger",           # tsv parse -> limit lookup -> 3-step pattern
    "repeat_plates",        # running max per plate (chunked)
    "avg_speed",            # sliding window average
    "match_timeout",        # full outer interval match
    "cdc_current_table",    # changelog -> current table
    "route_fact",           # config routing
    "dim_upsert",           # snapshot upsert, two batches
    "e2e_listings",         # clean -> dedup -> geocode
    "e2e_bus",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    from tidewater.plans.catalog import QUERIES, load_all
    from tidewater.session import build_session

    load_all()
    if os.environ.get("BENCH_ALL"):
        keys = sorted(QUERIES)
    elif os.environ.get("BENCH_KEYS"):
        keys = [k for k in os.environ["BENCH_KEYS"].split(",") if k]
    else:
        keys = list(HEADLINE)
    # BENCH_EVENT_LOG=<folder> keeps Spark's event log (stage / task times)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")},
                          event_log_dir=os.environ.get("BENCH_EVENT_LOG"))
    # warm-up: JIT and class loading, every measured query once on the
    # smallest data set (steady-state throughput is what is compared)
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm) and warm != sf_dir:
        for k in keys:
            try:
                QUERIES[k](spark, warm).write.format("noop").mode("overwrite").save()
            except Exception:  # reported by the measured run below
                pass
    times, failed = {}, {}
    runs = max(1, int(os.environ.get("BENCH_RUNS", 3)))
    for k in keys:
        took = []
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
                took.append(time.perf_counter() - t0)
        except Exception as e:  # report and go on: one broken query must not hide the others
            failed[k] = str(e).splitlines()[0][:200]
            print(f"# {k}: FAILED {failed[k]}", file=sys.stderr, flush=True)
            continue
        times[k] = round(statistics.median(took), 3)
        print(f"# {k}: {times[k]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {"metric": "total_query_time", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "runs": runs}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
