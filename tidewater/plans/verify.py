"""Compare registered Spark queries with their DuckDB oracle statements.

    python -m tidewater.plans.verify [--sf DIR] [key ...]

Prints one line per key: row counts on both sides and whether the
order-insensitive multisets of normalised rows agree.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

from .fixtures import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, keys, sf_dir, verbose=False):
    from .catalog import ORACLE, QUERIES, load_all
    load_all()
    con = duck(sf_dir)
    results = {}
    for key in keys:
        t0 = time.time()
        try:
            sdf = QUERIES[key](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # report and continue
            results[key] = ("spark-error", str(e)[:300])
            print(f"{key:28s} SPARK ERROR {str(e)[:300]}", flush=True)
            continue
        t1 = time.time()
        sql = ORACLE.get(key)
        if sql is None:
            results[key] = ("rows-only", len(srows))
            print(f"{key:28s} rows-only spark={len(srows)} ({t1 - t0:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:
            results[key] = ("oracle-error", str(e)[:300])
            print(f"{key:28s} ORACLE ERROR {str(e)[:400]}", flush=True)
            continue
        same_cols = sorted(scols) == sorted(dcols)
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        ok = same_cols and a == b
        results[key] = ("ok" if ok else "mismatch", len(srows), len(drows))
        print(f"{key:28s} {'OK ' if ok else 'BAD'} spark={len(srows)} oracle={len(drows)} "
              f"({t1 - t0:.1f}s){'' if same_cols else f' cols {sorted(scols)} vs {sorted(dcols)}'}",
              flush=True)
        if not ok and verbose:
            only_s = list((a - b).elements())[:5]
            only_d = list((b - a).elements())[:5]
            print("   spark-only:", only_s)
            print("   oracle-only:", only_d)
    return results


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("-v", action="store_true")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    from ..session import build_session
    from .catalog import QUERIES, load_all
    load_all()
    spark = build_session()
    keys = a.keys or sorted(QUERIES)
    res = check(spark, keys, a.sf, verbose=a.v)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print(f"{len(res) - len(bad)}/{len(res)} fine; bad: {bad}")
    return 0 if not bad else 1


if __name__ == "__main__":
    sys.exit(main())
