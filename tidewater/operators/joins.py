"""Joins: interval join, dimension lookups, limit lookups, match-or-timeout,
gazetteer geocoding (J0-J10).

Broadcast is used only behind a size check (``broadcast_if_small``); beyond
the bound the join stays a shuffle join and AQE may still convert it at run
time from measured sizes.  Interval joins add a time bucket to the equi-join
key, so a hot key is spread over its time range instead of pairing all of its
rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 << 20
UNKNOWN_BYTES = 1 << 60   # what Catalyst takes a source of unknown size for is above
BROADCAST_CONF = "spark.tidewater.broadcastMaxBytes"   # session override of the limit


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (what auto-broadcast uses)."""
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(v) if isinstance(v, int) else int(v.toString())
    except Exception:
        return None


def total_bytes(*tables: DataFrame) -> int | None:
    """Sum of the tables' own estimates: a bound for left lookups among them by
    unique ids, whose join Catalyst would estimate as a product."""
    sizes = [estimated_bytes(t) for t in tables]
    return None if None in sizes else sum(sizes)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables a plan scans, once for each scan; sources of unknown size count nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN_BYTES)


def input_partitions(df: DataFrame, bytes_each: int) -> int:
    """Partitions that hold what a plan makes of ``bytes_each`` of its input, at
    least one per core.  A shuffle to a given number of partitions is not
    coalesced, so a task's share does not grow with the tables, whatever
    ``spark.sql.shuffle.partitions`` and the advisory size are."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-input_bytes(df) // bytes_each))


def broadcast_limit(df: DataFrame, max_bytes: int | None = None) -> int:
    if max_bytes is not None:
        return int(max_bytes)
    return int(df.sparkSession.conf.get(BROADCAST_CONF, str(DEFAULT_BROADCAST_BYTES)))


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None, size_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only when the optimizer's size estimate is within
    ``max_bytes`` (default: session setting ``spark.tidewater.broadcastMaxBytes``,
    64 MB); otherwise leave the join to the planner (shuffle join, AQE
    re-planning from runtime statistics).  ``size_bytes`` is a better bound
    where the caller has one."""
    max_bytes = broadcast_limit(df, max_bytes)
    size = estimated_bytes(df) if size_bytes is None else size_bytes
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def _pairs(on: Sequence[str | tuple[str, str]]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str | tuple[str, str]],
                  left_ts: str, right_ts: str, lo: int, hi: int,
                  lo_inclusive: bool = True, hi_inclusive: bool = True,
                  bucket: int | None = None) -> DataFrame:
    """Inner join on the keys with ``right_ts`` in
    ``[left_ts + lo, left_ts + hi]`` (each end inclusive or exclusive).

    Times are numbers in one unit (epoch millis).  Right rows get bucket
    ``floor(ts / width)``; each left row is repeated for the (at most two)
    buckets its range touches, 1.13 on average with the default width of eight
    intervals, so every
    pair is produced once and the equi-join key includes the bucket.  Output:
    all left columns, then the right columns (right copies of same-named keys
    dropped).
    """
    if lo > hi:
        raise ValueError(f"empty interval: lo={lo} > hi={hi}")
    width = int(bucket or 8 * max(hi - lo, 1))
    pairs = _pairs(on)
    lt, rt = F.col(f"_l.{left_ts}"), F.col(f"_r.{right_ts}")
    lb = left.withColumn("_tw_b", F.explode(F.sequence(
        F.floor((F.col(left_ts) + lo) / width).cast("long"),
        F.floor((F.col(left_ts) + hi) / width).cast("long")))).alias("_l")
    rb = right.withColumn("_tw_b", F.floor(F.col(right_ts) / width).cast("long")).alias("_r")
    cond = [F.col(f"_l.{a}") == F.col(f"_r.{b}") for a, b in pairs]
    cond.append(F.col("_l._tw_b") == F.col("_r._tw_b"))
    cond.append(rt >= lt + lo if lo_inclusive else rt > lt + lo)
    cond.append(rt <= lt + hi if hi_inclusive else rt < lt + hi)
    joined = lb.join(rb, on=_and(cond), how="inner")
    same = {b for a, b in pairs if a == b}
    lcols = [F.col(f"_l.{c}") for c in left.columns]
    rcols = [F.col(f"_r.{c}") for c in right.columns if c not in same or c not in left.columns]
    return joined.select(*lcols, *rcols)


def _and(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def lookup(df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str] | dict[str, str],
           dim_key: str = "id", max_broadcast_bytes: int | None = None,
           size_bytes: int | None = None) -> DataFrame:
    """Left lookup of dimension attributes by id; rows without a
    dimension row keep null attributes.  ``columns`` maps dim column -> output
    name (or is a list of dim columns kept under their own names)."""
    cols = dict(columns) if isinstance(columns, dict) else {c: c for c in columns}
    d = dim.select(F.col(dim_key).alias("_tw_dk"), *[F.col(c).alias(o) for c, o in cols.items()])
    d = broadcast_if_small(d, max_broadcast_bytes, size_bytes)
    return df.join(d, F.col(key) == F.col("_tw_dk"), "left").drop("_tw_dk")


def age_years(birthday: Column, ref_date: Column) -> Column:
    """whole 365-day years between a birthday and a reference date."""
    return F.floor(F.datediff(ref_date, F.to_date(birthday)) / 365).cast("int")


def with_speed_limit(cars: DataFrame, limits: DataFrame, default: float = 60.0,
                     keys: Sequence[str] = ("area_id", "road_id", "monitor_id"),
                     max_broadcast_bytes: int | None = None) -> DataFrame:
    """Attach the limit of the car's (area, road, monitor), ``default``
    when none is configured; every row is kept.  When the limit table has
    several rows for a key, the last one read wins in the reference; here the
    highest limit (deterministic) – callers pass one row per key."""
    lim = limits.groupBy(*keys).agg(F.max("speed_limit").alias("_tw_limit"))
    lim = broadcast_if_small(lim, max_broadcast_bytes)
    return (cars.join(lim, list(keys), "left")
                .withColumn("limit_speed", F.coalesce(F.col("_tw_limit"), F.lit(float(default))))
                .drop("_tw_limit"))


def overspeed(cars: DataFrame, limits: DataFrame, default: float = 60.0, factor: float = 1.2,
              ts: str = "ts_ms") -> DataFrame:
    """Passages faster than ``factor`` x the monitor's limit."""
    d = with_speed_limit(cars, limits, default)
    return d.where(F.col("speed") > F.col("limit_speed") * factor).select(
        "car_id", "monitor_id", "road_id", F.col("speed").alias("real_speed"), "limit_speed",
        F.col(ts).alias("action_time"))


def match_or_timeout(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                     wait: int, left_id: str = "seq", right_id: str = "seq") -> DataFrame:
    """J9 (batch form): full outer match within ``±wait`` on ``key``.

    Returns ``key, l_id, r_id, l_ts, r_ts, status`` with status ``matched``,
    ``left_only`` (no counterpart within wait) or ``right_only``.

    One full outer join on (key, time bucket): each right row sits in one
    bucket, each left row is copied to the (at most two) buckets its range
    touches.  A right row without a partner in its bucket has none at all; a
    left row is unmatched when its copies are in every bucket.  One aggregate
    over the join's rows settles that: equal left rows share their fate, so a
    group that missed in all its buckets stands for (copies / buckets) rows.
    The join runs once and no row of a hot key meets rows outside its time
    neighbourhood.  Rows without a time or key match nothing and are reported.
    """
    width = max(2 * int(wait), 1)
    lo_b = F.floor((F.col("l_ts") - wait) / width).cast("long")
    hi_b = F.floor((F.col("l_ts") + wait) / width).cast("long")
    l = (left.select(F.col(key).alias("_k"), F.col(left_id).alias("l_id"), F.col(left_ts).alias("l_ts"))
             .withColumn("_n", F.coalesce(hi_b - lo_b + 1, F.lit(1))).withColumn("_left", F.lit(True))
             .withColumn("_b", F.explode_outer(F.sequence(lo_b, hi_b))).alias("_l"))
    r = (right.select(F.col(key).alias("_k"), F.col(right_id).alias("r_id"), F.col(right_ts).alias("r_ts"))
              .withColumn("_right", F.lit(True))
              .withColumn("_b", F.floor(F.col("r_ts") / width).cast("long")).alias("_r"))
    cond = ((F.col("_l._k") == F.col("_r._k")) & (F.col("_l._b") == F.col("_r._b"))
            & (F.col("_r.r_ts") >= F.col("_l.l_ts") - wait) & (F.col("_r.r_ts") <= F.col("_l.l_ts") + wait))
    status = (F.when(F.col("_left") & F.col("_right"), "matched").when(F.col("_left"), "left_only")
              .otherwise("right_only"))
    j = l.join(r, cond, "full_outer").select(
        F.coalesce(F.col("_l._k"), F.col("_r._k")).alias("_k"), "l_id", "r_id", "l_ts", "r_ts",
        status.alias("status"), "_n", F.col("_l._b").alias("_b"))
    groups = j.groupBy("_k", "l_id", "r_id", "l_ts", "r_ts", "status", "_n").agg(
        F.count("*").alias("_rows"), F.min("_b").alias("_first"), F.max("_b").alias("_last"))
    every = (F.col("_n") == 1) | (F.col("_last") - F.col("_first") + 1 == F.col("_n"))
    times = F.when(F.col("status") != "left_only", F.col("_rows")).when(every, F.col("_rows") / F.col("_n")).otherwise(0)
    return (groups.withColumn("_times", times.cast("int")).where("_times > 0")
                  .withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("_times"))))
                  .select(F.col("_k").alias(key), "l_id", "r_id", "l_ts", "r_ts", "status"))


GEO_FIELDS = ("lon", "lat", "province", "adcode", "district", "town")


def geocode(df: DataFrame, gazetteer: DataFrame, key: Column | str, fallback: Column | str,
            address_col: str = "address", fields: Sequence[str] = GEO_FIELDS,
            max_broadcast_bytes: int | None = None) -> DataFrame:
    """Look the cleaned address up in a gazetteer table; when it is not
    found (or has no fix, lon 0), try the second spelling.  Found rows get
    coordinates and admin fields; others keep nulls."""
    k1 = F.col(key) if isinstance(key, str) else key
    k2 = F.col(fallback) if isinstance(fallback, str) else fallback
    g = gazetteer.select(F.col(address_col).alias("_tw_a"), *fields)
    g = broadcast_if_small(g, max_broadcast_bytes)
    g1 = g.select(F.col("_tw_a").alias("_tw_a1"), *[F.col(f).alias(f"_tw1_{f}") for f in fields])
    g2 = g.select(F.col("_tw_a").alias("_tw_a2"), *[F.col(f).alias(f"_tw2_{f}") for f in fields])
    d = (df.withColumn("_tw_k1", k1).withColumn("_tw_k2", k2)
           .join(g1, F.col("_tw_k1") == F.col("_tw_a1"), "left")
           .join(g2, F.col("_tw_k2") == F.col("_tw_a2"), "left"))
    first_ok = F.col("_tw1_lon").isNotNull() & (F.col("_tw1_lon") != 0)
    d = d.withColumn("geo_source", F.when(first_ok, F.lit("address"))
                                   .when(F.col("_tw2_lon").isNotNull(), F.lit("fallback")))
    for f in fields:
        d = d.withColumn(f, F.when(first_ok, F.col(f"_tw1_{f}")).otherwise(F.col(f"_tw2_{f}")))
    return d.drop("_tw_k1", "_tw_k2", "_tw_a1", "_tw_a2",
                  *[f"_tw1_{f}" for f in fields], *[f"_tw2_{f}" for f in fields])


def has_coordinates(df: DataFrame) -> DataFrame:
    """Keep rows with a latitude and a non-zero longitude."""
    return df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.col("lon") != 0))
