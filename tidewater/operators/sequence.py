"""Per-key ordered-history primitives that stay parallel under key skew.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; a
device or car holding a third of all rows would make that one task the whole
job.  The helpers below partition by ``(key, chunk)`` instead, where the chunk
is a slice of event time (look-ahead) or of the source sequence (prefix
scans), and repair the chunk boundaries exactly:

* ``with_following`` – the next ``n`` rows of each row, exact whenever they lie
  within ``horizon`` of it.  Rows in the first ``horizon`` of a chunk are
  copied into the previous chunk as look-ahead (copy factor <= 1 +
  horizon/chunk), so one shuffle suffices and no boundary join is needed.
* ``with_prior_max`` – the running maximum of a value over all *earlier* rows
  of the key.  Inside a chunk it is a window; the carry from earlier chunks
  comes from a per-(key, chunk) pre-aggregate (one row per chunk, map-side
  combined) scanned per key and joined back on (key, chunk), which reuses the
  window's partitioning.
* ``with_previous`` – ``lag`` however far back: the previous sequence number
  is a prior max, the previous row's fields an equi-join on that number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "_tw_chunk"
_OWN = "_tw_own"


def default_chunk(horizon: int, floor: int = 60_000) -> int:
    """Chunk width: 16 horizons (<= 1/16 of rows copied), at least ``floor``."""
    return max(int(horizon) * 16, floor)


def with_following(df: DataFrame, keys: Sequence[str], ts: str, seq: str, horizon: int,
                   fields: Sequence[str], n: int = 1, chunk: int | None = None,
                   prefix: str = "next") -> DataFrame:
    """Add ``{prefix}{i}_{f}`` = field ``f`` of the i-th following row of the same
    key in ``(ts, seq)`` order, for i in 1..n.

    ``ts`` is a numeric event time (e.g. epoch millis) and ``horizon`` is in
    the same unit.  The value is exact whenever the i-th following row has
    ``ts < row.ts + horizon``; otherwise it is null or a row at least
    ``horizon`` later – callers only test conditions bounded by ``horizon``.
    """
    chunk = int(chunk or default_chunk(horizon))
    if chunk < horizon:
        raise ValueError("chunk must be at least the horizon")
    base = df.withColumn(_CHUNK, F.floor(F.col(ts) / F.lit(chunk)).cast("long"))
    look_ahead = (base.where(F.col(ts) - F.col(_CHUNK) * F.lit(chunk) < F.lit(horizon))
                      .withColumn(_CHUNK, F.col(_CHUNK) - 1)
                      .withColumn(_OWN, F.lit(False)))
    both = base.withColumn(_OWN, F.lit(True)).unionByName(look_ahead)
    w = Window.partitionBy(*keys, _CHUNK).orderBy(F.col(ts), F.col(seq))
    cols = [F.lead(F.col(f), i).over(w).alias(f"{prefix}{i}_{f}")
            for i in range(1, n + 1) for f in fields]
    return both.select("*", *cols).where(F.col(_OWN)).drop(_OWN, _CHUNK)


def with_prior_max(df: DataFrame, keys: Sequence[str], seq: str, value: str,
                   out: str = "prior_max", chunk_rows: int = 1 << 20) -> DataFrame:
    """Add ``out`` = max(value) over the earlier rows (by ``seq``) of the key.

    ``seq`` is a global source sequence (offset / event id); chunks are
    ``chunk_rows`` consecutive sequence numbers, so a hot key is spread over
    as many tasks as it spans chunks.
    """
    base = df.withColumn(_CHUNK, F.floor(F.col(seq) / F.lit(chunk_rows)).cast("long"))
    w_in = (Window.partitionBy(*keys, _CHUNK).orderBy(F.col(seq))
                  .rowsBetween(Window.unboundedPreceding, -1))
    inner = base.withColumn("_tw_in", F.max(value).over(w_in))
    # the per-chunk pre-aggregate reads only the key, sequence and value columns
    per_chunk = base.groupBy(*keys, _CHUNK).agg(F.max(value).alias("_tw_cmax"))
    w_c = (Window.partitionBy(*keys).orderBy(_CHUNK)
                 .rowsBetween(Window.unboundedPreceding, -1))
    carry = per_chunk.select(*keys, _CHUNK, F.max("_tw_cmax").over(w_c).alias("_tw_carry"))
    joined = inner.join(carry, [*keys, _CHUNK], "left")
    return (joined.withColumn(out, F.greatest(F.col("_tw_in"), F.col("_tw_carry")))
                  .drop("_tw_in", "_tw_carry", _CHUNK))


def with_previous(df: DataFrame, keys: Sequence[str], seq: str, fields: Sequence[str],
                  prefix: str = "prev_", chunk_rows: int = 1 << 20) -> DataFrame:
    """``lag``: the fields of the previous row (by ``seq``, a unique sequence)
    of the same key, however far back it is.

    The previous sequence number is the running max of ``seq`` over earlier
    rows (``with_prior_max``, chunked); the previous row's fields come from an
    equi-join on that unique number, so no key is gathered into one task.
    """
    d = with_prior_max(df, keys, seq, seq, out="_tw_prev", chunk_rows=chunk_rows)
    prev = df.select(F.col(seq).alias("_tw_prev"), *[F.col(f).alias(f"{prefix}{f}") for f in fields])
    return d.join(prev, "_tw_prev", "left").drop("_tw_prev")


def first_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The first row of each group by ``order`` as a plain aggregate
    (``min_by``): partial aggregation runs map-side, so a hot group is reduced
    to one row per task before the shuffle."""
    cols = df.columns
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    row = F.struct(*[F.col(c) for c in cols])
    ordering = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*key_cols).agg(F.min_by(row, ordering).alias("_tw_row"))
    return agg.select("_tw_row.*")
