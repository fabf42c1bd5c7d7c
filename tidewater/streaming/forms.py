"""Structured Streaming forms.

* Stateless operators (parsers, filters, routing, lookups against static
  tables, cleaning) are the batch functions applied to a streaming DataFrame.
* Windowed aggregates are the batch functions with a watermarked event-time
  column (``event_col``); distinct counts chain two of them; they run in append mode and emit each window once it closes.
* Interval joins are stream-stream joins whose range condition is on the
  watermarked timestamps, so Spark can evict join state.
* Per-key state operators live in ``streaming/stateful.py``.
* Operators that need the whole of a closed window or a table snapshot
  (top-N, changelog apply, dimension upsert, incremental listings) run per
  micro-batch in ``foreachBatch``; every batch write is idempotent by batch id.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.patterns import top_monitors
from ..sources import runs as R
from ..sources import sinks as K


def watermarked(df: DataFrame, ts_ms: str = "ts", delay: str = "1 second",
                event_col: str = "et") -> DataFrame:
    """Event time from epoch millis plus a bounded-disorder watermark
    (``'0 seconds'`` for ascending timestamps)."""
    return df.withColumn(event_col, F.timestamp_millis(F.col(ts_ms))).withWatermark(event_col, delay)


def _interval(ms: int) -> F.Column:
    return F.make_dt_interval(secs=F.lit(ms / 1000.0).cast("decimal(18,6)"))


def interval_join_stream(left: DataFrame, right: DataFrame, on: Sequence[str], left_et: str,
                         right_et: str, lo_ms: int, hi_ms: int, lo_inclusive: bool = True,
                         hi_inclusive: bool = True) -> DataFrame:
    """J0 stream form: ``right_et`` in ``[left_et + lo, left_et + hi]`` on the
    keys.  Both inputs must carry watermarks on ``left_et`` / ``right_et``;
    the join keeps each row only as long as a partner can still arrive (the
    global watermark is the minimum of the inputs, T14)."""
    l, r = left.alias("l"), right.alias("r")
    lt, rt = F.col(f"l.{left_et}"), F.col(f"r.{right_et}")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on]
    cond.append(rt >= lt + _interval(lo_ms) if lo_inclusive else rt > lt + _interval(lo_ms))
    cond.append(rt <= lt + _interval(hi_ms) if hi_inclusive else rt < lt + _interval(hi_ms))
    c = cond[0]
    for x in cond[1:]:
        c = c & x
    return l.join(r, c, "inner")


def top_n_per_batch(target: str, n: int = 5, **kw) -> Callable[[DataFrame, int], None]:
    """W6 stream form: ``foreachBatch`` handler ranking the windows that the
    upstream append-mode aggregate closed in this batch."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        K.write_once(top_monitors(batch, n, **kw), target, batch_id)
    return handle


def changelog_per_batch(target: str, keys: Sequence[str], seq: str = "seq",
                        table: str = "table_name") -> Callable[[DataFrame, int], None]:
    """S5 stream form: merge each batch of change envelopes into a snapshot
    holding the latest change per (table, primary key), delete markers
    included; ``current_table`` reads it without the deleted rows."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        pk = [F.coalesce(F.col("after")[c], F.col("before")[c]).alias(f"pk_{c}") for c in keys]
        rows = batch.select(table, *pk, "type", "after", seq)
        R.upsert(rows, target, [table, *[f"pk_{c}" for c in keys]], seq, batch_id)
    return handle


def current_table(spark, target: str) -> DataFrame | None:
    """The current table kept by ``changelog_per_batch``."""
    snap = R.read(spark, target)
    return None if snap is None else snap.where(F.col("type") != "delete")


def upsert_per_batch(target: str, keys: Sequence[str], seq: str) -> Callable[[DataFrame, int], None]:
    """K5 stream form: newest row per key wins, one committed version per batch."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        R.upsert(batch, target, keys, seq, batch_id)
    return handle


def unseen_rows(batch: DataFrame, keys_dir: str, batch_id: int, key: str = "dedup_key",
                order: Sequence[str] = ("id",)) -> DataFrame:
    """U4 stream form, check: the first row per key within the batch, minus
    keys that earlier batches recorded (``record_keys``).  The keys are a table
    of sorted runs: a batch adds one run, a bounded number of runs is read."""
    from ..operators.listings import dedup_listings

    return R.missing_from(dedup_listings(batch, key, order), keys_dir, key, batch_id)


def record_keys(rows: DataFrame, keys_dir: str, batch_id: int, key: str = "dedup_key") -> None:
    """U4 stream form, commit: remember this batch's keys (once, however often the batch is given)."""
    R.upsert(rows.select(key), keys_dir, [key], None, batch_id)


def new_listings_per_batch(target: str, key: str = "dedup_key",
                           order: Sequence[str] = ("id",)) -> Callable[[DataFrame, int], None]:
    """U4 stream form: ``foreachBatch`` handler writing the rows whose key no
    earlier batch wrote (first row per key within the batch)."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        fresh = unseen_rows(batch, f"{target}/_keys", batch_id, key, order).persist()
        try:
            K.write_once(fresh, f"{target}/rows", batch_id)
            record_keys(fresh, f"{target}/_keys", batch_id, key)
        finally:
            fresh.unpersist()
    return handle


def start(df: DataFrame, checkpoint: str, sink: str | Callable | None = None, fmt: str = "parquet",
          mode: str = "append", trigger: dict | None = None, query_name: str | None = None):
    """Start a query with a checkpoint (T15: always on) and an ``availableNow``
    trigger unless given; ``sink`` is a path, or a ``foreachBatch`` handler."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if callable(sink):
        return w.foreachBatch(sink).start()
    if fmt == "memory":
        return w.format("memory").start()
    return w.format(fmt).option("path", sink).start()
