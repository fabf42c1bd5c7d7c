"""Per-key history and pattern operators, batch form.

Streaming forms with state and timers are in ``streaming/stateful.py``.
All per-key scans go through ``operators/sequence.py`` so a hot key is split
over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .logs import is_entry
from .sequence import first_per_group, with_following, with_prior_max

# fixed values: the violation labels the reference writes
DANGEROUS_DRIVING = "危险驾驶"
CLONED_PLATE = "套牌车辆"
# fixed values: the texts of the alerts
DANGER_TEXT = ("车辆涉嫌危险驾驶，第一次经过卡口时间: ", "第二次经过卡口时间: ", "第二次经过卡口时间: ")
CLONED_TEXT = ("车辆：", " 涉嫌套牌,上次经过卡口时间：", ",本次经过时间：")


def danger_labels(n: int) -> list[str]:
    """The label before each of n passage times; later steps repeat the last one."""
    return [DANGER_TEXT[min(i, len(DANGER_TEXT) - 1)] for i in range(n)]


def unique_visits(page_df: DataFrame, key: str = "common.mid", ts: str = "ts",
                  seq: str = "seq", last_page: str = "page.last_page_id") -> DataFrame:
    """The first entry row per (device, calendar day) by (ts, seq).

    ``ts`` is epoch millis; the day is taken in the session time zone.
    """
    entries = page_df.where(is_entry(last_page))
    day = F.to_date(F.timestamp_millis(F.col(ts)))
    return first_per_group(entries, [F.col(key).alias("_k"), day.alias("_day")], [ts, seq])


def bounces(page_df: DataFrame, within_ms: int = 10_000, key: str = "common.mid",
            ts: str = "ts", seq: str = "seq", last_page: str = "page.last_page_id",
            kind: str = "all", chunk_ms: int | None = None) -> DataFrame:
    """Entry rows not followed, within ``within_ms``, by a non-entry row.

    matched: the immediately next row of the device is an entry, less than
    ``within_ms`` later; timeout: no next row less than ``within_ms`` later.
    ``kind`` selects ``matched`` / ``timeout`` / ``all`` (their union, U1).
    """
    d = page_df.withColumn("_k", F.col(key)).withColumn("_entry", is_entry(last_page))
    d = with_following(d, ["_k"], ts, seq, within_ms, [ts, "_entry"], n=1, chunk=chunk_ms)
    nts, nentry = F.col(f"next1_{ts}"), F.col("next1__entry")
    close = nts.isNotNull() & (nts - F.col(ts) < within_ms)
    matched = close & nentry
    timeout = ~close
    cond = {"matched": matched, "timeout": timeout, "all": matched | timeout}[kind]
    return d.where(F.col("_entry") & cond).drop("_k", "_entry", f"next1_{ts}", "next1__entry")


def danger_drive(cars: DataFrame, within_ms: int = 10_000, key: str = "car_id",
                 ts: str = "ts_ms", seq: str = "seq", factor: float = 1.2, n: int = 3,
                 chunk_ms: int | None = None) -> DataFrame:
    """``n`` overspeed rows (speed > factor * limit) of one car, other rows
    allowed in between, first to last less than ``within_ms`` apart; one result
    per possible first row.  Needs ``speed`` and ``limit_speed`` columns."""
    over = cars.where(F.col("speed") > F.col("limit_speed") * factor)
    d = with_following(over, [key], ts, seq, within_ms, [ts, "action_time"], n=n - 1, chunk=chunk_ms)
    last = F.col(f"next{n - 1}_{ts}")
    hit = d.where(last.isNotNull() & (last - F.col(ts) < within_ms))
    times = [F.col("action_time")] + [F.col(f"next{i}_action_time") for i in range(1, n)]
    return hit.select(
        F.col(key).alias("car_id"),
        F.lit(DANGEROUS_DRIVING).alias("violation"),
        F.col("action_time").alias("create_time"),
        F.concat(*[x for label, t in zip(danger_labels(n), times) for x in (F.lit(label), t)]).alias("description"),
        *[t.alias(f"time_{i + 1}") for i, t in enumerate(times)],
    )


def repeat_plates(cars: DataFrame, within_ms: int = 10_000, key: str = "car_id",
                  ts: str = "ts_ms", seq: str = "seq", chunk_rows: int = 1 << 20) -> DataFrame:
    """A passage whose time is within ``within_ms`` (inclusive) of the latest
    earlier passage time of the same plate, earlier meaning lower ``seq``."""
    d = with_prior_max(cars, [key], seq, ts, out="_prev", chunk_rows=chunk_rows)
    hit = d.where(F.col("_prev").isNotNull() & (F.abs(F.col(ts) - F.col("_prev")) <= within_ms))
    prev_txt = F.date_format(F.timestamp_millis(F.col("_prev")), "yyyy-MM-dd HH:mm:ss")
    a, b, c = (F.lit(x) for x in CLONED_TEXT)
    return hit.select(F.col(key).alias("car_id"), F.lit(CLONED_PLATE).alias("violation"),
                      F.col("action_time").alias("create_time"),
                      F.concat(a, F.col(key), b, prev_txt, c, F.col("action_time")).alias("description"),
                      prev_txt.alias("previous_time"), F.col(seq).alias("seq"))


def top_monitors(bands: DataFrame, n: int = 5, ascending: bool = True,
                 partition_by: Sequence[str] = (),
                 order: Sequence[str] = ("high_speed_count", "middle_speed_count",
                                         "normal_speed_count", "low_speed_count"),
                 window_cols: Sequence[str] = ("start", "end"),
                 tie_break: str = "monitor_id") -> DataFrame:
    """The ``n`` first monitors of each window ordered by the band counts
    (ascending = most free-flowing first), monitor key as tie-break.

    ``row_number() <= n`` lets Catalyst insert a partial group limit before the
    shuffle, so each task forwards at most ``n`` rows per window.
    """
    sort = [F.col(c).asc() if ascending else F.col(c).desc() for c in order]
    w = Window.partitionBy(*window_cols, *partition_by).orderBy(*sort, F.col(tie_break).asc())
    return (bands.withColumn("rank", F.row_number().over(w))
                 .where(F.col("rank") <= n)
                 .withColumn("rank", F.col("rank").cast("long")))
