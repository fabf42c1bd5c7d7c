"""Streaming forms of the per-key state operators.

Each operator is a ``StatefulProcessor`` run with
``groupBy(key).transformWithStateInPandas``: rows of one key arrive as pandas
batches (Arrow transfer), state lives in the state store (RocksDB, so it may
outgrow memory) and is checkpointed with the query, so a restarted or
re-scheduled task resumes exactly.  Keys are hash-partitioned over
``spark.sql.shuffle.partitions`` tasks.

Event-time operators buffer only the rows that are not yet decidable: a row
is decided once the watermark has passed ``row.ts + within`` – every row that
could change its outcome has then arrived.  The last rows of a finite input
are decided when a later row moves the watermark (tests append a sentinel).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from ..operators.patterns import CLONED_PLATE, CLONED_TEXT, DANGEROUS_DRIVING, danger_labels

DAY_MS = 86_400_000


def _concat(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = list(rows)
    return pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]


# ------------------------------------------------------------------- W1
class FirstVisitPerDay(StatefulProcessor):
    """First entry row per device and calendar day (UTC).

    Seen days live in a map state; an event-time timer drops a day once the
    watermark is ``retain_ms`` past its end (the reference keeps the marker
    24 h after writing it).  Event time rather than a processing-time TTL
    makes re-runs deterministic and lets an ``availableNow`` run finish.
    """

    def __init__(self, retain_ms: int = DAY_MS):
        self.retain = int(retain_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen_days", "day long", "seen boolean")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = None  # the first row of each day so far, chunk by chunk
        for part in rows:
            part = part.assign(_day=part["ts"] // DAY_MS)
            part = part if pdf is None else pd.concat([pdf, part], ignore_index=True)
            pdf = part.sort_values(["ts", "seq"], kind="stable").drop_duplicates("_day", keep="first")
        keep = []
        for day in pdf["_day"].tolist():
            fresh = not self.seen.containsKey((int(day),))
            if fresh:
                self.seen.updateValue((int(day),), (True,))
                self.handle.registerTimer((int(day) + 1) * DAY_MS + self.retain)
            keep.append(fresh)
        yield pdf.loc[keep].drop(columns="_day")

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        day = (expiredTimerInfo.getExpiryTimeInMs() - self.retain) // DAY_MS - 1
        self.seen.removeKey((int(day),))
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def unique_visits_stream(entries: DataFrame, key: str = "mid", retain_ms: int = DAY_MS) -> DataFrame:
    """W1 stream form.  ``entries``: flat entry-page rows with ``ts`` (millis)
    and ``seq`` plus a watermarked event-time column; output has the input
    columns."""
    return entries.groupBy(key).transformWithStateInPandas(
        statefulProcessor=FirstVisitPerDay(retain_ms), outputStructType=entries.schema,
        outputMode="Append", timeMode="EventTime")


class FirstVisitPerDayTTL(StatefulProcessor):
    """W1 as the reference writes it: the seen-day marker is a value state
    with a 24 h processing-time TTL, refreshed on write, compared with the
    row's day.  For continuous (processing-time) triggers; under
    ``availableNow`` the TTL keeps scheduling empty batches."""

    def __init__(self, ttl_ms: int = DAY_MS):
        self.ttl = int(ttl_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_day", "day long", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _concat(rows).sort_values(["ts", "seq"], kind="stable")
        last = self.last.get()[0] if self.last.exists() else None
        keep = []
        for day in (pdf["ts"] // DAY_MS).tolist():
            fresh = last is None or int(day) != last
            if fresh:
                last = int(day)
            keep.append(fresh)
        if last is not None:
            self.last.update((last,))
        yield pdf.loc[keep]

    def close(self) -> None:
        pass


def unique_visits_stream_ttl(entries: DataFrame, key: str = "mid", ttl_ms: int = DAY_MS) -> DataFrame:
    """W1 stream form with the processing-time state TTL."""
    return entries.groupBy(key).transformWithStateInPandas(
        statefulProcessor=FirstVisitPerDayTTL(ttl_ms), outputStructType=entries.schema,
        outputMode="Append", timeMode="ProcessingTime")


# ------------------------------------------------------------------- W2
class NewFlagRepair(StatefulProcessor):
    """Only the first row flagged '1' of a device keeps the flag."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen_new", "seen boolean")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        if self.seen.exists():  # nothing to order: chunk by chunk
            for pdf in rows:
                yield pdf.assign(is_new=pdf["is_new"].where(pdf["is_new"] != "1", "0"))
            return
        first = None  # the earliest flagged row so far; all others can go out
        for pdf in rows:
            ones = pdf["is_new"] == "1"
            yield pdf[~ones]
            held = pdf[ones] if first is None else pd.concat([first, pdf[ones]], ignore_index=True)
            if len(held):
                held = held.sort_values("seq", kind="stable")
                first = held.iloc[:1]
                yield held.iloc[1:].assign(is_new="0")
        if first is not None:
            self.seen.update((True,))
            yield first

    def close(self) -> None:
        pass


def fix_is_new_stream(logs: DataFrame, key: str = "mid") -> DataFrame:
    """W2 stream form over flat rows with ``is_new`` and ``seq``."""
    return logs.groupBy(key).transformWithStateInPandas(
        statefulProcessor=NewFlagRepair(), outputStructType=logs.schema,
        outputMode="Append", timeMode="None")


# ------------------------------------------------------------ W3 / W4
#: Width of a state's time chunk in horizons: a row in five is copied at most.
CHUNK_HORIZONS = 4


def chunked(rows: DataFrame, within_ms: int) -> DataFrame:
    """Rows with their time chunk; those of a chunk's first ``within_ms`` also as
    look-ahead of the chunk before (``own`` false).  State keyed by (key, chunk)
    spreads a key that holds most rows over its time, and every row finds what
    follows it within the horizon in its own chunk."""
    width = CHUNK_HORIZONS * int(within_ms)
    chunk = F.floor(F.col("ts") / width).cast("long")
    copies = F.when(F.col("ts") - chunk * width < within_ms, F.array(chunk, chunk - 1)).otherwise(F.array(chunk))
    out = rows.withColumn("chunk", F.explode(copies))
    return out.withColumn("own", F.col("chunk") == chunk)


class _Buffered(StatefulProcessor):
    """Rows of one (key, chunk), appended as they come and read when the
    watermark has passed a multiple of the horizon: each row is read five times
    at most, whatever the size of a micro-batch.  A chunk's state is gone when
    its last row is decided."""

    state_schema = ""
    columns: tuple[str, ...] = ()
    with_payload = False

    def __init__(self, within_ms: int):
        self.within = int(within_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buffer", self.state_schema)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        wm = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            new = pdf[pdf["ts"] >= wm] if wm > 0 else pdf      # late rows are dropped
            if len(new):
                new = new.assign(**{c: None for c in self.columns if c not in new.columns})
                self.buf.appendList([tuple(r) for r in new[list(self.columns)].itertuples(index=False, name=None)])
                due = new.loc[new["own"], "ts"].to_numpy() + self.within
                for t in set((-(-due // self.within) * self.within).tolist()):
                    self.handle.registerTimer(int(t))
        yield self.decide(key, pd.DataFrame(columns=list(self.columns)), pd.Series([], dtype=bool))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs()
        buf = pd.DataFrame(list(self.buf.get()) if self.buf.exists() else [], columns=list(self.columns))
        buf = buf.sort_values(["ts", "seq"], kind="stable").reset_index(drop=True)
        decided = buf["ts"] + self.within <= wm
        if decided.any():
            rest = buf[~decided]
            if rest["own"].any():
                self.buf.put([tuple(r) for r in rest.itertuples(index=False, name=None)])
            elif wm >= (key[-1] + 1) * CHUNK_HORIZONS * self.within + self.within:
                self.buf.clear()  # look-ahead rows alone, and no row of the chunk can come any more
            else:
                self.buf.put([tuple(r) for r in rest.itertuples(index=False, name=None)]) if len(rest) else self.buf.clear()
        yield self.decide(key, buf, decided & buf["own"].astype(bool))

    def close(self) -> None:
        pass


class BounceDetector(_Buffered):
    """Entry rows whose next row is an entry less than ``within`` later
    (matched) or that have no next row within it (timeout).  An optional
    ``payload`` text (e.g. the record as JSON) is carried to the output."""

    state_schema = "ts long, seq long, own boolean, entry boolean, page_id string, payload string"
    columns = ("ts", "seq", "own", "entry", "page_id", "payload")

    def decide(self, key, buf: pd.DataFrame, decided) -> pd.DataFrame:
        nts = buf["ts"].shift(-1)
        nentry = buf["entry"].shift(-1)
        close = nts.notna() & (nts - buf["ts"] < self.within)
        matched = close & (nentry == True)  # noqa: E712
        timeout = ~close
        keep = decided & buf["entry"].astype(bool) & (matched | timeout)
        out = pd.DataFrame({"mid": key[0], "ts": buf.loc[keep, "ts"], "seq": buf.loc[keep, "seq"],
                            "page_id": buf.loc[keep, "page_id"],
                            "kind": matched[keep].map({True: "matched", False: "timeout"})})
        if self.with_payload:
            out["payload"] = buf.loc[keep, "payload"]
        return out


def bounces_stream(pages: DataFrame, within_ms: int = 10_000, key: str = "mid",
                   payload: bool = False) -> DataFrame:
    """W3 stream form.  ``pages``: flat rows ``mid, ts (millis), seq,
    page_id, entry`` (and ``payload`` text when ``payload``) with a watermark
    on an event-time column."""
    proc = BounceDetector(within_ms)
    proc.with_payload = payload
    schema = "mid string, ts long, seq long, page_id string, kind string" + (", payload string" if payload else "")
    return chunked(pages, within_ms).groupBy(key, "chunk").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=schema, outputMode="Append", timeMode="EventTime")


class ThreeStepDetector(_Buffered):
    """``n`` overspeed rows of one car within ``within`` (relaxed
    contiguity: the input holds only overspeed rows)."""

    state_schema = "ts long, seq long, own boolean, action_time string"
    columns = ("ts", "seq", "own", "action_time")
    n = 3

    def decide(self, key, buf: pd.DataFrame, decided) -> pd.DataFrame:
        last = buf["ts"].shift(1 - self.n)
        keep = decided & last.notna() & (last - buf["ts"] < self.within)
        times = [buf["action_time"].shift(-i)[keep] for i in range(self.n)]
        text = ""
        for label, t in zip(danger_labels(self.n), times):
            text = text + label + t
        return pd.DataFrame({"car_id": key[0], "violation": DANGEROUS_DRIVING, "create_time": times[0], "description": text,
                             **{f"time_{i + 1}": t for i, t in enumerate(times)}})


def danger_drive_stream(overspeed: DataFrame, within_ms: int = 10_000, key: str = "car_id", n: int = 3) -> DataFrame:
    """W4 stream form over overspeed rows ``car_id, ts (millis), seq,
    action_time`` with a watermark."""
    proc = ThreeStepDetector(within_ms)
    proc.n = n
    return chunked(overspeed, within_ms).groupBy(key, "chunk").transformWithStateInPandas(
        statefulProcessor=proc,
        outputStructType="car_id string, violation string, create_time string, description string, "
                         + ", ".join(f"time_{i + 1} string" for i in range(n)),
        outputMode="Append", timeMode="EventTime")


# ------------------------------------------------------------------- W5
class DuplicatePlate(StatefulProcessor):
    """Passage within ``within`` of the latest earlier passage time."""

    def __init__(self, within_ms: int):
        self.within = int(within_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prev = handle.getValueState("max_ts", "ts long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _concat(rows).sort_values("seq", kind="stable").reset_index(drop=True)
        start = self.prev.get()[0] if self.prev.exists() else None
        before = pdf["ts"].cummax().shift(1)
        if start is not None:
            before = before.fillna(start).clip(lower=start)
        hit = before.notna() & ((pdf["ts"] - before).abs() <= self.within)
        self.prev.update((int(max(pdf["ts"].max(), start if start is not None else pdf["ts"].max())),))
        out = pdf.loc[hit, ["car_id", "action_time", "seq"]].assign(previous_ts=before[hit].astype("int64"))
        times = pd.to_datetime(out["previous_ts"], unit="ms").dt.strftime("%Y-%m-%d %H:%M:%S")
        a, b, c = CLONED_TEXT
        yield out.assign(violation=CLONED_PLATE, description=a + out["car_id"] + b + times + c + out["action_time"])

    def close(self) -> None:
        pass


def repeat_plates_stream(cars: DataFrame, within_ms: int = 10_000, key: str = "car_id") -> DataFrame:
    """W5 stream form over ``car_id, ts (millis), seq, action_time``."""
    return cars.groupBy(key).transformWithStateInPandas(
        statefulProcessor=DuplicatePlate(within_ms),
        outputStructType="car_id string, action_time string, seq long, previous_ts long, violation string, "
                         "description string",
        outputMode="Append", timeMode="None")


# ------------------------------------------------------------------- J9
class MatchOrTimeout(StatefulProcessor):
    """Rows wait in a map state by (side, time bucket), a bucket being as
    wide as the wait: partners lie in the same bucket or a neighbour, and only
    those are read and only touched buckets written.  Pairs are found by binary
    search in sorted times.  Once the watermark has passed the last moment at which
    a bucket's rows can match, those that never did are reported and the bucket
    goes.  The same pairs and single rows as the batch form."""

    def __init__(self, wait_ms: int):
        self.wait = int(wait_ms)
        self.width = max(self.wait, 1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # a bucket's rows: (ts, id, met) as 64-bit numbers
        self.waiting = handle.getMapState("waiting", "side string, bucket long", "rows binary")

    def _get(self, side: str, bucket: int) -> np.ndarray:
        k = (side, int(bucket))
        if not self.waiting.containsKey(k):
            return np.zeros((0, 3), dtype=np.int64)
        return np.frombuffer(bytes(self.waiting.getValue(k)[0]), dtype=np.int64).reshape(-1, 3).copy()

    def _match(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all pairs (left, right) within the wait; ``right`` is sorted by time."""
        lo = np.searchsorted(right[:, 0], left[:, 0] - self.wait, side="left")
        n = np.searchsorted(right[:, 0], left[:, 0] + self.wait, side="right") - lo
        return (np.repeat(np.arange(len(left)), n), np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        k = key[0] if isinstance(key, tuple) else key
        for pdf in rows:
            held: dict[tuple[str, int], np.ndarray] = {}

            def bucket(side: str, b: int) -> np.ndarray:
                if (side, b) not in held:
                    held[side, b] = self._get(side, b)
                return held[side, b]

            touched = set()
            for side, other in (("L", "R"), ("R", "L")):  # right rows also meet the left ones of this part
                own = pdf[pdf["side"] == side]
                new = np.stack([own["ts"].to_numpy(dtype=np.int64), own["seq"].to_numpy(dtype=np.int64),
                                np.zeros(len(own), dtype=np.int64)], axis=1)
                at = new[:, 0] // self.width
                for b in np.unique(at).tolist():
                    mine = new[at == b]
                    for near in (b - 1, b, b + 1):
                        theirs = bucket(other, near)
                        i, j = self._match(mine, theirs)
                        if len(i):
                            mine[i, 2] = theirs[j, 2] = 1
                            touched.add((other, near))
                            l, r = (mine[i], theirs[j]) if side == "L" else (theirs[j], mine[i])
                            yield self._frame(k, l, r, "matched")
                    both = np.concatenate([bucket(side, b), mine])
                    held[side, b] = both[np.argsort(both[:, 0], kind="stable")]
                    touched.add((side, b))
                    self.handle.registerTimer(int((b + 1) * self.width + self.wait))
            for side, b in touched:
                self.waiting.updateValue((side, b), (held[side, b].tobytes(),))
        yield self._frame(k, None, None, "matched")

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        k = key[0] if isinstance(key, tuple) else key
        b = (expiredTimerInfo.getExpiryTimeInMs() - self.wait) // self.width - 1
        for side, status in (("L", "left_only"), ("R", "right_only")):
            rows = self._get(side, b)
            if len(rows):
                self.waiting.removeKey((side, int(b)))
            alone = rows[rows[:, 2] == 0]
            yield self._frame(k, alone if side == "L" else None, alone if side == "R" else None, status)

    @staticmethod
    def _frame(k, left: np.ndarray | None, right: np.ndarray | None, status: str) -> pd.DataFrame:
        n = max(len(x) for x in (left, right, ()) if x is not None)
        column = lambda rows, c: pd.array([None] * n if rows is None else rows[:, c], dtype="Int64")
        text = lambda v: pd.Series([v] * n, dtype=object)
        return pd.DataFrame({"car_id": text(k), "l_id": column(left, 1), "r_id": column(right, 1),
                             "l_ts": column(left, 0), "r_ts": column(right, 0), "status": text(status)})

    def close(self) -> None:
        pass


def match_or_timeout_stream(left: DataFrame, right: DataFrame, key: str, event_col: str,
                            wait_ms: int, delay: str | None = "3 seconds") -> DataFrame:
    """J9 stream form: ``left`` / ``right`` have ``key, ts (millis), seq`` and
    an event-time column; they are unioned, watermarked (``delay``; pass None
    when the inputs already carry watermarks) and keyed."""
    cols = [key, "ts", "seq", event_col]
    u = (left.select(*cols, F.lit("L").alias("side"))
             .unionByName(right.select(*cols, F.lit("R").alias("side"))))
    if delay:
        u = u.withWatermark(event_col, delay)
    return u.groupBy(key).transformWithStateInPandas(
        statefulProcessor=MatchOrTimeout(wait_ms),
        outputStructType="car_id string, l_id long, r_id long, l_ts long, r_ts long, status string",
        outputMode="Append", timeMode="EventTime")


# ------------------------------------------------------------------- S6
class Retract(StatefulProcessor):
    """S6 without before-images: the last row of a key is kept, so an update or
    delete can take it back."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "row string")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _concat(rows).sort_values("seq", kind="stable")
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for kind, row, seq in pdf[["type", "row", "seq"]].itertuples(index=False, name=None):
            if last is not None:
                out.append((key[0], int(seq), False, last))
            last = None if kind == "delete" else row
            if last is not None:
                out.append((key[0], int(seq), True, last))
        if last is None:
            self.last.clear()
        else:
            self.last.update((last,))
        yield pd.DataFrame(out, columns=["table_name", "seq", "is_add", "row"])

    def close(self) -> None:
        pass


def retract_stream(changes: DataFrame, keys: Sequence[str], table: str = "table_name") -> DataFrame:
    """S6 stream form for change envelopes whose ``before`` is empty (upsert-only
    capture): rows ``(table_name, seq, is_add, row)``.  An insert of a key that is
    there takes the old row back first; a delete of one that is not gives nothing.
    A deleted row's key is found in ``before`` or ``after``."""
    pk = [F.coalesce(F.col("after")[k], F.col("before")[k]).alias(f"_pk_{k}") for k in keys]
    d = changes.select(F.col(table).alias("table_name"), *pk, "type", F.to_json("after").alias("row"), F.col("seq").cast("long").alias("seq"))
    out = d.groupBy("table_name", *[f"_pk_{k}" for k in keys]).transformWithStateInPandas(
        statefulProcessor=Retract(), outputStructType="table_name string, seq long, is_add boolean, row string",
        outputMode="Append", timeMode="None")
    return out.withColumn("row", F.from_json("row", "map<string,string>"))
