"""Routing by a configuration that is itself a stream.

The reference broadcasts every configuration row to all tasks and looks it up
when a change comes by.  Here changes and configuration rows are keyed by
(source table, slot): a configuration row goes to every slot of its table, a
change to one of them, so that a table holding most changes spreads over
``slots`` keys.  The state of a key is the version history of its routes and,
with ``wait``, the changes that came before any route of theirs.

A change takes the version that holds at its sequence number among those that
have arrived; what was routed is not routed again.  With both topics read in
order this is the batch form ``route_as_of``.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..operators.routing import ROUTE_COLS, keep_listed, kept_columns

OUT = ["table_name", "type", "row", "seq", *ROUTE_COLS]


class RouteAsOf(StatefulProcessor):
    """Version history per operation, changes looked up by binary search, a column at a time."""

    def __init__(self, wait: bool):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getMapState("versions", "op string", "history string")
        self.waiting = handle.getListState("waiting", "type string, op string, row string, seq long")

    def _history(self, op: str) -> list:
        """[seq, route or None after a delete] in order."""
        return json.loads(self.versions.getValue((op,))[0]) if self.versions.containsKey((op,)) else []

    def _configure(self, rows: pd.DataFrame) -> set[str]:
        for op, part in rows.groupby("op"):
            known = {s: r for s, r in self._history(op)}
            for kind, seq, route in part[["type", "seq", "row"]].itertuples(index=False, name=None):
                known[int(seq)] = None if kind == "delete" else json.loads(route)
            self.versions.updateValue((op,), (json.dumps(sorted(known.items())),))
        return set(rows["op"])

    def _route(self, table: str, rows: pd.DataFrame):
        """(routed rows, rows without any version yet)."""
        out, early = [], []
        for op, part in rows.groupby("op"):
            history = self._history(op)
            if not history:
                early.append(part)
                continue
            at = np.searchsorted([s for s, _ in history], part["seq"].to_numpy(), side="right") - 1
            if self.wait:
                at = np.maximum(at, 0)
            for v in np.unique(at):
                route = history[v][1] if v >= 0 else None
                if route is not None:
                    out.append(part[at == v].assign(table_name=table, **{c: route.get(c) for c in ROUTE_COLS})[OUT])
        return out, early

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        table, early, changes = key[0], [], []
        fresh: set[str] = set()
        for part in rows:
            c = part["config"].to_numpy()
            if c.any():
                fresh |= self._configure(part[c])
            if not c.all():
                changes.append(part.loc[~c, ["type", "op", "row", "seq"]])
        if fresh and self.waiting.exists():
            held = pd.DataFrame(list(self.waiting.get()), columns=["type", "op", "row", "seq"])
            out, left = self._route(table, held)
            yield from out
            self.waiting.clear()
            early += left
        for part in changes:
            out, left = self._route(table, part)
            yield from out
            early += left
        if self.wait and early:
            self.waiting.appendList([tuple(r) for part in early for r in part.itertuples(index=False, name=None)])
        yield pd.DataFrame(columns=OUT)

    def close(self) -> None:
        pass


def route_as_of_stream(changes: DataFrame, config: DataFrame, wait: bool = False, read_as_insert: bool = False,
                       slots: int = 8) -> DataFrame:
    """``changes``: normalised change envelopes; ``config``: change rows of the
    configuration (``type, seq`` and the columns of a route).  The routed changes,
    as ``route_as_of`` gives them."""
    record = F.to_json(F.struct("database", "before", "after", "ts_ms"))
    op = F.when((F.col("type") == "read") & F.lit(read_as_insert), "insert").otherwise(F.col("type"))
    d = changes.select(F.col("table_name").alias("t"), F.pmod(F.xxhash64("seq"), F.lit(slots)).cast("int").alias("slot"),
                       F.lit(False).alias("config"), "type", op.alias("op"), record.alias("row"), F.col("seq").cast("bigint").alias("seq"))
    c = config.select(F.col("source_table").alias("t"), F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
                      F.lit(True).alias("config"), "type", F.col("operate_type").alias("op"),
                      F.to_json(F.struct(*ROUTE_COLS)).alias("row"), F.col("seq").cast("bigint").alias("seq"))
    routed = d.unionByName(c).groupBy("t", "slot").transformWithStateInPandas(
        statefulProcessor=RouteAsOf(wait),
        outputStructType="table_name string, type string, row string, seq bigint, " + ", ".join(f"{x} string" for x in ROUTE_COLS),
        outputMode="Append", timeMode="None")
    r = F.from_json("row", "database string, before map<string,string>, after map<string,string>, ts_ms bigint")
    flat = routed.withColumn("row", r).withColumn("_tw_cols", kept_columns())
    return flat.select("row.database", "table_name", "type", "row.before",
                       keep_listed(F.col("row.after"), F.col("_tw_cols")).alias("after"), "row.ts_ms", "seq", *ROUTE_COLS)
