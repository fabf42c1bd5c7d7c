"""Initial snapshot, then changes, as a resumable stream.

The tables are read in key ranges (chunks) while their change log is already
being consumed, without locking anything:

1. the *low mark* of a chunk is the log position that the stream has reached
   when the chunk is read, the *high mark* the end of the log after that;
2. the rows read wait until the stream has passed the high mark; rows whose
   key changed in between are dropped, as the change itself says more;
3. what is left was not touched between the marks, so it is the state at the
   low mark; it goes out as ``read`` changes with that sequence number.

Changes go out as they come.  By (key, sequence) the output is one history, so
``apply_changelog``, upserts and routing need not know about the snapshot.
One allow-list of tables holds for both parts.

Progress (chunks done, rows waiting) is a small file per step below the
checkpoint; a step that is given again, after a crash or restart, starts from
the step before it and replaces what it had written.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from .changes import read_changes

ENVELOPE = ("database", "table_name", "type", "before", "after", "ts_ms", "seq")
EMPTY = "map<string,string>"


@dataclass
class SourceTable:
    """A table of the source database: ``load`` gives its rows as they are now."""
    database: str
    name: str
    key: str
    load: Callable[[SparkSession], DataFrame]
    chunks: int = 4

    def bounds(self, spark: SparkSession) -> list:
        """Inner bounds of the chunks: quantiles of the key (texts included), one number or text per chunk."""
        rows = self.load(spark).select(F.col(self.key).alias("k")).where("k is not null")
        if self.chunks < 2:
            return []
        # keys sorted in ``chunks`` even parts; only the parts' first keys come back
        ranged = rows.repartitionByRange(self.chunks, "k").groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("k"))
        return sorted(r.k for r in ranged.collect())[1:]

    def chunk(self, spark: SparkSession, low, high) -> DataFrame:
        """Rows with low <= key < high (None: open), null keys with the first chunk."""
        d = self.load(spark)
        k = F.col(self.key)
        if low is not None:
            d = d.where(k >= F.lit(low))
        if high is not None:
            d = d.where((k < F.lit(high)) | (k.isNull() if low is None else F.lit(False)))
        row = F.create_map(*[x for c in d.columns for x in (F.lit(c), F.col(c).cast("string"))])
        return d.select(F.lit(self.database).alias("database"), F.lit(self.name).alias("table_name"), row.alias("after"))


@dataclass
class SnapshotThenChanges:
    """A ``foreachBatch`` handler over normalised changes.

    ``emit(rows, step)`` writes the output of a step and replaces what an
    earlier attempt of that step wrote; ``log_end(spark)`` is the highest sequence
    number in the log now.  ``chunks_per_step`` chunks are read per micro-batch.
    """
    tables: Sequence[SourceTable]
    emit: Callable[[DataFrame, int], None]
    log_end: Callable[[SparkSession], int]
    folder: str
    databases: Sequence[str] | None = None
    allowed: Sequence[str] | None = None
    chunks_per_step: int = 1
    _keys: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        ok = lambda t: ((not self.databases or t.database in self.databases)
                        and (not self.allowed or t.name in self.allowed or f"{t.database}.{t.name}" in self.allowed))
        self.tables = [t for t in self.tables if ok(t)]
        self._keys = {(t.database, t.name): t.key for t in self.tables}

    # -- progress ------------------------------------------------------------
    def _load(self, spark: SparkSession, batch_id: int | None) -> dict:
        """The last step that does not stem from this micro-batch, or a new plan of chunks."""
        for n in reversed([n for n in storage.names(spark, f"{self.folder}/steps") if n.endswith(".json")]):
            step = json.loads(storage.read_text(spark, f"{self.folder}/steps/{n}"))
            if batch_id is None or step["batch"] is None or step["batch"] < batch_id:
                return step
        plan = []
        for i, t in enumerate(self.tables):
            b = [None, *t.bounds(spark), None]
            plan += [[i, lo, hi] for lo, hi in zip(b, b[1:])]
        return {"step": 0, "batch": -1, "position": -1, "plan": plan, "done": 0, "waiting": []}

    def _save(self, spark: SparkSession, state: dict) -> None:
        path = f"{self.folder}/steps/{state['step']:012d}.json"
        storage.delete(spark, path)
        storage.put_new(spark, path, json.dumps(state))
        for n in storage.names(spark, f"{self.folder}/steps")[:-3]:
            storage.delete(spark, f"{self.folder}/steps/{n}")
        live = {w["path"].split("/")[-1] for n in storage.names(spark, f"{self.folder}/steps") if n.endswith(".json")
                for w in json.loads(storage.read_text(spark, f"{self.folder}/steps/{n}"))["waiting"]}
        for n in storage.names(spark, f"{self.folder}/rows"):
            if n not in live:
                storage.delete(spark, f"{self.folder}/rows/{n}")

    def finished(self, spark: SparkSession) -> bool:
        """Whether every chunk was read and has gone out."""
        s = self._load(spark, None)
        return s["done"] == len(s["plan"]) and not s["waiting"]

    # -- steps ---------------------------------------------------------------
    def _key(self, table, name, row):
        """The key of a row map, by its table."""
        k = F.lit(None).cast("string")
        for (db, t), key in self._keys.items():
            k = F.when((table == db) & (name == t), row[key]).otherwise(k)
        return k

    def step(self, spark: SparkSession, changes: DataFrame | None, batch_id: int | None = None) -> None:
        """One step: changes out, waiting rows that passed their high mark out, the next chunks read.
        ``changes`` None: the log has nothing new."""
        old = self._load(spark, batch_id)
        state = old | {"step": old["step"] + 1, "batch": old["batch"] if batch_id is None else batch_id, "waiting": []}
        out, changed = None, None
        if changes is not None:
            own = read_changes(changes, self.databases, self.allowed, startup="latest").select(*ENVELOPE).persist()
            top = own.agg(F.max("seq")).first()[0], changes.agg(F.max("seq")).first()[0]
            state["position"] = max(old["position"], *[x for x in top if x is not None])
            out = own
            changed = own.select("database", "table_name", F.explode(F.array(  # an update may change the key itself
                self._key(F.col("database"), F.col("table_name"), F.col("before")),
                self._key(F.col("database"), F.col("table_name"), F.col("after")))).alias("key"), "seq").where("key is not null")
        try:
            for n, w in enumerate(old["waiting"]):
                rows = spark.read.schema(f"database string, table_name string, after {EMPTY}, key string").parquet(
                    f"{self.folder}/{w['path']}")
                if changed is not None:
                    between = changed.where((F.col("seq") > w["low"]) & (F.col("seq") <= w["high"])).drop("seq").distinct()
                    rows = rows.join(between, ["database", "table_name", "key"], "left_anti")
                if state["position"] >= w["high"]:
                    read = rows.select("database", "table_name", F.lit("read").alias("type"), F.create_map().cast(EMPTY).alias("before"),
                                       "after", F.lit(0).cast("bigint").alias("ts_ms"), F.lit(w["low"]).cast("bigint").alias("seq"))
                    out = read if out is None else out.unionByName(read)
                else:
                    state["waiting"].append(w | {"path": self._write(rows, state["step"], n)})
            for i in range(old["done"], min(old["done"] + self.chunks_per_step, len(old["plan"]))):
                t, lo, hi = old["plan"][i]
                rows = self.tables[t].chunk(spark, lo, hi)
                rows = rows.withColumn("key", F.col("after")[self.tables[t].key])
                path = self._write(rows, state["step"], 1000 + i)
                # the end of the log after the chunk was read; nothing below the low mark counts
                state["waiting"].append({"path": path, "low": state["position"], "high": max(self.log_end(spark), state["position"])})
                state["done"] = i + 1
            if out is not None:
                self.emit(out.withColumns({c: F.coalesce(c, F.create_map().cast(EMPTY)) for c in ("before", "after")}), state["step"])
        finally:
            if changes is not None:
                own.unpersist()
        self._save(spark, state)

    def _write(self, rows: DataFrame, step: int, n: int) -> str:
        path = f"rows/{step:012d}-{n}"
        rows.select("database", "table_name", "after", "key").write.mode("overwrite").parquet(f"{self.folder}/{path}")
        return path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.step(batch.sparkSession, batch, batch_id)

    def drain(self, spark: SparkSession) -> None:
        """Go on without new changes until the snapshot is out or waits for changes that are in the log already."""
        while not self.finished(spark):
            before = self._load(spark, None)
            self.step(spark, None)
            after = self._load(spark, None)
            if after["done"] == before["done"] and len(after["waiting"]) == len(before["waiting"]):
                return
