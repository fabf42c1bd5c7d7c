"""Keyed tables as sorted runs, merged at read.

A batch becomes one *run*: its newest row per key, sorted by the hash of the
key.  Writing costs what the batch
costs; stored files are never changed.  A small version file names the runs of
the table; it is put in place by one rename, so readers see the old or the new
version and a crash before that leaves the old one (its folder is collected
later).  Reading takes the newest row per key over all runs.

Runs of about one size are merged once there are ``FANOUT`` of them, so a row
is rewritten once per size class and a table of any history has a few dozen
runs at most.  A merged run is dealt out by ranges of the key's hash into as
many files as its size asks for: there is no bucket number that a table could
outgrow.

Versions stay readable while they are among the newest ``retain`` or a reader
holds a *lease* on them.  ``DimReader`` resolves the newest version each time
it is asked (or after ``refresh`` seconds) and leases what it hands out, so a
stream reads a table that others upsert, compact and vacuum meanwhile.  One
writer at a time; a batch that was applied already is left out when it is
given again with its ``batch_id``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..operators.joins import broadcast_if_small

HASH, RUN = "_hash", "_run"
#: Runs of one size class that are merged into one; bytes of the smallest class; bytes of a file.
FANOUT, SMALL, FILE_BYTES = 8, 1 << 20, 256 << 20


# -- versions --------------------------------------------------------------------

def versions(spark: SparkSession, target: str) -> list[str]:
    return [n for n in storage.names(spark, f"{target}/_versions") if n.endswith(".json")]


def state_at(spark: SparkSession, target: str, name: str) -> dict:
    return json.loads(storage.read_text(spark, f"{target}/_versions/{name}"))


def newest(spark: SparkSession, target: str) -> dict | None:
    """What the newest version says; None if nothing was committed.  A version that cannot be read raises."""
    found = versions(spark, target)
    return state_at(spark, target, found[-1]) if found else None


def before_batch(spark: SparkSession, target: str, batch_id: int | None) -> dict | None:
    """The newest version that does not hold the batch yet."""
    for n in reversed(versions(spark, target)):
        s = state_at(spark, target, n)
        if batch_id is None or s["batch"] is None or s["batch"] < batch_id:
            return s
    return None


def _commit(spark: SparkSession, target: str, state: dict) -> dict:
    state = state | {"version": state["version"] + 1}
    storage.put_new(spark, f"{target}/_versions/{state['version']:012d}.json", json.dumps(state))
    return state


def _empty(keys: Sequence[str], seq: str | None, columns: Sequence[str] = ()) -> dict:
    return {"version": 0, "batch": None, "keys": list(keys), "seq": seq, "columns": list(columns), "runs": []}


def create(spark: SparkSession, target: str, columns: Sequence[str], keys: Sequence[str], seq: str | None = "seq") -> None:
    """K6: an empty table with the configured columns (texts) if there is none yet."""
    if newest(spark, target) is None:
        _commit(spark, target, _empty(keys, seq, [*keys, *(c for c in columns if c not in keys)]))


# -- writing ---------------------------------------------------------------------

def newest_per_key(rows: DataFrame, keys: Sequence[str], seq: str | None) -> DataFrame:
    """One row per key: the newest by ``seq``; without ``seq`` any."""
    if seq is None:
        return rows.dropDuplicates(list(keys))
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_r")).select(*keys, "_r.*")


def _hash(keys: Sequence[str]):
    return F.xxhash64(*[F.col(k) for k in keys])


def _add(spark: SparkSession, target: str, state: dict, folder: str, schema: T.StructType, rows: int,
         batch_id: int | None, fanout: int, retain: int) -> None:
    run = {"path": folder, "bytes": storage.size(spark, f"{target}/{folder}"), "rows": rows, "schema": schema.jsonValue()}
    columns = [*state["columns"], *(f.name for f in schema if f.name not in (*state["columns"], HASH))]
    _commit(spark, target, state | {"batch": state["batch"] if batch_id is None else int(batch_id),
                                    "columns": columns, "runs": [*state["runs"], run]})
    while compact(spark, target, fanout):
        pass
    vacuum(spark, target, retain)


def _checked(spark: SparkSession, target: str, keys: Sequence[str], seq: str | None, batch_id: int | None) -> dict | None:
    """The state to write on; None if the batch is in it."""
    state = newest(spark, target) or _empty(keys, seq)
    if state["keys"] != list(keys):
        raise ValueError(f"{target} is keyed by {state['keys']}")
    applied = batch_id is not None and state["batch"] is not None and batch_id <= state["batch"]
    return None if applied else state


def upsert(batch: DataFrame, target: str, keys: Sequence[str], seq: str | None = "seq", batch_id: int | None = None,
           fanout: int = FANOUT, retain: int = 2) -> int:
    """``replace into``: add the batch as a run.  The newest row per key by
    ``seq`` wins over the whole table (of equal ones the later batch's), and
    columns that a row lacks are null.  Returns the number of rows written; 0
    also if the batch was applied before."""
    spark = batch.sparkSession
    state = _checked(spark, target, keys, seq, batch_id)
    if state is None:
        return 0
    count = Observation()
    rows = newest_per_key(batch, keys, seq).withColumn(HASH, _hash(keys)).observe(count, F.count("*").alias("n"))
    folder = f"data/{uuid.uuid4().hex}"
    rows.sortWithinPartitions(HASH).write.parquet(f"{target}/{folder}")
    n = count.get["n"]
    if n or batch_id is not None:
        if n:
            _add(spark, target, state, folder, rows.schema, n, batch_id, fanout, retain)
        else:
            _commit(spark, target, state | {"batch": int(batch_id)})
            vacuum(spark, target, retain)
    return n


def upsert_many(rows: DataFrame, base: str, tables: Mapping[str, tuple[Sequence[str], str]], seq: str = "seq",
                table: str = "sink_table", values: str = "after", batch_id: int | None = None,
                fanout: int = FANOUT, retain: int = 2) -> list[str]:
    """Upsert the rows of many tables (name -> (columns, key column)) below
    ``base`` in one pass: rows name their ``table`` and hold their ``values``
    as a map of texts.  One shuffle and one write for all tables together;
    tables without rows cost nothing.  Returns the tables that got rows."""
    spark = rows.sparkSession
    key = F.coalesce(*[F.when(F.col(table) == t, F.col(values)[k]) for t, (_, k) in tables.items()]) if tables else None
    if key is None:
        return []
    known = rows.where(F.col(table).isin(list(tables))).select(
        F.col(table).alias("_table"), key.alias("_key"), F.struct(F.col(values).alias("v"), F.col(seq).alias("s")).alias("r"))
    known = known.groupBy("_table", "_key").agg(F.max_by("r", F.col("r.s")).alias("r"))
    names = list(dict.fromkeys(c for cols, k in tables.values() for c in (k, *cols)))
    staged = f"{base}/_staged/{uuid.uuid4().hex}"
    flat = known.select("_table", *[F.col("r.v")[c].alias(c) for c in names], F.col("r.s").alias(seq),
                        F.xxhash64("_key").alias(HASH))
    flat.sortWithinPartitions("_table", HASH).write.partitionBy("_table").parquet(staged)
    done = []
    for d in storage.names(spark, staged):
        if not d.startswith("_table="):
            continue
        name = unquote(d.removeprefix("_table="))
        cols, k = tables[name]
        target = f"{base}/{name}"
        state = _checked(spark, target, [k], seq, batch_id)
        if state is not None:
            folder = f"data/{uuid.uuid4().hex}"
            storage.move(spark, f"{staged}/{d}", f"{target}/{folder}")
            own = T.StructType([T.StructField(c, T.StringType()) for c in (k, *(c for c in cols if c != k))]
                               + [f for f in flat.schema if f.name in (seq, HASH)])
            _add(spark, target, state, folder, own, parquet_rows(spark, f"{target}/{folder}", own), batch_id, fanout, retain)
            done.append(name)
    storage.delete(spark, staged)
    return done


def parquet_rows(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Rows of a written folder, from the files' footers."""
    return spark.read.schema(schema).parquet(path).count()


# -- reading ---------------------------------------------------------------------

def rows_of(spark: SparkSession, target: str, state: dict, only: DataFrame | None = None,
            runs: Sequence[dict] | None = None) -> DataFrame:
    """The rows of a version.  ``only``: a frame of key values; each run is cut
    down to them before the runs are merged (a small batch against a large
    table).  One run alone needs no merge."""
    runs = state["runs"] if runs is None else runs
    keys, seq = state["keys"], state["seq"]
    if not runs:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in state["columns"] or keys))
    frames = []
    for n, run in enumerate(runs):
        d = spark.read.schema(T.StructType.fromJson(run["schema"])).parquet(f"{target}/{run['path']}")
        if only is not None:
            # null-safe, so that a null key is a key like any other
            o = broadcast_if_small(only.select(*[F.col(k).alias(f"_o_{k}") for k in keys]).distinct())
            on = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
            d = d.join(o, on, "left_semi")
        frames.append(d.withColumn(RUN, F.lit(n)))
    every = frames[0]
    for d in frames[1:]:
        every = every.unionByName(d, allowMissingColumns=True)
    if len(runs) == 1:
        return every.drop(HASH, RUN)
    if seq is None:
        return every.drop(HASH, RUN).dropDuplicates(keys)
    rest = [c for c in every.columns if c not in (*keys, HASH, RUN)]
    best = every.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(seq, RUN)).alias("_r"))
    return best.select(*keys, "_r.*")


def read(spark: SparkSession, target: str, only: DataFrame | None = None) -> DataFrame | None:
    """The current rows; None before the first commit."""
    state = newest(spark, target)
    return None if state is None else rows_of(spark, target, state, only)


def missing_from(batch: DataFrame, target: str, key: str, batch_id: int | None = None) -> DataFrame:
    """U4: rows of ``batch`` whose key the table does not hold (without what a
    first attempt of the same batch put there).  Keys that are few enough to be
    listed reach the scan, where the files' Bloom filters and ranges skip what
    cannot hold them; else runs are joined on the key."""
    spark = batch.sparkSession
    state = before_batch(spark, target, batch_id)
    if state is None or not state["runs"]:
        return batch
    few = batch.select(key).where(F.col(key).isNotNull()).distinct().limit(LISTED + 1).collect()
    out = batch
    stored = None
    for run in state["runs"]:
        d = spark.read.schema(T.StructType.fromJson(run["schema"])).parquet(f"{target}/{run['path']}").select(key)
        if len(few) <= LISTED:
            d = d.where(F.col(key).isin([r[0] for r in few]))
        stored = d if stored is None else stored.unionByName(d)
    return out.join(stored, key, "left_anti")


#: Keys that are put into a scan's filter as a list, at most.
LISTED = 512


# -- compaction, leases, clean-up ----------------------------------------------------

def _class(n: int) -> int:
    k = 0
    while n > SMALL:
        n, k = n // FANOUT, k + 1
    return k


def compact(spark: SparkSession, target: str, fanout: int = FANOUT) -> bool:
    """Merge the newest runs into one if ``fanout`` of them are of the last one's size class or smaller."""
    state = newest(spark, target)
    runs = state["runs"] if state else []
    tail = 0
    while tail < len(runs) and _class(runs[-1 - tail]["bytes"]) <= _class(runs[-1]["bytes"]):
        tail += 1
    if tail < fanout:
        return False
    merged = runs[-tail:]
    rows = rows_of(spark, target, state, runs=merged).withColumn(HASH, _hash(state["keys"]))
    files = max(1, -(-sum(r["bytes"] for r in merged) // FILE_BYTES))
    rows = rows.coalesce(1) if files == 1 else rows.repartitionByRange(files, HASH)
    folder = f"data/{uuid.uuid4().hex}"
    most = sum(r["rows"] for r in merged)
    w = rows.sortWithinPartitions(HASH).write
    for k in state["keys"]:
        w = (w.option(f"parquet.bloom.filter.enabled#{k}", "true")
             .option(f"parquet.bloom.filter.expected.ndv#{k}", str(max(1, most // files))))
    w.parquet(f"{target}/{folder}")
    run = {"path": folder, "bytes": storage.size(spark, f"{target}/{folder}"), "rows": most, "schema": rows.schema.jsonValue()}
    _commit(spark, target, state | {"runs": [*runs[:-tail], run]})
    return True


def leases(spark: SparkSession, target: str) -> list[tuple[str, int, int]]:
    """(reader, version, until in millis) of every lease file."""
    return [(n.rsplit(".", 2)[0], int(n.split(".")[-2]), int(n.split(".")[-1]))
            for n in storage.names(spark, f"{target}/_leases") if n.count(".") >= 2 and not n.endswith(".part")]


def release(spark: SparkSession, target: str, reader: str, but: int | None = None) -> None:
    """Give up a reader's leases (other than the one on version ``but``)."""
    for r, v, until in leases(spark, target):
        if r == reader and v != but:
            storage.delete(spark, f"{target}/_leases/{r}.{v}.{until}")


def vacuum(spark: SparkSession, target: str, retain: int = 2, clock: Callable[[], float] = time.time) -> None:
    """Drop versions that are not among the last ``retain``, leased, or needed to give the last
    batch again, and all folders that no kept version names.  Called by the one writer."""
    found = versions(spark, target)
    now = clock() * 1000
    held = {v for _, v, until in leases(spark, target) if until > now}
    states = {n: state_at(spark, target, n) for n in found}
    last = states[found[-1]]["batch"] if found else None
    redo = [n for n in found if last is not None and (states[n]["batch"] is None or states[n]["batch"] < last)][-1:]
    kept = [n for k, n in enumerate(found) if k >= len(found) - retain or states[n]["version"] in held or n in redo]
    live = {run["path"].split("/")[-1] for n in kept for run in states[n]["runs"]}
    for n in found:
        if n not in kept:
            storage.delete(spark, f"{target}/_versions/{n}")
    for d in storage.names(spark, f"{target}/data"):
        if d not in live:
            storage.delete(spark, f"{target}/data/{d}")
    for r, v, until in leases(spark, target):
        if until <= now:
            storage.delete(spark, f"{target}/_leases/{r}.{v}.{until}")


class DimReader:
    """A dimension as a stream reads it: the newest version at each ``get``
    (after ``refresh`` seconds at the earliest, as a cache would), leased for
    ``seconds`` from the last use, so that what was handed out stays readable
    for a micro-batch however often the table changes meanwhile."""

    def __init__(self, target: str, schema: T.StructType | None = None, seconds: float = 3600, refresh: float = 0,
                 reader: str | None = None, clock: Callable[[], float] = time.time):
        self.target, self.schema, self.seconds, self.refresh, self.clock = target, schema, seconds, refresh, clock
        self.reader = reader or f"reader-{uuid.uuid4().hex[:12]}"
        self.version: int | None = None
        self._state: dict | None = None
        self._until = self._looked = float("-inf")

    def _resolve(self, spark: SparkSession) -> None:
        now = self.clock()
        fresh = self._state is not None and now - self._looked < self.refresh
        while True:
            found = versions(spark, self.target)
            name = found[-1] if found else None
            if name is None:
                return
            state = self._state if fresh else state_at(spark, self.target, name)
            if self.version == state["version"] and self._until - now > self.seconds / 2:
                break
            until = now + self.seconds
            storage.put_new(spark, f"{self.target}/_leases/{self.reader}.{state['version']}.{int(until * 1000)}", "")
            # leased, then looked again: a version that went in between is not used
            if f"{state['version']:012d}.json" in versions(spark, self.target):
                old, self._state, self.version, self._until = self.version, state, state["version"], until
                if old not in (None, self.version):
                    release(spark, self.target, self.reader, but=self.version)
                break
            fresh = False
        if not fresh:
            self._looked = now

    def get(self, spark: SparkSession, only: DataFrame | None = None) -> DataFrame:
        """The rows of the newest version, with the reader's schema; of some keys where ``only`` gives them."""
        self._resolve(spark)
        if self._state is None:
            if self.schema is None:
                raise ValueError(f"{self.target} has no version yet")
            return spark.createDataFrame([], self.schema)
        if only is not None:
            only = only.toDF(*self._state["keys"])
        rows = rows_of(spark, self.target, self._state, only)
        if self.schema is None:
            return rows
        have = set(rows.columns)
        return rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in self.schema])

    def close(self, spark: SparkSession) -> None:
        release(spark, self.target, self.reader)
