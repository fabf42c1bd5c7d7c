"""Change capture: envelope normalisation, scan options, changelog views
(S3-S6).

A capture connector hands over one record per row change.  The normalised
envelope is ``database, table_name, type, before, after`` with ``before`` /
``after`` as string maps (empty when absent) and ``type`` in
insert / update / delete / read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import first_per_group


def _empty_map():
    return F.create_map().cast("map<string,string>")


def normalize_changes(raw: DataFrame, topic: str = "topic", op: str = "op",
                      before: str = "before", after: str = "after",
                      keep: Sequence[str] = ("ts_ms", "seq")) -> DataFrame:
    """S3: database and table from the dotted topic ``server.database.table``;
    before/after as maps (``{}`` when null); operation lower-cased with
    ``create`` renamed ``insert``."""
    parts = F.split(F.col(topic), "\\.")
    t = F.lower(F.col(op))
    return raw.select(
        F.get(parts, F.lit(1)).alias("database"),
        F.get(parts, F.lit(2)).alias("table_name"),
        F.when(t == "create", F.lit("insert")).otherwise(t).alias("type"),
        F.coalesce(F.col(before), _empty_map()).alias("before"),
        F.coalesce(F.col(after), _empty_map()).alias("after"),
        *keep)


def read_changes(changes: DataFrame, databases: Sequence[str] | None = None,
                 tables: Sequence[str] | None = None, startup: str = "initial",
                 snapshot: DataFrame | None = None) -> DataFrame:
    """Database / table allow-lists; ``startup='initial'`` prepends the
    snapshot rows (type ``read``), ``'latest'`` keeps only the changes.
    ``tables`` entries may be ``db.table`` or bare table names."""
    if startup == "initial":
        if snapshot is None:
            raise ValueError("startup 'initial' needs a snapshot")
        d = snapshot.withColumn("type", F.lit("read")).unionByName(changes, allowMissingColumns=True)
    elif startup == "latest":
        d = changes
    else:
        raise ValueError(f"unknown startup mode {startup!r}")
    if databases:
        d = d.where(F.col("database").isin(list(databases)))
    if tables:
        qualified = F.concat_ws(".", "database", "table_name")
        d = d.where(qualified.isin(list(tables)) | F.col("table_name").isin(list(tables)))
    return d


def drop_deletes(changes: DataFrame) -> DataFrame:
    """Keep every change that is not a delete."""
    return changes.where(F.col("type") != "delete")


def apply_changelog(changes: DataFrame, keys: Sequence[str], seq: str = "seq",
                    table: str = "table_name") -> DataFrame:
    """The current table of a changelog: the latest change per primary key
    (by ``seq``) unless it is a delete.  ``keys`` are entries of the row map.
    One ``max_by`` aggregate per key, combined map-side."""
    k = [F.coalesce(F.col("after")[c], F.col("before")[c]).alias(f"_pk_{c}") for c in keys]
    d = changes.select("*", *k)
    latest = first_per_group(d.withColumn("_neg_seq", -F.col(seq)),
                             [table, *[f"_pk_{c}" for c in keys]], ["_neg_seq"])
    return latest.where(F.col("type") != "delete").drop("_neg_seq", *[f"_pk_{c}" for c in keys])


def to_retract(changes: DataFrame, keep: Sequence[str] = ("table_name", "seq")) -> DataFrame:
    """Retract stream rows ``(is_add, row)``: insert/read -> (true, after),
    delete -> (false, before), update -> (false, before) and (true, after)."""
    t = F.col("type")
    retract = F.when(t.isin("update", "delete"), F.struct(F.lit(False).alias("is_add"), F.col("before").alias("row")))
    add = F.when(t.isin("insert", "update", "read"), F.struct(F.lit(True).alias("is_add"), F.col("after").alias("row")))
    arr = F.filter(F.array(retract, add), lambda x: x.isNotNull())
    return (changes.select(*keep, F.explode(arr).alias("_r"))
                   .select(*keep, "_r.is_add", "_r.row"))
