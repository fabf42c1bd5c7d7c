"""Configuration-driven routing of change rows.

The configuration table (one row per source table and operation) is small and
its size is checked before it is broadcast; each change row looks up its
route with an inner join, unmatched rows are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import UNKNOWN_BYTES, broadcast_if_small, estimated_bytes

SINK_FACT = "kafka"   # fixed values: the reference's sink type names
SINK_DIM = "hbase"
SINK_OLAP = "clickhouse"
CONFIG_ROW_BYTES = 4096   # allowed for a configuration row


def keep_columns(row_map: Column, sink_columns: Column) -> Column:
    """Keep the map entries whose key is listed in the comma-separated
    column list."""
    return keep_listed(row_map, F.split(sink_columns, ","))


def keep_listed(row_map: Column, columns: Column) -> Column:
    """P6 with the list as an array.  Give a plain column: an expression would
    be evaluated again for every entry."""
    return F.map_filter(row_map, lambda k, v: F.array_contains(columns, k))


def kept_columns() -> Column:
    """The listed columns of a route; dimension rows keep their key column too."""
    listed = F.split("sink_columns", ",")
    return F.when(F.col("sink_type") == SINK_DIM, F.concat(listed, F.array(F.coalesce("sink_pk", F.lit("id"))))).otherwise(listed)


def config_bytes(config: DataFrame) -> int | None:
    """Size of a configuration; where the plan cannot tell (rows handed over by
    the driver), its rows are counted.  Taken for large, it would be joined by
    shuffling all changes to the few tasks of its (table, operation) keys."""
    size = estimated_bytes(config)
    return size if config.isStreaming or (size is not None and size < UNKNOWN_BYTES) else config.count() * CONFIG_ROW_BYTES


def route(changes: DataFrame, config: DataFrame, read_as_insert: bool = False) -> DataFrame:
    """Attach ``sink_type`` / ``sink_table`` from the (table, type) config
    row and whitelist the columns of ``after``.  Dimension rows keep their key column (``sink_pk``, else
    ``id``) whether it is listed or not.  Rows without config are dropped.  With ``read_as_insert`` snapshot rows use the insert route (D13).
    When the config holds several rows for one (table, type) the last one wins
    in the reference; callers pass one row per key."""
    typ = F.when(F.col("type") == "read", F.lit("insert")).otherwise(F.col("type")) if read_as_insert \
        else F.col("type")
    cfg = config.select(F.col("source_table").alias("_tw_src"), F.col("operate_type").alias("_tw_op"),
                        "sink_type", "sink_table", "sink_columns", "sink_pk", kept_columns().alias("_tw_cols"))
    cfg = broadcast_if_small(cfg, size_bytes=config_bytes(cfg))
    d = changes.withColumn("_tw_type", typ)
    j = d.join(cfg, (F.col("table_name") == F.col("_tw_src")) & (F.col("_tw_type") == F.col("_tw_op")), "inner")
    return (j.withColumn("after", keep_listed(F.col("after"), F.col("_tw_cols")))
             .drop("_tw_src", "_tw_op", "_tw_type", "_tw_cols"))


def split_routes(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(fact, dim)``: kafka rows to the fact output, hbase rows to the dim
    output; other sink types are dropped."""
    return (routed.where(F.col("sink_type") == SINK_FACT),
            routed.where(F.col("sink_type") == SINK_DIM))


# ------------------------------------------------------------ as-of configuration
ROUTE_KEY = ("source_table", "operate_type")
ROUTE_COLS = ("sink_type", "sink_table", "sink_columns", "sink_pk")


def config_versions(config_changes: DataFrame, seq: str = "seq", type_col: str = "type",
                    columns: Sequence[str] = ROUTE_COLS) -> DataFrame:
    """The interval table of a configuration that is itself a change stream:
    one row per version of a (source table, operation), valid for sequence
    numbers in ``[from_seq, to_seq)`` (``to_seq`` null: still valid).  A delete
    ends the version before it.  ``first`` marks a key's first version.  The
    history of one key is a handful of rows."""
    w = Window.partitionBy(*ROUTE_KEY).orderBy(seq)
    v = config_changes.select(*ROUTE_KEY, *columns, F.col(type_col).alias("_tw_type"), F.col(seq).alias("from_seq"),
                              F.lead(seq).over(w).alias("to_seq"))
    kept = v.where(F.coalesce(F.col("_tw_type") != "delete", F.lit(True))).drop("_tw_type")
    return kept.withColumn("first", F.row_number().over(Window.partitionBy(*ROUTE_KEY).orderBy("from_seq")) == 1)


def route_as_of(changes: DataFrame, versions: DataFrame, seq: str = "seq", wait: bool = False,
                read_as_insert: bool = False) -> DataFrame:
    """P7 by the configuration that held when a change was made: a temporal
    join on (table, operation) and the sequence number.  Changes before the
    first version of their key have no route; with ``wait`` they take the first
    one, as if they had waited for it (D13)."""
    typ = F.col("type")
    if read_as_insert:
        typ = F.when(typ == "read", "insert").otherwise(typ)
    start = F.when(F.col("first"), F.lit(None)).otherwise(F.col("from_seq")) if wait else F.col("from_seq")
    v = versions.select(F.col("source_table").alias("_tw_src"), F.col("operate_type").alias("_tw_op"), *ROUTE_COLS,
                        start.alias("_tw_from"), F.col("to_seq").alias("_tw_to"), kept_columns().alias("_tw_cols"))
    v = broadcast_if_small(v, size_bytes=config_bytes(v))
    on = ((F.col("table_name") == F.col("_tw_src")) & (F.col("_tw_type") == F.col("_tw_op"))
          & (F.col("_tw_from").isNull() | (F.col(seq) >= F.col("_tw_from")))
          & (F.col("_tw_to").isNull() | (F.col(seq) < F.col("_tw_to"))))
    j = changes.withColumn("_tw_type", typ).join(v, on, "inner")
    return (j.withColumn("after", keep_listed(F.col("after"), F.col("_tw_cols")))
             .drop("_tw_src", "_tw_op", "_tw_type", "_tw_cols", "_tw_from", "_tw_to"))
