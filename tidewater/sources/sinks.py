"""Sinks (K1-K6): line topics, routed topics, idempotent batches, relational
tables, dimension upserts and config-driven table creation.

Kafka / JDBC are the production targets; file formats under the shared
folder are the tested path (no broker or database is reachable here).  File
sinks given a ``batch_id`` are idempotent: the batch's rows replace what an
earlier attempt of the same batch wrote.  Without one they append, as do Kafka
and JDBC.  Dimensions (K5) are keyed tables of sorted runs, see ``runs``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runs import create as ensure_dim, newest as snapshot_state, read as read_snapshot, upsert as upsert_dim, vacuum

__all__ = ["as_json_lines", "ensure_dim", "ensure_table", "read_snapshot", "snapshot_state", "upsert_dim", "vacuum",
           "write_lines", "write_once", "write_routed", "write_table"]


def as_json_lines(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """F8: one JSON text per row."""
    cols = [c for c in df.columns if c not in exclude]
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def _replace(out: DataFrame, batch_id: int | None, mode: str):
    """A writer that appends, or replaces the ``batch_id`` partition."""
    if batch_id is None:
        return out.write.mode(mode), []
    return (out.withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")), ["batch_id"]


#: Topics a task writes side by side before it sorts the rest by topic; bytes of a topic's row group.
OPEN_TOPICS, TOPIC_BLOCK = 16, 16 << 20
OPEN_CONF = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _open_files(spark: SparkSession):
    """Within it, a partitioned write keeps the files of some topics open
    instead of sorting all rows of a task by topic first, which takes memory
    and spills with the size of a task's input."""
    before = spark.conf.get(OPEN_CONF)
    spark.conf.set(OPEN_CONF, str(OPEN_TOPICS))
    try:
        yield
    finally:
        spark.conf.set(OPEN_CONF, before)


def write_lines(df: DataFrame, target: str, kafka_servers: str | None = None,
                mode: str = "append", batch_id: int | None = None) -> None:
    """K1: JSON lines to one topic (Kafka) or one folder of text files."""
    lines = df if df.columns == ["value"] else as_json_lines(df)
    if kafka_servers:
        (lines.write.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
              .option("topic", target).save())
    else:
        w, by = _replace(lines, batch_id, mode)
        w.partitionBy(*by).text(target)


def write_routed(df: DataFrame, target: str, topic_col: str = "sink_table",
                 value_col: str = "value", kafka_servers: str | None = None,
                 mode: str = "append", batch_id: int | None = None, keep: Sequence[str] = ()) -> None:
    """K2: each row to the topic named by its ``topic_col`` (Kafka's ``topic``
    column), or to ``target/<topic_col>=<name>/`` for files, with the columns
    in ``keep`` beside the value."""
    if kafka_servers:
        (df.select(F.col(topic_col).alias("topic"), F.col(value_col).cast("string").alias("value"))
           .write.format("kafka").option("kafka.bootstrap.servers", kafka_servers).save())
    else:
        w, by = _replace(df.select(topic_col, F.col(value_col).cast("string").alias("value"), *keep), batch_id, mode)
        with _open_files(df.sparkSession):
            w.partitionBy(topic_col, *by).option("compression", "zstd").option("parquet.block.size", TOPIC_BLOCK).parquet(target)


def write_once(df: DataFrame, target: str, batch_id: int) -> None:
    """K3: exactly-once per batch: the batch's rows replace the
    ``batch_id=<n>`` partition, so a replayed batch overwrites itself."""
    (df.withColumn("batch_id", F.lit(int(batch_id)))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(target))


def write_table(df: DataFrame, target: str, exclude: Sequence[str] = (), batchsize: int = 1000,
                jdbc_url: str | None = None, properties: dict | None = None,
                fmt: str = "parquet", mode: str = "append") -> None:
    """K4: columns bound in declared order, transient columns excluded; JDBC
    with ``batchsize`` rows per round trip, or a file table."""
    out = df.drop(*exclude)
    if jdbc_url:
        (out.write.mode(mode).option("batchsize", batchsize)
            .jdbc(jdbc_url, target, properties=properties or {}))
    else:
        out.write.mode(mode).format(fmt).save(target)


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def ensure_table(spark: SparkSession, sink_table: str, sink_columns: str, location: str,
                 sink_pk: str | None = None, sink_extend: str | None = None,
                 database: str | None = None) -> str:
    """K6: create the sink table if missing: the configured columns, all
    strings, primary key defaulting to ``id`` (kept first)."""
    pk = sink_pk or "id"
    cols = [c.strip() for c in sink_columns.split(",") if c.strip()]
    if pk not in cols:
        cols.insert(0, pk)
    for ident in [sink_table, *cols, *([database] if database else [])]:
        if not _IDENT.match(ident):
            raise ValueError(f"bad identifier {ident!r}")
    name = f"`{database}`.`{sink_table}`" if database else f"`{sink_table}`"
    ddl = ", ".join(f"`{c}` STRING" for c in cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
              f"LOCATION '{location}' {sink_extend or ''}")
    return name
