"""Session construction and the shared working folder.

The library never hard-codes a scratch location: jobs write intermediate
tables, stream checkpoints and sink output under the folder the cluster names
in ``spark.checkpoint.dir``.  Only when that setting is absent (local runs and
tests) do we create one of our own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes
# (shuffle join -> broadcast when a side turns out small), splits skewed
# shuffle partitions, and coalesces small ones.  RocksDB keeps streaming state
# off-heap so per-key state can outgrow executor memory.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Most waves of shuffle partitions over a cluster's cores.
WAVES = 5


def sizing_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
                target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Scan splits of ``target_partition_bytes`` keep a task's working set well
    inside executor memory; the initial shuffle partition count is sized so a
    shuffle of the whole input lands near the same size per partition, at least
    two and at most ``WAVES`` waves of the cluster's cores: map x reduce blocks
    grow with the product, and pruning and pre-aggregation leave most shuffles
    far smaller than the input.  AQE coalesces the small partitions of
    selective stages back to the advisory size.
    """
    slots = max(1, executors * cores_per_executor)
    parts = min(WAVES * slots, max(2 * slots, -(-int(input_bytes) // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tidewater", extra: dict | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """A session with the scale settings.  ``event_log_dir`` writes Spark's
    event log (stage and task times) to that folder."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                          .config("spark.eventLog.dir", event_log_dir))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_scale_conf(spark)
    return spark


def ensure_scale_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to a session someone else built, where
    that session has none of its own.  Zone-less timestamps of the tables are
    read in the session's time zone; the library's epoch arithmetic expects
    UTC, so another zone set by the caller is refused rather than replaced."""
    for k, v in SCALE_CONF.items():
        if spark.conf.get(k, None) is None and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {zone}; set it to UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is unset, a
    fresh local folder is created and registered, but only under a ``local``
    master (tests, single-machine runs): on a cluster each executor would
    write to its own disk, so that is refused.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidewater-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused)."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Write ``df`` as a parquet table under the shared folder and read it
    back: a stage hand-off (like a topic between the reference's jobs) that
    cuts lineage, is read by every later branch instead of recomputing, and
    survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
