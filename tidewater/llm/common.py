"""Helpers shared by the training-data operators.

Rules that hold for every operator here:

* only the columns an operator names are read, so extra columns never clash;
* a row of ``documents`` is known by ``(doc_id, text)``: rows that repeat both
  are one document given twice and get the same result; a null id is an id;
* intermediate tables go to the folder in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Word separators: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch: texts can be long, and a batch is held by a task on both sides.
ARROW_ROWS, ARROW_KEY = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of a session that sets no bound of its own."""
    if spark.conf.get(ARROW_KEY, None) is None:
        spark.conf.set(ARROW_KEY, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, path: bool = False):
    """``df`` written as a table in the shared folder and read back, which cuts
    lineage; with ``path`` also where it lies, for ``discard``."""
    small_batches(df.sparkSession)
    folder = scratch_path(df.sparkSession, name)
    df.write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    return (out, folder) if path else out


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a written table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value``, which is evaluated once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Array of the words of ``text`` (null: empty)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))


def attach(left: DataFrame, right: DataFrame, *keys: str, how: str = "left") -> DataFrame:
    """``left`` with the other columns of ``right``, joined on null-safe ``keys``."""
    side = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda x, y: x & y, [left[k].eqNullSafe(side[f"__r_{k}"]) for k in keys])
    out = left.join(side, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__r_{k}" for k in keys])


def text_key(text: Column) -> Column:
    """64 bits of a text, which tell apart rows that share an id."""
    return F.xxhash64(text)
