"""Small files and folders of the cluster's storage, through Hadoop's file
system API: whatever scheme the shared folder has, Spark can reach it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, p = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet; readers see all of it or nothing."""
    fs, p = _open(spark, path)
    _, part = _open(spark, f"{path}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(part, p):
        raise FileExistsError(f"{path} was written by somebody else")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, p = _open(spark, path)
    return int(fs.getContentSummary(p).getLength())


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a path that must not exist yet."""
    fs, p = _open(spark, source)
    _, t = _open(spark, target)
    fs.mkdirs(t.getParent())
    if fs.exists(t) or not fs.rename(p, t):
        raise FileExistsError(f"{source} cannot be moved to {target}")

