"""A table sink with a two-phase commit (K3, K4), as a Spark data source.

Tasks stage their rows as files below the target: ``flush_rows`` rows at a
time, or what they have after ``flush_seconds``, each write tried ``retries``
times more.  Nothing staged is part of the table.  When all tasks are done the
driver puts one manifest in place that names the staged files of the whole
write; a failed write is aborted, its files go.  A write with a ``batch_id``
that has a manifest already commits nothing, so a replayed batch leaves one
copy, and so does a task that ran twice (the driver names the files of the
attempt that it heard of).

    register(spark)
    df.write.format("transactional").option("path", p).option("batch_id", 7).mode("append").save()
    read_committed(spark, p)

The target lies on storage that all executors see; tasks reach it through
pyarrow's file systems (``file:``, ``hdfs:``, ``s3:`` URIs).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

FORMAT = "transactional"
FLUSH_ROWS, FLUSH_SECONDS, RETRIES, PAUSE = 5000, 2.0, 2, 0.2


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


@dataclass
class Staged(WriterCommitMessage):
    files: list[str]
    rows: int


class _Sink:
    """What batch and stream writers share."""

    def __init__(self, options: dict, schema: T.StructType):
        self.uri, self.schema = options["path"].rstrip("/"), schema
        drop = {c.strip() for c in options.get("exclude", "").split(",") if c.strip()}
        self.columns = [f.name for f in schema if f.name not in drop]
        self.flush_rows = int(options.get("flush_rows", FLUSH_ROWS))
        self.flush_seconds = float(options.get("flush_seconds", FLUSH_SECONDS))
        self.retries = int(options.get("retries", RETRIES))
        self.batch_id = options.get("batch_id")
        self.write_id = uuid.uuid4().hex

    def stage(self, batches: Iterator[pa.RecordBatch], name: str) -> Staged:
        fs, root = _open(self.uri)
        files, rows, held, n, since = [], 0, [], 0, time.monotonic()

        def flush() -> None:
            nonlocal held, n, rows, since
            if n:
                file = f"_staged/{name}/{uuid.uuid4().hex}.parquet"
                self._put(fs, f"{root}/{file}", pa.Table.from_batches(held))
                files.append(file)
                rows += n
            held, n, since = [], 0, time.monotonic()

        for b in batches:
            b = b.select(self.columns)
            at = 0
            while at < b.num_rows:
                part = b.slice(at, self.flush_rows - n)
                held.append(part)
                n, at = n + part.num_rows, at + part.num_rows
                if n >= self.flush_rows or time.monotonic() - since >= self.flush_seconds:
                    flush()
        flush()
        return Staged(files, rows)

    def _put(self, fs: pafs.FileSystem, path: str, table: pa.Table) -> None:
        for attempt in range(self.retries + 1):
            try:
                fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(path) as out:
                    pq.write_table(table, out)
                return
            except OSError:
                if attempt == self.retries:
                    raise
                time.sleep(PAUSE * 2 ** attempt)

    def publish(self, messages: list[Staged | None], name: str) -> None:
        """One manifest for the write, put in place by a rename; none if the name is taken."""
        fs, root = _open(self.uri)
        files = [f for m in messages if m is not None for f in m.files]
        path = f"{root}/_manifests/{name}.json"
        fs.create_dir(f"{root}/_manifests", recursive=True)
        if fs.get_file_info(path).type != pafs.FileType.NotFound:
            self.clean(messages)
            return
        part = f"{path}.{self.write_id}.part"
        with fs.open_output_stream(part) as out:
            out.write(json.dumps({"files": files, "rows": sum(m.rows for m in messages if m is not None)}).encode())
        fs.move(part, path)

    def clean(self, messages: list[Staged | None]) -> None:
        fs, root = _open(self.uri)
        for m in messages:
            for f in m.files if m is not None else []:
                if fs.get_file_info(f"{root}/{f}").type != pafs.FileType.NotFound:
                    fs.delete_file(f"{root}/{f}")


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType):
        self.sink = _Sink(options, schema)
        self.name = f"batch-{int(self.sink.batch_id):012d}" if self.sink.batch_id is not None else f"write-{self.sink.write_id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.sink.stage(iterator, self.name)

    def commit(self, messages: list[Staged | None]) -> None:
        self.sink.publish(messages, self.name)

    def abort(self, messages: list[Staged | None]) -> None:
        self.sink.clean(messages)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict, schema: T.StructType):
        self.sink = _Sink(options, schema)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.sink.stage(iterator, f"stream-{self.sink.write_id}")

    def commit(self, messages: list[Staged | None], batchId: int) -> None:  # noqa: N803 - Spark's name
        self.sink.publish(messages, f"batch-{batchId:012d}")

    def abort(self, messages: list[Staged | None], batchId: int) -> None:  # noqa: N803
        self.sink.clean(messages)


class TransactionalTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("this sink appends")
        return BatchWriter(dict(self.options), schema)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamWriter:  # noqa: N802
        return StreamWriter(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TransactionalTable)


def committed_files(uri: str) -> list[str]:
    fs, root = _open(uri)
    found = fs.get_file_info(pafs.FileSelector(f"{root}/_manifests", allow_not_found=True))
    out = []
    for f in sorted(x.path for x in found if x.path.endswith(".json")):
        with fs.open_input_stream(f) as s:
            out += [f"{uri.rstrip('/')}/{p}" for p in json.loads(s.read())["files"]]
    return out


def read_committed(spark: SparkSession, uri: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed writes."""
    files = committed_files(uri)
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def collect_garbage(uri: str, older_than: float = 86_400) -> int:
    """Delete staged files that no manifest names and that are older than that many seconds."""
    fs, root = _open(uri)
    live = {f"{root}/{f.removeprefix(uri.rstrip('/') + '/')}" for f in committed_files(uri)}
    found = fs.get_file_info(pafs.FileSelector(f"{root}/_staged", allow_not_found=True, recursive=True))
    dead = [x.path for x in found if x.type == pafs.FileType.File and x.path not in live
            and (x.mtime_ns or 0) / 1e9 <= time.time() - older_than]
    for p in dead:
        fs.delete_file(p)
    return len(dead)
