"""The two-phase sink: one copy after a failed, a retried and a replayed write; batch and stream."""
import pytest
from pyspark.sql import functions as F

from tidewater.sources import transactional as TX

SCHEMA = "id bigint, name string"


def save(df, path, **options):
    TX.register(df.sparkSession)
    df.write.format(TX.FORMAT).option("path", path).options(**options).mode("append").save()


def got(spark, path, schema=SCHEMA):
    from pyspark.sql import types as T
    return sorted(map(tuple, TX.read_committed(spark, path, T._parse_datatype_string(schema)).collect()))


def test_commit_and_replay(spark, tmp_dir):
    df = spark.range(1000).selectExpr("id", "concat('n', id) name", "'x' secret").repartition(3)
    want = [(i, f"n{i}") for i in range(1000)]
    for _ in range(2):
        save(df, tmp_dir, batch_id=7, flush_rows=100, exclude="secret")
    assert got(spark, tmp_dir) == want and len(TX.committed_files(tmp_dir)) >= 10
    assert TX.collect_garbage(tmp_dir, 0) == 0  # the replay left nothing behind
    save(df, tmp_dir, exclude="secret")
    assert len(got(spark, tmp_dir)) == 2000
    save(df.limit(0), tmp_dir, batch_id=8, exclude="secret")
    assert len(got(spark, tmp_dir)) == 2000


def test_failed_write_leaves_nothing(spark, tmp_dir):
    bad = spark.range(500).repartition(4).select("id", F.when(F.col("id") == 499, F.raise_error(F.lit("boom"))).otherwise("n").alias("name"))
    with pytest.raises(Exception):
        save(bad, tmp_dir, batch_id=1, flush_rows=10)
    assert got(spark, tmp_dir) == []
    save(spark.range(3).selectExpr("id", "'n' name"), tmp_dir, batch_id=1)
    assert got(spark, tmp_dir) == [(0, "n"), (1, "n"), (2, "n")]
    TX.collect_garbage(tmp_dir, 0)
    assert got(spark, tmp_dir) == [(0, "n"), (1, "n"), (2, "n")]


def test_writes_are_tried_again(monkeypatch, tmp_path):
    from pyspark.sql import types as T
    import pyarrow as pa
    schema = T._parse_datatype_string(SCHEMA)
    sink = TX._Sink({"path": str(tmp_path), "flush_rows": "2"}, schema)
    tries = []
    write = TX.pq.write_table

    def flaky(*a):
        tries.append(1)
        if len(tries) in (1, 2):
            raise OSError("busy")
        write(*a)
    monkeypatch.setattr(TX.pq, "write_table", flaky)
    monkeypatch.setattr(TX, "PAUSE", 0)
    rows = pa.RecordBatch.from_pydict({"id": [1, 2, 3], "name": ["a", "b", "c"]})
    staged = sink.stage(iter([rows]), "w")
    assert staged.rows == 3 and len(staged.files) == 2 and len(tries) == 4
    sink.flush_rows, sink.flush_seconds = 100, 0  # by time: every batch
    assert len(sink.stage(iter([rows, rows]), "w").files) == 2
    monkeypatch.setattr(TX.pq, "write_table", lambda *a: (_ for _ in ()).throw(OSError("down")))
    with pytest.raises(OSError):
        sink.stage(iter([rows]), "w")


def test_stream(spark, tmp_dir):
    """Batches of a stream, with a restart: each is there once."""
    TX.register(spark)
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    for lo in (0, 10, 20):
        spark.range(lo, lo + 10).selectExpr("id", "'n' name").coalesce(1).write.mode("append").parquet(src)

    def run():
        s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        q = (s.writeStream.format(TX.FORMAT).option("path", out).option("checkpointLocation", f"{tmp_dir}/ck")
             .trigger(availableNow=True).start())
        assert q.awaitTermination(120) and q.exception() is None
    run()
    assert got(spark, out) == [(i, "n") for i in range(30)]
    spark.range(30, 35).selectExpr("id", "'n' name").coalesce(1).write.mode("append").parquet(src)
    run()
    assert got(spark, out) == [(i, "n") for i in range(35)]
