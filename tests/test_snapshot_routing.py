"""Snapshot-then-changes and as-of configuration: batch = stream, restart, changes between the marks."""
import pytest
from pyspark.sql import functions as F

from tidewater.operators.routing import ROUTE_COLS, config_versions, route_as_of
from tidewater.plans import jobs as JB
from tidewater.sources import runs as R
from tidewater.sources.changes import apply_changelog
from tidewater.sources.snapshot import SnapshotThenChanges, SourceTable
from tidewater.streaming import forms as SF
from tidewater.streaming.routing import route_as_of_stream

ENV = ("database string, table_name string, type string, before map<string,string>, after map<string,string>, "
       "ts_ms long, seq long")


def history(n=120):
    """Changes of two tables, one not allowed, with inserts, updates, deletes, a key that changes."""
    out, live, names = [], {}, ["a", "b", "secret"]
    for seq in range(1, n + 1):
        t = names[seq % 3]
        key = str((seq * 7) % 23)
        row = {"id": key, "v": str(seq)}
        old = live.get((t, key))
        if old and seq % 5 == 0:
            out.append(("db", t, "delete", old, {}, 0, seq))
            del live[t, key]
        else:
            out.append(("db", t, "update" if old else "insert", old or {}, row, 0, seq))
            live[t, key] = row
    return out


def table_at(changes, name, seq):
    rows = {}
    for _, t, kind, before, after, _, s in changes:
        if t == name and s <= seq:
            if kind == "delete":
                rows.pop(before["id"], None)
            else:
                rows[after["id"]] = after
    return [(r["id"], r["v"]) for r in rows.values()]


def final(df):
    return sorted((r.table_name, r.after["id"], r.after["v"]) for r in apply_changelog(df, ["id"]).collect())


@pytest.mark.parametrize("ahead", [0, 15])
def test_snapshot_then_changes(spark, tmp_dir, ahead):
    """The log starts at seq 60, the tables run ``ahead`` changes before what the stream has read;
    the run stops in the middle and starts again."""
    changes = history()
    emitted = f"{tmp_dir}/out"
    clock = {"log": 60}
    load = lambda t: SourceTable("db", t, "id", lambda s: s.createDataFrame(
        table_at(changes, t, clock["log"] + ahead), "id string, v string"), chunks=3)
    topic = JB.Topic(emitted)
    handler = lambda: SnapshotThenChanges([load("a"), load("b"), load("secret")], topic.write_batch,
                                          lambda s: min(clock["log"] + ahead, 120), f"{tmp_dir}/snap", ["db"], ["db.a", "b"])
    h = handler()
    assert [t.name for t in h.tables] == ["a", "b"]
    for batch, lo in enumerate(range(60, 120, 10)):
        part = spark.createDataFrame([c for c in changes if lo < c[-1] <= lo + 10], ENV)
        clock["log"] = lo + 10
        if batch == 3:
            # crash after the output, before the step was saved; then a new process gives the batch again
            h._save = lambda *a: (_ for _ in ()).throw(OSError("crash"))
            with pytest.raises(OSError):
                h(part, batch)
            h = handler()
        h(part, batch)
        assert len(h._load(spark, None)["waiting"]) <= 3
    h.drain(spark)
    assert h.finished(spark)
    out = spark.read.parquet(emitted)
    allowed = [c for c in changes if c[1] != "secret"]
    assert final(out) == sorted((t, k, v) for t in ("a", "b") for k, v in table_at(changes, t, 120))
    got = sorted(r.seq for r in out.where("type <> 'read'").collect())
    assert got == [c[-1] for c in allowed if c[-1] > 60]
    # a read row is the state at its low mark, and no later change of the key lies before its high mark
    for r in out.where("type = 'read'").collect():
        assert (r.after["id"], r.after["v"]) in table_at(changes, r.table_name, r.seq if r.seq >= 60 else 60)


def test_snapshot_without_changes_and_empty_tables(spark, tmp_dir):
    topic = JB.Topic(f"{tmp_dir}/out")
    rows = spark.createDataFrame([(None, "x"), ("1", "y"), ("2", "z")], "id string, v string")
    h = SnapshotThenChanges([SourceTable("db", "a", "id", lambda s: rows, 2),
                             SourceTable("db", "none", "id", lambda s: rows.limit(0), 1)],
                            topic.write_batch, lambda s: -1, f"{tmp_dir}/snap")
    h.drain(spark)
    assert h.finished(spark)
    assert sorted((str(r.after["id"]), r.type) for r in spark.read.parquet(topic.name).collect()) == [
        ("1", "read"), ("2", "read"), ("None", "read")]


# -------------------------------------------------------------- as-of routes
CFG = "type string, seq long, source_table string, operate_type string, " + ", ".join(f"{c} string" for c in ROUTE_COLS)
CONFIG = [("insert", 10, "a", "insert", "kafka", "dwd_a", "id", None), ("update", 50, "a", "insert", "hbase", "dim_a", "v", "id"),
          ("insert", 20, "a", "update", "kafka", "dwd_a", "id,v", None), ("delete", 70, "a", "update", None, None, None, None),
          ("insert", 90, "a", "update", "kafka", "dwd_a2", "v", None), ("insert", 100, "b", "update", "hbase", "dim_b", "id,v", "id")]


def routed_rows(df):
    return sorted((r.seq, r.sink_type, r.sink_table, tuple(sorted(r.after.items()))) for r in df.collect())


def plain_routes(changes, wait, config=CONFIG):
    out = []
    for _, t, kind, _, after, _, seq in changes:
        versions = sorted((c for c in config if c[2:4] == (t, kind)), key=lambda c: c[1])
        now = [c for c in versions if c[1] <= seq][-1:] or (versions[:1] if wait else [])
        if now and now[0][0] != "delete":
            c = now[0]
            keep = set(c[6].split(",")) | ({c[7] or "id"} if c[4] == "hbase" else set())
            out.append((seq, c[4], c[5], tuple(sorted((k, v) for k, v in after.items() if k in keep))))
    return sorted(out)


@pytest.mark.parametrize("wait", [False, True])
def test_route_as_of_batch_and_stream(spark, tmp_dir, wait):
    changes = [c for c in history() if c[2] != "delete"]
    df, cfg = spark.createDataFrame(changes, ENV), spark.createDataFrame(CONFIG, CFG)
    want = plain_routes(changes, wait)
    assert len(want) > 30 and len({w[2] for w in want}) >= 3
    assert routed_rows(route_as_of(df, config_versions(cfg), wait=wait)) == want
    # stream: both topics in slices; with wait the configuration comes a slice later than the changes it is for
    late = 30 if wait else 0
    for lo in range(0, 160, 30):
        df.where((F.col("seq") >= lo) & (F.col("seq") < lo + 30)).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/ch")
        cfg.where((F.col("seq") >= lo - late) & (F.col("seq") < lo + 30 - late)).where("source_table = 'b' or seq < 50" if wait else "true") \
            .coalesce(1).write.mode("append").parquet(f"{tmp_dir}/cfg")
    if wait:  # first versions are waited for, later ones must be there in time: here only first ones
        want = plain_routes(changes, True, [c for c in CONFIG if c[2] == "b" or c[1] < 50])
    s = lambda n, d: spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/{n}")
    q = SF.start(route_as_of_stream(s("ch", df), s("cfg", cfg), wait, slots=3), f"{tmp_dir}/ck", f"{tmp_dir}/out")
    assert q.awaitTermination(300) and q.exception() is None
    assert routed_rows(spark.read.parquet(f"{tmp_dir}/out")) == want


def test_routing_job_with_changing_routes(spark, tmp_dir):
    changes = history()
    df, cfg = spark.createDataFrame(changes, ENV), spark.createDataFrame(CONFIG, CFG)
    cfg.coalesce(1).write.parquet(f"{tmp_dir}/cfg")
    for lo in (0, 60):
        df.where((F.col("seq") > lo) & (F.col("seq") <= lo + 60)).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/ch")
    q = JB.db_routing_as_of(spark, JB.Topic(f"{tmp_dir}/ch", df.schema, max_files_per_trigger=1), JB.Topic(f"{tmp_dir}/cfg", cfg.schema),
                            JB.Topic(f"{tmp_dir}/fact"), f"{tmp_dir}/dim", f"{tmp_dir}/ck", slots=2)
    assert q.awaitTermination(300) and q.exception() is None
    want = plain_routes([c for c in changes if c[2] != "delete"], False)
    facts = sorted((r.sink_table, r.seq) for r in spark.read.parquet(f"{tmp_dir}/fact").collect())
    assert facts == sorted((t, s) for s, kind, t, _ in want if kind == "kafka")
    for t in ("dim_a", "dim_b"):
        newest = {}
        for s, _, table, row in want:
            if table == t:
                newest[dict(row)["id"]] = s
        assert {r.id: r.seq for r in R.read(spark, f"{tmp_dir}/dim/{t}").collect()} == newest
