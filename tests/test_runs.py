"""Keyed tables of sorted runs: same table as a plain fold, cost, leases, replays, hot and null keys."""
import random

import pytest
from pyspark.sql import functions as F

from tidewater import storage
from tidewater.operators import orders as O
from tidewater.plans import fixtures as FX
from tidewater.plans import jobs as JB
from tidewater.sources import runs as R

SCHEMA = "k string, v int, seq long"


def batch(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def table(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_fold(spark, tmp_dir):
    """Any batches, in any order of seq, null keys and repeated rows: the newest row per key."""
    rng = random.Random(1)
    want = {}
    for n in range(20):
        rows = [(rng.choice([None, *"abcdefgh", f"x{n}"]), rng.randint(0, 99), rng.randint(0, 10 ** 9)) for _ in range(rng.randint(1, 9))]
        for k, v, s in rows:
            if k not in want or s > want[k][1]:
                want[k] = (v, s)
        assert R.upsert(batch(spark, rows), tmp_dir, ["k"], "seq", n, fanout=4) == len({r[0] for r in rows})
    assert table(R.read(spark, tmp_dir)) == sorted(((k, *x) for k, x in want.items()), key=str)
    some = batch(spark, [("a",), (None,), ("nobody",)], "k string")
    assert table(R.read(spark, tmp_dir, some)) == sorted(((k, *want[k]) for k in ("a", None) if k in want), key=str)
    assert R.read(spark, f"{tmp_dir}/none") is None
    with pytest.raises(ValueError):
        R.upsert(batch(spark, [("a", 1, 1)]), tmp_dir, ["v"])


def test_cost_follows_the_batch(spark, tmp_dir):
    """A small batch against a large table writes a small run and touches no stored file; runs and files stay few."""
    R.upsert(spark.range(200_000).selectExpr("cast(id as string) k", "cast(hash(id) as int) v", "id seq"), tmp_dir, ["k"], "seq", 0)
    stored = {r["path"]: r["bytes"] for r in R.newest(spark, tmp_dir)["runs"]}
    big = sum(stored.values())
    for n in range(1, 30):
        R.upsert(batch(spark, [(str(n), n, 10 ** 9 + n)]), tmp_dir, ["k"], "seq", n)
        runs = R.newest(spark, tmp_dir)["runs"]
        assert set(stored) <= {r["path"] for r in runs} and len(runs) <= R.FANOUT
        assert runs[-1]["bytes"] < big / 100
    assert R.read(spark, tmp_dir).count() == 200_000
    assert len(storage.names(spark, f"{tmp_dir}/_versions")) <= 4
    assert len(storage.names(spark, f"{tmp_dir}/data")) <= 2 * R.FANOUT


def test_replayed_batch(spark, tmp_dir):
    R.upsert(batch(spark, [("a", 1, 1)]), tmp_dir, ["k"], "seq", 0)
    assert R.upsert(batch(spark, [("a", 2, 2)]), tmp_dir, ["k"], "seq", 1) == 1
    state = R.newest(spark, tmp_dir)
    assert R.upsert(batch(spark, [("a", 2, 2)]), tmp_dir, ["k"], "seq", 1) == 0 and R.newest(spark, tmp_dir) == state


def test_compaction_failure_keeps_the_version(spark, tmp_dir, monkeypatch):
    for n in range(3):
        R.upsert(batch(spark, [(f"k{n}", n, n)]), tmp_dir, ["k"], "seq", n, fanout=9)
    state = R.newest(spark, tmp_dir)
    monkeypatch.setattr(storage, "put_new", lambda *a: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        R.compact(spark, tmp_dir, 3)
    monkeypatch.undo()
    assert R.newest(spark, tmp_dir) == state and R.read(spark, tmp_dir).count() == 3
    assert R.compact(spark, tmp_dir, 3) and len(R.newest(spark, tmp_dir)["runs"]) == 1
    assert R.read(spark, tmp_dir).count() == 3


def test_reader_holds_its_version(spark, tmp_dir):
    """A frame that was handed out stays readable through upserts, compaction and vacuum; the next get is new."""
    clock = [1000.0]
    R.upsert(batch(spark, [("a", 0, 0)]), tmp_dir, ["k"], "seq")
    reader = R.DimReader(tmp_dir, seconds=3600, reader="job.1")
    old = reader.get(spark)
    for n in range(1, 12):
        R.upsert(batch(spark, [("a", n, n), (f"k{n}", n, n)]), tmp_dir, ["k"], "seq")
    assert table(old) == [("a", 0, 0)]
    fresh = reader.get(spark)
    assert fresh.count() == 12 and fresh.where("k = 'a'").first().v == 11
    assert {r for r, *_ in R.leases(spark, tmp_dir)} == {"job.1"} and len(R.leases(spark, tmp_dir)) == 1
    reader.close(spark)
    assert R.leases(spark, tmp_dir) == []
    # refresh: the version is kept for a while, as a cache would; an expired lease holds nothing
    slow = R.DimReader(tmp_dir, seconds=60, refresh=100, clock=lambda: clock[0])
    assert slow.get(spark).count() == 12
    R.upsert(batch(spark, [("new", 1, 1)]), tmp_dir, ["k"], "seq")
    clock[0] += 50
    assert slow.get(spark).count() == 12
    clock[0] += 100
    assert slow.get(spark).count() == 13
    R.vacuum(spark, tmp_dir, clock=lambda: clock[0] + 1000)
    assert R.leases(spark, tmp_dir) == []


def test_reader_schema_and_empty_tables(spark, tmp_dir):
    with pytest.raises(ValueError):
        R.DimReader(tmp_dir).get(spark)
    schema = batch(spark, [], "k string, v double, w string").schema
    assert R.DimReader(tmp_dir, schema).get(spark).count() == 0
    R.create(spark, tmp_dir, ["v"], ["k"])
    assert R.DimReader(tmp_dir).get(spark).columns == ["k", "v"]
    R.upsert(batch(spark, [("a", 3, 1)]), tmp_dir, ["k"], "seq")
    assert table(R.DimReader(tmp_dir, schema).get(spark)) == [("a", 3.0, None)]


def test_upsert_many(spark, tmp_dir):
    """All tables of a batch in one pass; a table without rows is not touched; a replay changes nothing."""
    tables = {"t1": (["name"], "id"), "t2": (["code", "x"], "code"), "t3": (["y"], "id")}
    for t, (cols, k) in tables.items():
        R.create(spark, f"{tmp_dir}/{t}", cols, [k])
    rows = lambda *r: batch(spark, list(r), "sink_table string, after map<string,string>, seq long")
    first = rows(("t1", {"id": "1", "name": "a", "z": "?"}, 1), ("t1", {"id": "1", "name": "b"}, 2),
                 ("t2", {"code": "c", "x": "1"}, 1), ("other", {"id": "1"}, 1))
    assert sorted(R.upsert_many(first, tmp_dir, tables, batch_id=0)) == ["t1", "t2"]
    assert R.upsert_many(first, tmp_dir, tables, batch_id=0) == []
    R.upsert_many(rows(("t1", {"id": "2"}, 3), ("t1", {"id": "1", "name": "late"}, 0)), tmp_dir, tables, batch_id=1)
    assert table(R.read(spark, f"{tmp_dir}/t1").select("id", "name")) == [("1", "b"), ("2", None)]
    assert table(R.read(spark, f"{tmp_dir}/t2").select("code", "x")) == [("c", "1")]
    assert R.newest(spark, f"{tmp_dir}/t3")["version"] == 1 and storage.names(spark, f"{tmp_dir}/_staged") == []


def test_seen_keys_stay_few_files(spark, tmp_dir):
    """U4: 60 batches, each with an old key and a new one; a replay of the last is unchanged."""
    for n in range(60):
        rows = batch(spark, [(f"k{n}", n), (f"k{max(n - 1, 0)}", n)], "dedup_key string, id int")
        for _ in range(2 if n in (30, 59) else 1):
            fresh = R.missing_from(rows, tmp_dir, "dedup_key", n)
            assert [r.id for r in fresh.where(F.col("dedup_key") == f"k{n}").collect()][:1] == [n]
            assert fresh.count() == (2 if n == 0 else 1)
            R.upsert(fresh.select("dedup_key"), tmp_dir, ["dedup_key"], None, n)
    assert len(R.newest(spark, tmp_dir)["runs"]) < R.FANOUT
    assert len(storage.names(spark, f"{tmp_dir}/data")) <= 2 * R.FANOUT
    assert R.read(spark, tmp_dir).count() == 60


SF_DIR = "/root/testdata/sf0.001"


def test_job_follows_a_changing_dimension(spark, tmp_dir):
    """Order wide per micro-batch: names change while the stream runs, with upserts and clean-ups in between."""
    orders, details = FX.order_info(spark, SF_DIR), FX.order_detail(spark, SF_DIR)
    ids = [r[0] for r in orders.select("id").orderBy("id").collect()]
    half = ids[len(ids) // 2]
    for part in (orders.where(F.col("id") < half), orders.where(F.col("id") >= half)):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/orders")
    details.coalesce(1).write.parquet(f"{tmp_dir}/details")
    static = {"user": FX.dim_user_info(spark, SF_DIR), "spu": FX.dim_spu_info(spark, SF_DIR), "sku": FX.dim_sku_info(spark, SF_DIR),
              "trademark": FX.dim_base_trademark(spark, SF_DIR), "category": FX.dim_base_category3(spark, SF_DIR)}
    province = FX.dim_base_province(spark, SF_DIR)
    target = f"{tmp_dir}/dim/province"
    R.upsert(province.withColumn("seq", F.lit(0).cast("long")), target, ["id"], "seq")
    users = f"{tmp_dir}/dim/user"
    R.upsert(static["user"].withColumn("seq", F.lit(0).cast("long")), users, ["id"], "seq")

    class Changing(R.DimReader):
        gets = 0

        def get(self, spark, only=None):
            out = super().get(spark, only)
            self.gets += 1
            for n in range(5):  # after the frame was handed out, five more versions
                R.upsert(province.withColumns({"name": F.concat(F.lit(f"{self.gets}."), "name"),
                                               "seq": F.lit(10 * self.gets + n).cast("long")}), target, ["id"], "seq")
            return out

    wide_ms = 400 * 86_400_000
    dims = static | {"province": Changing(target, province.schema), "user": R.DimReader(users, static["user"].schema)}
    t = lambda n, df: JB.Topic(f"{tmp_dir}/{n}", df.schema, max_files_per_trigger=1)
    q = JB.order_wide(spark, t("orders", orders), t("details", details), dims, JB.Topic(f"{tmp_dir}/wide"), f"{tmp_dir}/ck",
                      lo_ms=-wide_ms, hi_ms=wide_ms, delay="5000 days")
    assert q.awaitTermination(300) and q.exception() is None
    got = spark.read.parquet(f"{tmp_dir}/wide")
    want = O.enrich_order(O.order_wide(orders, details, -wide_ms, wide_ms), static["user"], province, *[
        static[n] for n in ("sku", "spu", "trademark", "category")])
    plain = F.regexp_replace("province_name", r"^\d+\.", "").alias("province_name")
    cols = ["detail_id", "user_age", "user_gender", "sku_name", "tm_name"]
    assert table(got.select(*cols, plain)) == table(want.select(*cols, "province_name"))
    first = got.select("batch_id", F.regexp_extract("province_name", r"^(\d*)", 1).alias("n")).distinct().collect()
    assert len({r.batch_id for r in first}) >= 2 and len({r.n for r in first}) == len(first)
