"""Batch = stream and restart (§5.4) for the streaming forms.

Fixture rows are written as several parquet files in time order and read
back with ``maxFilesPerTrigger=1`` under an ``availableNow`` trigger; a
sentinel row far in the future closes the last windows / timers.
"""
import pytest
from pyspark.sql import functions as F

from tidewater.operators import aggregates as A
from tidewater.operators import joins as J
from tidewater.operators import logs as L
from tidewater.operators import patterns as W
from tidewater.operators.measures import visitor_measures
from tidewater.plans import fixtures as FX
from tidewater.streaming import forms as SF
from tidewater.streaming import stateful as ST

SF_DIR = "/root/testdata/sf0.001"
DAY = 86_400_000
FAR = 4_102_444_800_000  # 2100-01-01


def _key(t):
    return [(v is None, v) for v in t]


def rows(df, *cols):
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=_key)


def write_slices(df, path, col, bounds):
    """One file per [lo, hi) slice of ``col``, written in order."""
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        df.where((F.col(col) >= lo) & (F.col(col) < hi)).coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, df, path):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def finish(q, limit=240):
    done = q.awaitTermination(limit)
    if not done:
        q.stop()
    assert done, "query did not finish"
    assert q.exception() is None


def run_to_table(spark, sdf, tmp, name, mode="append"):
    finish(SF.start(sdf, f"{tmp}/{name}_ckpt", f"{tmp}/{name}_out", mode=mode))
    return spark.read.parquet(f"{tmp}/{name}_out")


@pytest.fixture(scope="module")
def flat_pages(spark):
    p = FX.page_log(spark, SF_DIR)
    return p.select(F.col("common.mid").alias("mid"), "ts", "seq", F.col("page.page_id").alias("page_id"),
                    L.is_entry().alias("entry"), F.col("common.is_new").alias("is_new"))


def day_bounds(spark, df, col="ts"):
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    start = lo - lo % DAY
    return list(range(start, hi + DAY, 7 * DAY)) + [hi + DAY]


def test_visitor_stats_batch_equals_stream(spark, tmp_dir):
    pages = FX.page_log(spark, SF_DIR)
    src = f"{tmp_dir}/pages"
    write_slices(pages, src, "ts", day_bounds(spark, pages))
    sentinel = pages.limit(1).withColumn("ts", F.lit(FAR))
    sentinel.write.mode("append").parquet(src)
    s = stream_of(spark, pages, src)
    m = SF.watermarked(visitor_measures(None, None, s), "ts", "1 second", "et")
    out = run_to_table(spark, A.visitor_stats(m, "1 day", event_col="et"), tmp_dir, "visitor")
    batch = A.visitor_stats(visitor_measures(None, None, pages), "1 day")
    assert rows(out) == rows(batch)


def test_interval_join_batch_equals_stream(spark, tmp_dir):
    o = FX.order_info(spark, SF_DIR).select(F.col("id").alias("order_id"), "create_ts")
    d = FX.order_detail(spark, SF_DIR).select("order_id", F.col("id").alias("detail_id"),
                                              F.col("create_ts").alias("detail_ts"))
    year = 365 * DAY
    lo, hi = o.agg(F.min("create_ts"), F.max("create_ts")).first()
    lo2, hi2 = d.agg(F.min("detail_ts"), F.max("detail_ts")).first()
    bounds = list(range(min(lo, lo2), max(hi, hi2) + year, year))
    write_slices(o, f"{tmp_dir}/o", "create_ts", bounds)
    write_slices(d, f"{tmp_dir}/d", "detail_ts", bounds)
    so = SF.watermarked(stream_of(spark, o, f"{tmp_dir}/o"), "create_ts", "400 days", "o_et")
    sd = SF.watermarked(stream_of(spark, d, f"{tmp_dir}/d"), "detail_ts", "400 days", "d_et")
    j = SF.interval_join_stream(so, sd, ["order_id"], "o_et", "d_et", -20 * DAY, 20 * DAY)
    out = run_to_table(spark, j.select("l.order_id", "detail_id", "create_ts", "detail_ts"), tmp_dir, "ij")
    batch = J.interval_join(o, d, ["order_id"], "create_ts", "detail_ts", -20 * DAY, 20 * DAY)
    assert rows(out, "order_id", "detail_id") == rows(batch, "order_id", "detail_id")
    assert out.count() > 0


def test_unique_visits_batch_equals_stream(spark, tmp_dir, flat_pages):
    entries = flat_pages.where("entry").drop("entry", "is_new")
    src = f"{tmp_dir}/uv"
    write_slices(entries, src, "ts", day_bounds(spark, entries))
    entries.limit(1).withColumn("ts", F.lit(FAR)).withColumn("mid", F.lit("sentinel")) \
        .write.mode("append").parquet(src)
    s = stream_of(spark, entries, src).withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "0 seconds")
    out = run_to_table(spark, ST.unique_visits_stream(s), tmp_dir, "uv").where("mid <> 'sentinel'")
    batch = W.unique_visits(entries, key="mid", last_page=F.lit(None))
    assert rows(out, "seq") == rows(batch, "seq")


def test_fix_is_new_batch_equals_stream(spark, tmp_dir, flat_pages):
    logs = flat_pages.select("mid", "seq", "is_new")
    src = f"{tmp_dir}/fix"
    write_slices(logs, src, "seq", [0, 200, 500, 1000, 10_000_000])
    out = run_to_table(spark, ST.fix_is_new_stream(stream_of(spark, logs, src)), tmp_dir, "fix")
    batch = L.fix_is_new(logs, key="mid", flag="is_new")
    assert rows(out, "seq", "is_new") == rows(batch, "seq", "is_new")


def test_bounces_batch_equals_stream_and_restart(spark, tmp_dir, flat_pages):
    within = 12 * 3_600_000
    pages = flat_pages.select("mid", "ts", "seq", "page_id", "entry")
    src = f"{tmp_dir}/bounce"
    bounds = day_bounds(spark, pages)
    half = len(bounds) // 2
    write_slices(pages, src, "ts", bounds[:half + 1])
    ckpt, sink = f"{tmp_dir}/bounce_ckpt", f"{tmp_dir}/bounce_out"

    def run():
        s = stream_of(spark, pages, src).withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "0 seconds")
        finish(SF.start(ST.bounces_stream(s, within), ckpt, sink))

    run()                                       # first half, then stop
    write_slices(pages, src, "ts", bounds[half:])
    pages.limit(1).withColumn("ts", F.lit(FAR)).withColumn("mid", F.lit("sentinel")) \
        .write.mode("append").parquet(src)
    run()                                       # resume from the checkpoint
    out = spark.read.parquet(sink)
    b = W.bounces(pages.withColumn("last", F.when(F.col("entry"), None).otherwise(F.lit("x"))), within,
                  key="mid", last_page="last")
    assert rows(out, "seq") == rows(b, "seq")
    m = W.bounces(pages.withColumn("last", F.when(F.col("entry"), None).otherwise(F.lit("x"))), within,
                  key="mid", last_page="last", kind="matched")
    assert rows(out.where("kind = 'matched'"), "seq") == rows(m, "seq")


def test_danger_drive_and_repeat_plates_stream(spark, tmp_dir):
    cars = FX.car_info(spark, SF_DIR).withColumn(
        "ts", F.unix_millis(F.to_timestamp("action_time")))
    limits = FX.speed_limit(spark, SF_DIR)
    over = J.with_speed_limit(cars, limits).where(F.col("speed") > F.col("limit_speed") * 1.2) \
        .select("car_id", "ts", "seq", "action_time")
    within = 72 * 3_600_000
    src = f"{tmp_dir}/over"
    write_slices(over, src, "ts", day_bounds(spark, over))
    over.limit(1).withColumn("ts", F.lit(FAR)).withColumn("car_id", F.lit("sentinel")).write.mode("append").parquet(src)
    s = stream_of(spark, over, src).withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "0 seconds")
    out = run_to_table(spark, ST.danger_drive_stream(s, within), tmp_dir, "danger")
    batch = W.danger_drive(over.withColumn("speed", F.lit(2.0)).withColumn("limit_speed", F.lit(1.0))
                           .withColumnRenamed("ts", "ts_ms"), within)
    assert rows(out, "car_id", "time_1", "time_2", "time_3") == rows(batch, "car_id", "time_1", "time_2", "time_3")

    plates = cars.select("car_id", "ts", "seq", "action_time")
    src2 = f"{tmp_dir}/plates"
    write_slices(plates, src2, "seq", [0, 300, 700, 10_000_000])
    out2 = run_to_table(spark, ST.repeat_plates_stream(stream_of(spark, plates, src2), 3_600_000), tmp_dir, "plates")
    batch2 = W.repeat_plates(plates.withColumnRenamed("ts", "ts_ms"), 3_600_000)
    assert rows(out2, "seq") == rows(batch2, "seq")


def test_match_or_timeout_stream(spark, tmp_dir):
    base = 1_700_000_000_000
    v = spark.createDataFrame([("a", base, 1), ("b", base, 2), ("c", base + 50_000, 3)],
                              "car_id string, ts long, seq long")
    p = spark.createDataFrame([("a", base + 3_000, 10), ("c", base + 90_000, 11)],
                              "car_id string, ts long, seq long")
    for df, name in ((v, "v"), (p, "p")):
        df.coalesce(1).write.parquet(f"{tmp_dir}/{name}")
        df.limit(1).withColumn("ts", F.lit(FAR)).withColumn("car_id", F.lit("zz")) \
            .withColumn("seq", F.lit(99 if name == "v" else 98).cast("long")) \
            .coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{name}")
    sv = stream_of(spark, v, f"{tmp_dir}/v").withColumn("et", F.timestamp_millis("ts"))
    sp = stream_of(spark, p, f"{tmp_dir}/p").withColumn("et", F.timestamp_millis("ts"))
    out = run_to_table(spark, ST.match_or_timeout_stream(sv, sp, "car_id", "et", 5_000, "0 seconds"),
                       tmp_dir, "mt")
    got = rows(out.where("car_id <> 'zz'"), "car_id", "l_id", "r_id", "status")
    assert got == [("a", 1, 10, "matched"), ("b", 2, None, "left_only"),
                   ("c", 3, None, "left_only"), ("c", None, 11, "right_only")]


def test_match_or_timeout_stream_is_the_batch_form(spark, tmp_dir):
    """Several pending rows per car, and one car with 60 % of the rows."""
    import random
    from tidewater.operators import joins as J
    rng, base = random.Random(8), 1_700_000_000_000
    car = lambda: "hot" if rng.random() < .6 else f"c{rng.randrange(5)}"
    v = [(car(), base + rng.randrange(400_000), i) for i in range(120)]
    p = [(car(), base + rng.randrange(400_000), 1000 + i) for i in range(60)]
    v += [("solo", base, 500), ("solo", base + 1000, 501), ("solo", base + 2000, 502)]
    dfs = [spark.createDataFrame(x, "car_id string, ts long, seq long") for x in (v, p)]
    want = rows(J.match_or_timeout(*dfs, "car_id", "ts", "ts", 5_000), "car_id", "l_id", "r_id", "status")
    streams = []
    for k, df in enumerate(dfs):
        df.coalesce(1).write.parquet(f"{tmp_dir}/{k}")
        df.limit(1).withColumn("ts", F.lit(FAR)).withColumn("car_id", F.lit("zz")).withColumn("seq", F.lit(99 + k).cast("long")) \
            .coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{k}")
        streams.append(stream_of(spark, df, f"{tmp_dir}/{k}").withColumn("et", F.timestamp_millis("ts")))
    out = run_to_table(spark, ST.match_or_timeout_stream(*streams, "car_id", "et", 5_000, "0 seconds"), tmp_dir, "mtb")
    assert rows(out.where("car_id <> 'zz'"), "car_id", "l_id", "r_id", "status") == want


def test_top_n_per_batch(spark, tmp_dir):
    cars = FX.car_info(spark, SF_DIR).withColumn("ts", F.to_timestamp("action_time")) \
        .withColumn("ms", F.unix_millis("ts"))
    src = f"{tmp_dir}/cars"
    write_slices(cars, src, "ms", day_bounds(spark, cars, "ms"))
    cars.limit(1).withColumn("ts", F.lit("2100-01-01 00:00:00").cast("timestamp")) \
        .write.mode("append").parquet(src)
    s = stream_of(spark, cars, src).withWatermark("ts", "0 seconds")
    bands = A.speed_bands(s, "1 day", "6 hours")
    target = f"{tmp_dir}/top"
    finish(SF.start(bands, f"{tmp_dir}/top_ckpt", SF.top_n_per_batch(target, 5, window_cols=("stt", "edt"))))
    out = spark.read.parquet(target).drop("batch_id")
    batch = W.top_monitors(A.speed_bands(cars, "1 day", "6 hours"), 5, window_cols=("stt", "edt"))
    assert rows(out) == rows(batch)


def test_unique_visits_ttl_form(spark, tmp_dir, flat_pages):
    """The processing-time TTL form, one trigger over all input."""
    entries = flat_pages.where("entry").drop("entry", "is_new")
    src = f"{tmp_dir}/uvttl"
    entries.coalesce(1).write.parquet(src)
    q = (ST.unique_visits_stream_ttl(spark.readStream.schema(entries.schema).parquet(src)).writeStream
         .format("memory").queryName("uv_ttl").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/uvttl_ckpt").trigger(processingTime="1 second").start())
    batch = W.unique_visits(entries, key="mid", last_page=F.lit(None))
    expected = batch.count()
    try:
        import time
        deadline = time.time() + 180
        while time.time() < deadline and spark.table("uv_ttl").count() < expected:
            time.sleep(1)
    finally:
        q.stop()
    out = spark.table("uv_ttl")
    assert rows(out, "seq") == rows(batch, "seq")


def test_new_listings_per_batch(spark, tmp_dir):
    from tidewater.operators import listings as LS
    hotels = LS.clean_hotel(FX.hotel_raw(spark, SF_DIR)).select("id", "city", "hotel_name", "dedup_key")
    # second slice repeats the keys of the first one: they must be skipped
    src = f"{tmp_dir}/hotels"
    hotels.where("id < 100").coalesce(1).write.mode("append").parquet(src)
    hotels.coalesce(1).write.mode("append").parquet(src)
    target = f"{tmp_dir}/listings"
    finish(SF.start(stream_of(spark, hotels, src), f"{tmp_dir}/listings_ckpt",
                    SF.new_listings_per_batch(target)))
    out = spark.read.parquet(f"{target}/rows")
    assert rows(out, "id") == rows(LS.dedup_listings(hotels), "id")
    assert out.groupBy("batch_id").count().count() == 2


def test_match_or_timeout_rejects_far_pairs(spark, tmp_dir):
    """Both rows read before the timer fires, but further apart than
    ``wait``: not a match."""
    base = 1_700_000_000_000
    v = spark.createDataFrame([("a", base, 1)], "car_id string, ts long, seq long")
    p = spark.createDataFrame([("a", base + 97_000, 2)], "car_id string, ts long, seq long")
    for df, name in ((v, "v"), (p, "p")):
        df.coalesce(1).write.parquet(f"{tmp_dir}/{name}")
        df.limit(1).withColumn("ts", F.lit(FAR)).withColumn("car_id", F.lit("zz")) \
            .coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{name}")
    sv = spark.readStream.schema(v.schema).parquet(f"{tmp_dir}/v").withColumn("et", F.timestamp_millis("ts"))
    sp = spark.readStream.schema(p.schema).parquet(f"{tmp_dir}/p").withColumn("et", F.timestamp_millis("ts"))
    out = run_to_table(spark, ST.match_or_timeout_stream(sv, sp, "car_id", "et", 5_000, "0 seconds"),
                       tmp_dir, "far")
    got = rows(out.where("car_id = 'a'"), "status")
    assert ("matched",) not in got


def test_changelog_per_batch_equals_batch(spark, tmp_dir):
    from tidewater.sources.changes import apply_changelog, normalize_changes
    changes = normalize_changes(FX.change_records(spark, SF_DIR))
    src = f"{tmp_dir}/changes"
    write_slices(changes, src, "seq", [0, 300, 600, 10_000_000])
    target = f"{tmp_dir}/current"
    finish(SF.start(stream_of(spark, changes, src), f"{tmp_dir}/cl_ckpt", SF.changelog_per_batch(target, ["id"])))
    cur = SF.current_table(spark, target)
    want = apply_changelog(changes, ["id"])
    assert rows(cur, "table_name", "seq") == rows(want, "table_name", "seq")


def test_hot_device_spreads_over_chunks(spark, tmp_dir):
    """One device with 60 % of the rows: its state lies in many keys, the result is the batch form's."""
    import random
    rng = random.Random(8)
    rows_in = [(("hot" if rng.random() < 0.6 else f"m{rng.randint(0, 30)}"), 1_700_000_000_000 + rng.randint(0, 4_000) * 1000, i,
                rng.choice(["home", "list"]), rng.random() < 0.4) for i in range(3000)]
    pages = spark.createDataFrame(rows_in, "mid string, ts long, seq long, page_id string, entry boolean")
    keyed = ST.chunked(pages, 10_000)
    assert keyed.count() < 1.3 * 3000
    per_task = [r.n for r in keyed.repartition(8, "mid", "chunk").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(per_task) < 0.3 * sum(per_task)
    src = f"{tmp_dir}/hot"
    write_slices(pages, src, "ts", [0, 1_700_001_000_000, 1_700_002_005_000, 1_700_003_000_000, FAR])
    pages.limit(1).withColumns({"ts": F.lit(FAR), "mid": F.lit("zz")}).coalesce(1).write.mode("append").parquet(src)
    pages.limit(1).withColumns({"ts": F.lit(FAR), "mid": F.lit("zz")}).coalesce(1).write.mode("append").parquet(src)
    s = stream_of(spark, pages, src).withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "0 seconds")
    out = run_to_table(spark, ST.bounces_stream(s, 10_000), tmp_dir, "hot").where("mid <> 'zz'")
    want = W.bounces(pages.withColumn("last", F.when(~F.col("entry"), "x")), 10_000, key="mid", last_page="last")
    assert rows(out, "seq") == rows(want, "seq")


def test_many_waiting_rows_of_one_car(spark, tmp_dir):
    """10,000 rows of one car wait at once; the batch form's rows."""
    import random
    rng = random.Random(9)
    base = 1_700_000_000_000
    side = lambda n, k: spark.createDataFrame([(("car" if rng.random() < 0.9 else "b"), base + rng.randint(0, 50_000_000), k + i)
                                               for i in range(n)], "car_id string, ts long, seq long")
    v, p = side(6000, 0), side(5000, 10 ** 6)
    for df, name in ((v, "v"), (p, "p")):
        df.repartition(2).write.parquet(f"{tmp_dir}/{name}")
        for _ in range(2):
            df.limit(1).withColumns({"ts": F.lit(FAR), "car_id": F.lit("zz")}).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{name}")
    s = lambda n, d: stream_of(spark, d, f"{tmp_dir}/{n}").withColumn("et", F.timestamp_millis("ts"))
    out = run_to_table(spark, ST.match_or_timeout_stream(s("v", v), s("p", p), "car_id", "et", 5_000, "1000 days"), tmp_dir, "many")
    want = J.match_or_timeout(v, p, "car_id", "ts", "ts", 5_000)
    cols = ("car_id", "l_id", "r_id", "l_ts", "r_ts", "status")
    assert rows(out.where("car_id <> 'zz'"), *cols) == rows(want, *cols)
    assert want.where("status = 'matched'").count() > 1000


def test_retract_without_before_images(spark, tmp_dir):
    """The retract rows of a history are those that its before-images give; only a delete names its key."""
    from test_snapshot_routing import ENV, history

    from tidewater.sources.changes import to_retract
    changes = spark.createDataFrame(history(200), ENV)
    bare = changes.withColumn("before", F.when(F.col("type") == "delete", F.map_filter("before", lambda k, v: k == "id"))
                              .otherwise(F.create_map().cast("map<string,string>")))
    src = f"{tmp_dir}/bare"
    write_slices(bare, src, "seq", [0, 50, 120, 10_000])
    out = run_to_table(spark, ST.retract_stream(stream_of(spark, bare, src), ["id"]), tmp_dir, "retract")
    flat = lambda d: rows(d.selectExpr("table_name", "seq", "is_add", "row['id']", "row['v']"))
    want = flat(to_retract(changes))
    assert flat(out) == want and len(want) > 250
