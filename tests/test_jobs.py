"""Deployable jobs chained through file topics, compared with the batch plans."""
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import aggregates as A
from tidewater.operators import joins as J
from tidewater.operators import listings as LS
from tidewater.operators import logs as L
from tidewater.operators import patterns as W
from tidewater.operators.measures import visitor_measures
from tidewater.operators.routing import route, split_routes
from tidewater.plans import fixtures as FX
from tidewater.plans import jobs as JB
from tidewater.schemas import PAGE_LOG
from tidewater.sources import sinks as K
from tidewater.sources.changes import drop_deletes, normalize_changes
from tidewater.sources.config import PolledTable

SF_DIR = "/root/testdata/sf0.001"
DAY = 86_400_000
FAR = 4_102_444_800_000


def _key(t):
    return [(v is None, v) for v in t]


def rows(df, *cols):
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=_key)


def finish(qs, limit=300):
    for q in qs if isinstance(qs, list) else [qs]:
        done = q.awaitTermination(limit)
        if not done:
            q.stop()
        assert done and q.exception() is None


def with_batch(schema):
    return T.StructType(list(schema.fields) + [T.StructField("batch_id", T.IntegerType())])


def test_visitor_chain(spark, tmp_dir):
    lines = FX.raw_log_lines(spark, SF_DIR)
    ts = F.get_json_object("value", "$.ts").cast("long")
    lines = lines.withColumn("_ts", F.coalesce(ts, F.lit(0)))
    lo, hi = lines.where("_ts > 0").agg(F.min("_ts"), F.max("_ts")).first()
    bounds = list(range(lo - lo % DAY, hi + DAY, 6 * DAY)) + [hi + DAY]
    raw_dir = f"{tmp_dir}/raw"
    lines.where("_ts = 0").drop("_ts").coalesce(1).write.parquet(raw_dir)       # dirty lines first
    for a, b in zip(bounds[:-1], bounds[1:]):
        lines.where((F.col("_ts") >= a) & (F.col("_ts") < b)).drop("_ts").coalesce(1) \
            .write.mode("append").parquet(raw_dir)
    sentinel = ('{"common":{"mid":"zz","vc":"v","ch":"c","ar":"a","is_new":"0"},'
                '"page":{"page_id":"home","last_page_id":"x","during_time":0},"ts":%d}' % FAR)
    spark.createDataFrame([(10 ** 9, sentinel)], "seq long, value string").write.mode("append").parquet(raw_dir)

    raw = JB.Topic(raw_dir, T.StructType([T.StructField("seq", T.LongType()), T.StructField("value", T.StringType())]),
                   max_files_per_trigger=1)
    page_schema = with_batch(T.StructType([T.StructField("seq", T.LongType()), T.StructField("value", T.StringType())]
                                          + list(PAGE_LOG.fields)))
    topics = {n: JB.Topic(f"{tmp_dir}/{n}") for n in ("start", "page", "display", "dirty")}
    finish(JB.log_split(spark, raw, topics["start"], topics["page"], topics["display"], topics["dirty"],
                        f"{tmp_dir}/ck_log"))
    assert spark.read.parquet(f"{tmp_dir}/dirty").count() == lines.where("_ts = 0").count()

    page = JB.Topic(f"{tmp_dir}/page", page_schema)
    uv_t, uj_t = JB.Topic(f"{tmp_dir}/uv"), JB.Topic(f"{tmp_dir}/uj")
    within = 12 * 3_600_000
    finish(JB.unique_visit(spark, page, uv_t, f"{tmp_dir}/ck_uv"))
    finish(JB.user_jump(spark, page, uj_t, f"{tmp_dir}/ck_uj", within_ms=within, delay="0 seconds"))

    # batch reference over the same good lines (sentinel excluded)
    good, _ = L.split_dirty(FX.raw_log_lines(spark, SF_DIR), PAGE_LOG, keep=("seq",))
    _, pages = L.split_logs(L.fix_is_new(good))
    uv_stream = spark.read.parquet(f"{tmp_dir}/uv").where("common.mid <> 'zz'")
    assert rows(uv_stream, "seq") == rows(W.unique_visits(pages), "seq")
    uj_stream = spark.read.parquet(f"{tmp_dir}/uj").where("common.mid <> 'zz'")
    assert rows(uj_stream, "seq") == rows(W.bounces(pages, within), "seq")

    uv_schema = spark.read.parquet(f"{tmp_dir}/uv").schema
    uj_schema = spark.read.parquet(f"{tmp_dir}/uj").schema
    out = JB.Topic(f"{tmp_dir}/visitor")
    finish(JB.visitor_stats(spark, JB.Topic(f"{tmp_dir}/uv", uv_schema), JB.Topic(f"{tmp_dir}/uj", uj_schema),
                            page, out, f"{tmp_dir}/ck_vs", size="1 day", delay="400 days"))
    got = spark.read.parquet(f"{tmp_dir}/visitor").where("vc <> 'v'")
    want = A.visitor_stats(visitor_measures(W.unique_visits(pages), W.bounces(pages, within), pages), "1 day")
    assert got.count() > 0
    assert rows(got) == rows(want)


def test_db_routing_job(spark, tmp_dir):
    changes = normalize_changes(FX.change_records(spark, SF_DIR))
    src = f"{tmp_dir}/changes"
    changes.where("seq < 500").coalesce(1).write.parquet(src)
    changes.where("seq >= 500").coalesce(1).write.mode("append").parquet(src)
    config = PolledTable(lambda s: FX.table_process(s), ttl=1800)
    fact = JB.Topic(f"{tmp_dir}/fact")
    finish(JB.db_routing(spark, JB.Topic(src, changes.schema, max_files_per_trigger=1), config, fact,
                         f"{tmp_dir}/dim", f"{tmp_dir}/ck_db"))
    f, d = split_routes(route(drop_deletes(changes), FX.table_process(spark)))
    assert rows(spark.read.parquet(f"{tmp_dir}/fact"), "sink_table", "seq") == rows(f, "sink_table", "seq")
    latest = d.groupBy(F.col("after")["id"].alias("id")).agg(F.max("seq").alias("seq"))
    assert rows(K.read_snapshot(spark, f"{tmp_dir}/dim/dim_click"), "id", "seq") == rows(latest)


def test_db_routing_uses_the_configured_key(spark, tmp_dir):
    row = lambda code, name: {"spu_code": code, "name": name, "secret": "x"}
    data = [("db", "spu", "insert", {}, row(f"s{i % 6}", f"n{i}"), 0, i) for i in range(12)]
    schema = ("database string, table_name string, type string, before map<string,string>, after map<string,string>, "
              "ts_ms long, seq long")
    df = spark.createDataFrame(data, schema)
    df.where("seq < 8").coalesce(1).write.parquet(f"{tmp_dir}/ch")
    df.where("seq >= 8").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/ch")
    cfg = lambda s: s.createDataFrame(
        [("spu", "insert", "hbase", "dim_spu", "spu_code,name", "spu_code", None),
         ("other", "insert", "hbase", "dim_other", "id,x", None, None)],
        "source_table string, operate_type string, sink_type string, sink_table string, sink_columns string, "
        "sink_pk string, sink_extend string")
    finish(JB.db_routing(spark, JB.Topic(f"{tmp_dir}/ch", df.schema, max_files_per_trigger=1), PolledTable(cfg, ttl=1800),
                         JB.Topic(f"{tmp_dir}/fact"), f"{tmp_dir}/dim", f"{tmp_dir}/ck"))
    spu = K.read_snapshot(spark, f"{tmp_dir}/dim/dim_spu")
    assert rows(spu, "spu_code", "name") == [(f"s{i}", f"n{i + 6}") for i in range(6)] and "secret" not in spu.columns
    other = K.read_snapshot(spark, f"{tmp_dir}/dim/dim_other")
    assert other.count() == 0 and set(other.columns) == {"id", "x"}


def test_bad_line_does_not_stop_a_job(spark, tmp_dir):
    good = FX.car_lines(spark, SF_DIR).select("value")
    bad = spark.createDataFrame([("00\t01\t0001\t00001\tnot a time\tc1\t99",), ("rubbish",)], "value string")
    good.unionAll(bad).coalesce(1).write.text(f"{tmp_dir}/cars")
    limits = PolledTable(lambda s: FX.speed_limit(s, SF_DIR), ttl=1800)
    finish(JB.overspeed(spark, JB.Topic(f"{tmp_dir}/cars", fmt="text"), limits, JB.Topic(f"{tmp_dir}/over"), f"{tmp_dir}/ck"))
    cars = FX.car_info(spark, SF_DIR).withColumn("ts_ms", F.unix_millis(F.to_timestamp("action_time")))
    assert rows(spark.read.parquet(f"{tmp_dir}/over").drop("batch_id")) == rows(J.overspeed(cars, FX.speed_limit(spark, SF_DIR)))
    finish(JB.dirty_cars(spark, JB.Topic(f"{tmp_dir}/cars", fmt="text"), JB.Topic(f"{tmp_dir}/dirty"), f"{tmp_dir}/ckd"))
    assert rows(spark.read.parquet(f"{tmp_dir}/dirty")) == rows(bad)


def test_flag_repair_orders_text_lines_by_event_time(spark, tmp_dir):
    line = ('{"common":{"mid":"m1","vc":"v","ch":"c","ar":"a","is_new":"%s","os":"x"},'
            '"page":{"page_id":"home","during_time":1},"displays":[{"item":"1","item_type":"t","pos_id":7}],"ts":%d}')
    lines = [(line % ("1", 1_700_000_000_000 + 1000 * i),) for i in range(6)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{tmp_dir}/log")
    t = {n: JB.Topic(f"{tmp_dir}/{n}") for n in ("start", "page", "display", "dirty")}
    finish(JB.log_split(spark, JB.Topic(f"{tmp_dir}/log", fmt="text"), t["start"], t["page"], t["display"], t["dirty"],
                        f"{tmp_dir}/ck"))
    got = spark.read.parquet(f"{tmp_dir}/page").orderBy("ts").collect()
    assert [r.common.is_new for r in got] == ["1", "0", "0", "0", "0", "0"]
    assert all('"os":"x"' in r.value and ('"is_new":"%s"' % r.common.is_new) in r.value for r in got)
    assert [r.display for r in spark.read.parquet(f"{tmp_dir}/display").collect()] == ['{"item":"1","item_type":"t","pos_id":7}'] * 6


def test_overspeed_and_listings_jobs(spark, tmp_dir):
    lines = FX.car_lines(spark, SF_DIR).select("value")
    lines.coalesce(1).write.text(f"{tmp_dir}/cars")
    limits = PolledTable(lambda s: FX.speed_limit(s, SF_DIR), ttl=1800)
    finish(JB.overspeed(spark, JB.Topic(f"{tmp_dir}/cars", fmt="text"), limits, JB.Topic(f"{tmp_dir}/over"),
                        f"{tmp_dir}/ck_over"))
    cars = FX.car_info(spark, SF_DIR).withColumn("ts_ms", F.unix_millis(F.to_timestamp("action_time")))
    want = J.overspeed(cars, FX.speed_limit(spark, SF_DIR))
    assert rows(spark.read.parquet(f"{tmp_dir}/over").drop("batch_id")) == rows(want)

    hotels = FX.hotel_raw(spark, SF_DIR)
    hotels.where("id < 100").coalesce(1).write.parquet(f"{tmp_dir}/hotels")
    hotels.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/hotels")
    finish(JB.listings(spark, "hotel", JB.Topic(f"{tmp_dir}/hotels", hotels.schema, max_files_per_trigger=1),
                       FX.gazetteer(spark, SF_DIR), f"{tmp_dir}/listings", f"{tmp_dir}/ck_list"))
    got = spark.read.parquet(f"{tmp_dir}/listings/rows")
    want = LS.locate(LS.dedup_listings(LS.clean_hotel(hotels)), FX.gazetteer(spark, SF_DIR), "analysis_address")
    assert rows(got, "id", "lon", "lat") == rows(want, "id", "lon", "lat")


def test_keyword_job(spark, tmp_dir):
    lines = FX.search_lines(spark, SF_DIR)
    lines.coalesce(1).write.text(f"{tmp_dir}/lines")
    sentinel = '{"common":{"mid":"zz"},"page":{"page_id":"x","last_page_id":"search","item":"zz"},"ts":%d}' % FAR
    spark.createDataFrame([(sentinel,)], "value string").coalesce(1).write.mode("append").text(f"{tmp_dir}/lines")
    finish(JB.keyword_stats(spark, JB.Topic(f"{tmp_dir}/lines", fmt="text", max_files_per_trigger=1),
                            JB.Topic(f"{tmp_dir}/kw"), f"{tmp_dir}/ck_kw", view="pv_test"))
    from tidewater.plans.catalog import QUERIES, load_all
    load_all()
    want = QUERIES["e2e_keyword"](spark, SF_DIR)
    assert rows(spark.read.parquet(f"{tmp_dir}/kw")) == rows(want, "source", "stt", "edt", "keyword", "ct")


def _dims(spark):
    return {"user": FX.dim_user_info(spark, SF_DIR), "province": FX.dim_base_province(spark, SF_DIR),
            "sku": FX.dim_sku_info(spark, SF_DIR), "spu": FX.dim_spu_info(spark, SF_DIR),
            "trademark": FX.dim_base_trademark(spark, SF_DIR), "category": FX.dim_base_category3(spark, SF_DIR)}


def test_order_payment_province_chain(spark, tmp_dir):
    from tidewater.operators import orders as O
    orders, details, pays = (FX.order_info(spark, SF_DIR), FX.order_detail(spark, SF_DIR),
                             FX.payment_info(spark, SF_DIR))
    for df, n in ((orders, "orders"), (details, "details"), (pays, "pays")):
        df.coalesce(1).write.parquet(f"{tmp_dir}/{n}")
    lo, hi = -20 * DAY, 20 * DAY
    finish(JB.order_wide(spark, JB.Topic(f"{tmp_dir}/orders", orders.schema),
                         JB.Topic(f"{tmp_dir}/details", details.schema), _dims(spark),
                         JB.Topic(f"{tmp_dir}/wide"), f"{tmp_dir}/ck_wide", lo, hi))
    wide = spark.read.parquet(f"{tmp_dir}/wide")
    want = O.enrich_order(O.order_wide(orders, details, lo, hi), *_dims(spark).values())
    assert rows(wide, "detail_id", "order_id", "province_name", "tm_name") == \
        rows(want, "detail_id", "order_id", "province_name", "tm_name")
    finish(JB.payment_wide(spark, JB.Topic(f"{tmp_dir}/pays", pays.schema), JB.Topic(f"{tmp_dir}/wide", wide.schema),
                           JB.Topic(f"{tmp_dir}/paywide"), f"{tmp_dir}/ck_pay", -15 * DAY, 5 * DAY))
    got = spark.read.parquet(f"{tmp_dir}/paywide")
    want_p = O.payment_wide(pays, O.order_wide(orders, details, lo, hi), -15 * DAY, 5 * DAY)
    assert rows(got, "payment_id", "detail_id", "user_id") == rows(want_p, "payment_id", "detail_id", "user_id")
    # province stats over the wide rows plus two sentinel batches far in the future
    w2 = f"{tmp_dir}/wide2"
    wide.coalesce(1).write.parquet(w2)
    sentinel = wide.limit(1).withColumn("create_ts", F.lit(FAR)).withColumn("province_id", F.lit(-1).cast("long"))
    for _ in range(2):
        sentinel.coalesce(1).write.mode("append").parquet(w2)
    finish(JB.province_stats(spark, JB.Topic(w2, wide.schema, max_files_per_trigger=1), JB.Topic(f"{tmp_dir}/prov"),
                             f"{tmp_dir}/ck_prov", size="1 day", delay="3650 days"))
    got = spark.read.parquet(f"{tmp_dir}/prov").where("province_id <> -1")
    assert rows(got) == rows(A.province_stats(wide, "1 day"))


def test_traffic_jobs(spark, tmp_dir):
    cars_df = FX.car_info(spark, SF_DIR)
    FX.car_lines(spark, SF_DIR).select("value").coalesce(1).write.text(f"{tmp_dir}/cars")
    far = "00\t00\t0000\t00000\t2100-01-01 00:00:00\tzz\t1.0"
    for _ in range(2):   # the second sentinel batch fires the timers the first one's watermark expired
        spark.createDataFrame([(far,)], "value string").coalesce(1).write.mode("append").text(f"{tmp_dir}/cars")
    src = JB.Topic(f"{tmp_dir}/cars", fmt="text", max_files_per_trigger=1)
    limits = FX.speed_limit(spark, SF_DIR)
    cars = cars_df.withColumn("ts", F.to_timestamp("action_time")).withColumn("ts_ms", F.unix_millis("ts"))

    finish(JB.danger_drive(spark, src, limits, JB.Topic(f"{tmp_dir}/danger"), f"{tmp_dir}/ck_d",
                           within_ms=72 * 3_600_000, delay="0 seconds"))
    want = W.danger_drive(J.with_speed_limit(cars, limits), 72 * 3_600_000)
    assert rows(spark.read.parquet(f"{tmp_dir}/danger"), "car_id", "time_1") == rows(want, "car_id", "time_1")

    finish(JB.repeat_plates(spark, src, JB.Topic(f"{tmp_dir}/plates"), f"{tmp_dir}/ck_p", within_ms=3_600_000))
    plates = spark.read.parquet(f"{tmp_dir}/plates").where("car_id <> 'zz'")   # sentinels repeat
    assert plates.count() == W.repeat_plates(cars, 3_600_000).count()

    finish(JB.avg_speed(spark, src, JB.Topic(f"{tmp_dir}/avg"), f"{tmp_dir}/ck_a", "1 day", "6 hours"))
    assert rows(spark.read.parquet(f"{tmp_dir}/avg")) == rows(A.avg_speed(cars, "1 day", "6 hours"))

    finish(JB.car_count(spark, src, JB.Topic(f"{tmp_dir}/cnt"), f"{tmp_dir}/ck_c", "1 hour"))
    assert rows(spark.read.parquet(f"{tmp_dir}/cnt")) == rows(A.car_count(cars, "1 hour"))

    finish(JB.top_monitors(spark, src, JB.Topic(f"{tmp_dir}/top"), f"{tmp_dir}/ck_t", 5, "1 day", "6 hours"))
    want_t = W.top_monitors(A.speed_bands(cars, "1 day", "6 hours"), 5, window_cols=("stt", "edt"))
    assert rows(spark.read.parquet(f"{tmp_dir}/top").drop("batch_id")) == rows(want_t)


def test_police_jobs(spark, tmp_dir):
    v, p = FX.violation(spark, SF_DIR), FX.police(spark, SF_DIR)
    v.select(F.concat_ws(",", "car_id", "violation", "create_time", "description")).coalesce(1) \
        .write.text(f"{tmp_dir}/v")
    p.select(F.concat_ws(",", "police_id", "car_id", "action_time", "status")).coalesce(1).write.text(f"{tmp_dir}/p")
    for n, line in (("v", "zz,x,2100-01-01 00:00:00,x"), ("p", "pz,zz,2100-01-01 00:00:00,x")):
        for _ in range(2):
            spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{tmp_dir}/{n}")
    tv = JB.Topic(f"{tmp_dir}/v", fmt="text", max_files_per_trigger=1)
    tp = JB.Topic(f"{tmp_dir}/p", fmt="text", max_files_per_trigger=1)
    six = 6 * 3_600_000
    finish(JB.police_dispatch(spark, tv, tp, JB.Topic(f"{tmp_dir}/disp"), f"{tmp_dir}/ck_disp", six, "0 seconds"))
    vt = v.withColumn("ts", F.unix_millis(F.to_timestamp("create_time")))
    pt = p.withColumn("ts", F.unix_millis(F.to_timestamp("action_time")))
    want = J.interval_join(vt.select("car_id", "create_time", F.col("ts").alias("vt")),
                           pt.select("car_id", "action_time", F.col("ts").alias("pt")),
                           ["car_id"], "vt", "pt", -six, six)
    got = spark.read.parquet(f"{tmp_dir}/disp").where("car_id <> 'zz'")
    assert rows(got, "car_id", "create_time", "action_time") == rows(want, "car_id", "create_time", "action_time")
    finish(JB.police_connect(spark, tv, tp, JB.Topic(f"{tmp_dir}/conn"), f"{tmp_dir}/ck_conn", six, "0 seconds"))
    statuses = {r[0] for r in spark.read.parquet(f"{tmp_dir}/conn").select("status").distinct().collect()}
    assert "matched" in statuses and statuses <= {"matched", "left_only", "right_only"}


def test_product_stats_job(spark, tmp_dir):
    from tidewater.operators import orders as O
    from tidewater.operators.measures import product_measures
    d = _dims(spark)
    wide = O.enrich_order(O.order_wide(FX.order_info(spark, SF_DIR), FX.order_detail(spark, SF_DIR),
                                       -20 * DAY, 20 * DAY), *d.values())
    pays = O.payment_wide(FX.payment_info(spark, SF_DIR), wide, -15 * DAY, 5 * DAY)
    inputs = {"page": FX.page_log(spark, SF_DIR), "favor": FX.favor_info(spark, SF_DIR),
              "cart": FX.cart_info(spark, SF_DIR), "wide": wide, "pays": pays,
              "refund": FX.refund_info(spark, SF_DIR), "comment": FX.comment_info(spark, SF_DIR)}
    topics = {}
    for n, df in inputs.items():
        df.coalesce(1).write.parquet(f"{tmp_dir}/{n}")
        topics[n] = JB.Topic(f"{tmp_dir}/{n}", df.schema, max_files_per_trigger=1)
    far = inputs["favor"].limit(1).withColumn("create_time", F.lit(str(FAR))).withColumn("sku_id", F.lit(-1).cast("long"))
    for _ in range(2):   # the second sentinel batch emits the windows the first one closed
        far.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/favor")
    out = JB.Topic(f"{tmp_dir}/pstats")
    finish(JB.product_stats(spark, topics["page"], topics["favor"], topics["cart"], topics["wide"],
                            topics["pays"], topics["refund"], topics["comment"], d, out,
                            f"{tmp_dir}/ck_ps", size="1 day", delay="3650 days"))
    got = spark.read.parquet(f"{tmp_dir}/pstats").drop("batch_id").where("sku_id <> -1")
    want = O.enrich_product(A.product_stats(product_measures(*inputs.values()), "1 day"),
                            d["sku"], d["spu"], d["category"], d["trademark"])
    assert got.count() > 0
    assert rows(got, "stt", "sku_id", "order_ct", "paid_order_ct", "refund_order_ct", "click_ct", "tm_name") == \
        rows(want, "stt", "sku_id", "order_ct", "paid_order_ct", "refund_order_ct", "click_ct", "tm_name")


def test_ods_changes_job(spark, tmp_dir):
    raw = FX.change_records(spark, SF_DIR)
    raw.coalesce(1).write.parquet(f"{tmp_dir}/raw_changes")
    finish(JB.ods_changes(spark, JB.Topic(f"{tmp_dir}/raw_changes", raw.schema), JB.Topic(f"{tmp_dir}/ods"),
                          f"{tmp_dir}/ck_ods"))
    got = spark.read.parquet(f"{tmp_dir}/ods")
    want = normalize_changes(raw)
    assert rows(got, "seq", "database", "table_name", "type") == rows(want, "seq", "database", "table_name", "type")
