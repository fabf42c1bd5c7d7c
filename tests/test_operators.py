"""Hand-written rows: boundaries and the decisions of SURVEY §2.12."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions import keywords as KW
from tidewater.functions import text as T
from tidewater.functions import timefmt as TF
from tidewater.operators import aggregates as A
from tidewater.operators import joins as J
from tidewater.operators import logs as L
from tidewater.operators import patterns as W
from tidewater.operators import sequence as S
from tidewater.operators.routing import keep_columns, route, split_routes
from tidewater.sources import sinks as K
from tidewater.sources.changes import apply_changelog, normalize_changes, to_retract
from tidewater.sources.lines import parse_car_lines, parse_csv_lines
from tidewater.schemas import VIOLATION


def _key(t):
    return [(v is None, v) for v in t]


def rows(df, *cols):
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=_key)


# ------------------------------------------------------------------ joins
def test_interval_join_ends(spark):
    left = spark.createDataFrame([(1, 1000)], "k int, lt long")
    right = spark.createDataFrame([(1, 990), (1, 995), (1, 1000), (1, 1005), (1, 1010), (2, 1000)], "k int, rt long")
    both = J.interval_join(left, right, ["k"], "lt", "rt", -5, 5)
    assert rows(both, "rt") == [(995,), (1000,), (1005,)]
    excl = J.interval_join(left, right, ["k"], "lt", "rt", -5, 5, lo_inclusive=False, hi_inclusive=False)
    assert rows(excl, "rt") == [(1000,)]
    wide = J.interval_join(left, right, ["k"], "lt", "rt", -10, 10, bucket=3)  # many buckets
    assert rows(wide, "rt") == [(990,), (995,), (1000,), (1005,), (1010,)]


def test_interval_join_random_matches_brute_force(spark):
    rnd = random.Random(7)
    l = [(rnd.randint(0, 3), rnd.randint(0, 10_000)) for _ in range(300)]
    r = [(rnd.randint(0, 3), rnd.randint(0, 10_000)) for _ in range(300)]
    ldf = spark.createDataFrame(l, "k int, lt long")
    rdf = spark.createDataFrame(r, "k int, rt long")
    got = rows(J.interval_join(ldf, rdf, ["k"], "lt", "rt", -150, 70), "k", "lt", "rt")
    want = sorted((a, x, y) for a, x in l for b, y in r if a == b and x - 150 <= y <= x + 70)
    assert got == want


def test_lookup_missing_dimension_keeps_row(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20)], "id int, user_id int")
    dim = spark.createDataFrame([(10, "F")], "id int, gender string")
    assert rows(J.lookup(facts, dim, "user_id", ["gender"])) == [(1, 10, "F"), (2, 20, None)]


def test_broadcast_only_behind_size_check(spark):
    small = spark.range(10)   # known size (a local RDD would count as unbounded)
    assert J.estimated_bytes(small) is not None
    plan = J.broadcast_if_small(small, max_bytes=1 << 20)._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan.lower()
    plan = J.broadcast_if_small(small, max_bytes=0)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()


def test_overspeed_boundary_and_default(spark):
    cars = spark.createDataFrame([
        ("01", "01", "0001", "c1", 72.0, 1), ("01", "01", "0001", "c2", 72.01, 2),   # default 60
        ("02", "01", "0001", "c3", 60.0, 3), ("02", "01", "0001", "c4", 60.5, 4)],  # limit 50
        "area_id string, road_id string, monitor_id string, car_id string, speed double, ts_ms long")
    limits = spark.createDataFrame([("02", "01", "0001", 50.0)],
                                   "area_id string, road_id string, monitor_id string, speed_limit double")
    got = rows(J.overspeed(cars, limits), "car_id", "limit_speed")
    assert got == [("c2", 60.0), ("c4", 50.0)]


def test_match_or_timeout_batch(spark):
    v = spark.createDataFrame([("a", 1, 100), ("a", 2, 500), ("b", 3, 100)], "car string, seq long, ts long")
    p = spark.createDataFrame([("a", 10, 103), ("b", 11, 200), ("c", 12, 1)], "car string, seq long, ts long")
    out = rows(J.match_or_timeout(v, p, "car", "ts", "ts", 5), "car", "l_id", "r_id", "status")
    assert out == [("a", 1, 10, "matched"), ("a", 2, None, "left_only"), ("b", 3, None, "left_only"),
                   ("b", None, 11, "right_only"), ("c", None, 12, "right_only")]


def test_geocode_fallback(spark):
    df = spark.createDataFrame([("x", "x2"), ("y", "y2"), ("z", "z2"), ("n", "n2")], "a string, b string")
    gaz = spark.createDataFrame([("x", 1.0, 2.0), ("y2", 3.0, 4.0), ("n", 0.0, 5.0), ("n2", 6.0, 7.0)],
                                "address string, lon double, lat double")
    out = J.geocode(df, gaz, "a", "b", fields=("lon", "lat"))
    assert rows(out, "a", "lon", "geo_source") == [("n", 6.0, "fallback"), ("x", 1.0, "address"),
                                                   ("y", 3.0, "fallback"), ("z", None, None)]
    assert rows(J.has_coordinates(out), "a") == [("n",), ("x",), ("y",)]


# ------------------------------------------------------------------ logs
def test_split_dirty_and_entry(spark):
    lines = spark.createDataFrame([('{"common":{"mid":"m1"},"page":{"last_page_id":""},"ts":5}',),
                                   ("not json",), ('{"ts": 7}',)], "value string")
    good, dirty = L.split_dirty(lines)
    assert rows(dirty) == [("not json",)]
    assert rows(good, "ts") == [(5,), (7,)]
    e = spark.createDataFrame([(None,), ("",), ("home",)], "p string")
    assert rows(e.where(L.is_entry("p"))) == [("",), (None,)]


def test_fix_is_new_keeps_first_flag_by_arrival(spark):
    df = spark.createDataFrame([("m", "0", 1), ("m", "1", 3), ("m", "1", 2), ("m", "0", 4), ("n", "1", 9)],
                               "mid string, is_new string, seq long")
    out = rows(L.fix_is_new(df, key="mid", flag="is_new"), "seq", "is_new")
    assert out == [(1, "0"), (2, "1"), (3, "0"), (4, "0"), (9, "1")]


# ------------------------------------------------------------------ history
def _naive_next(data, horizon):
    out = {}
    by_key = {}
    for k, ts, seq in data:
        by_key.setdefault(k, []).append((ts, seq))
    for k, lst in by_key.items():
        lst.sort()
        for i, (ts, seq) in enumerate(lst):
            nxt = lst[i + 1] if i + 1 < len(lst) else None
            out[seq] = nxt[0] if nxt and nxt[0] - ts < horizon else None
    return out


def test_with_following_exact_across_chunks(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 2), rnd.randint(0, 5_000), i) for i in range(400)]
    df = spark.createDataFrame(data, "k int, ts long, seq long")
    got = S.with_following(df, ["k"], "ts", "seq", horizon=40, fields=["ts"], chunk=40)
    got = {r["seq"]: (r["next1_ts"] if r["next1_ts"] is not None and r["next1_ts"] - r["ts"] < 40 else None)
           for r in got.collect()}
    assert got == _naive_next(data, 40)


def test_with_prior_max_across_chunks(spark):
    rnd = random.Random(5)
    data = [(rnd.randint(0, 3), rnd.randint(0, 1000), i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, v long, seq long")
    got = {r["seq"]: r["prior_max"] for r in S.with_prior_max(df, ["k"], "seq", "v", chunk_rows=7).collect()}
    want, best = {}, {}
    for k, v, seq in data:
        want[seq] = best.get(k)
        best[k] = v if best.get(k) is None else max(best[k], v)
    assert got == want


def test_bounce_within_is_strict(spark):
    # entry at 0 followed by an entry exactly `within` later: timeout, not match
    df = spark.createDataFrame([("m", 0, 1, None), ("m", 10, 2, None), ("m", 19, 3, None), ("m", 25, 4, "x")],
                               "mid string, ts long, seq long, last string")
    m = W.bounces(df, 10, key="mid", last_page="last", kind="matched")
    t = W.bounces(df, 10, key="mid", last_page="last", kind="timeout")
    assert rows(m, "seq") == [(2,)]          # 10 -> 19 entries, 9 apart
    assert rows(t, "seq") == [(1,)]          # 0 -> 10: exactly within -> timeout
    # 19 -> 25 is a non-entry within 10: seq 3 is no bounce


def test_unique_visits_first_per_day(spark):
    day = 86_400_000
    df = spark.createDataFrame([("m", 5, 2, None), ("m", 5, 1, ""), ("m", day + 1, 3, None), ("m", 7, 4, "x")],
                               "mid string, ts long, seq long, last string")
    assert rows(W.unique_visits(df, key="mid", last_page="last"), "seq") == [(1,), (3,)]


def test_danger_drive_and_repeat_plates(spark):
    cars = spark.createDataFrame([
        ("c", 0, 1, 100.0), ("c", 4, 2, 10.0), ("c", 5, 3, 100.0), ("c", 9, 4, 100.0), ("c", 10, 5, 100.0)],
        "car_id string, ts_ms long, seq long, speed double").withColumn("limit_speed", F.lit(60.0)) \
        .withColumn("action_time", F.col("ts_ms").cast("string"))
    d = W.danger_drive(cars, within_ms=10, chunk_ms=10)
    assert rows(d, "time_1", "time_2", "time_3") == [("0", "5", "9"), ("5", "9", "10")]
    p = W.repeat_plates(cars.withColumn("ts_ms", F.when(F.col("seq") == 3, 100).otherwise(F.col("ts_ms"))),
                        within_ms=4, chunk_rows=2)
    # prior max by arrival: 0,4,100,100,100 -> |4-0|<=4 hit; 9 vs 100 no; 10 vs 100 no
    assert rows(p, "seq") == [(2,)]


def test_top_monitors_partial_limit(spark):
    bands = spark.createDataFrame(
        [("w", "m%d" % i, i % 3, 0, 0, i) for i in range(10)],
        "stt string, monitor_id string, high_speed_count long, middle_speed_count long, "
        "normal_speed_count long, low_speed_count long").withColumn("edt", F.lit("e"))
    top = W.top_monitors(bands, 3, window_cols=("stt", "edt"))
    assert rows(top, "monitor_id") == [("m0",), ("m3",), ("m6",)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_speed_bands_boundaries(spark):
    cars = spark.createDataFrame([(s,) for s in (59.99, 60.0, 89.99, 90.0, 119.99, 120.0)], "speed double") \
        .select(F.lit("a").alias("area_id"), F.lit("r").alias("road_id"), F.lit("m").alias("monitor_id"),
                F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"), "speed")
    r = A.speed_bands(cars, "1 minute", "1 minute").first()
    assert (r.high_speed_count, r.middle_speed_count, r.normal_speed_count, r.low_speed_count) == (1, 2, 2, 1)


def test_product_stats_two_level_counts(spark):
    rnd = random.Random(11)
    data = []
    for _ in range(500):
        kind = rnd.randint(0, 3)
        ids = [None, None, None]
        if kind:
            ids[kind - 1] = rnd.randint(0, 30)
        data.append((rnd.randint(0, 4), rnd.randint(0, 30_000), 1, *ids))
    df = spark.createDataFrame(data, "sku_id long, ts long, click_ct long, order_id long, "
                                     "paid_order_id long, refund_order_id long")
    for c in ("display_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct"):
        df = df.withColumn(c, F.lit(0).cast("long"))
    for c in ("order_amount", "payment_amount", "refund_amount"):
        df = df.withColumn(c, F.lit(1).cast("decimal(18,2)"))
    got = A.product_stats(df, "10 seconds")
    want = A.product_stats(df, "10 seconds")   # collect_set form
    assert rows(got) == rows(want)


# ---------------------------------------------------------- change capture
def test_envelope_retract_current_table(spark):
    raw = spark.createDataFrame([
        ("s.db.t", "CREATE", None, {"id": "1", "v": "a"}, 1),
        ("s.db.t", "UPDATE", {"id": "1", "v": "a"}, {"id": "1", "v": "b"}, 2),
        ("s.db.t", "CREATE", None, {"id": "2", "v": "c"}, 3),
        ("s.db.t", "DELETE", {"id": "2", "v": "c"}, None, 4)],
        "topic string, op string, before map<string,string>, after map<string,string>, seq long")
    n = normalize_changes(raw, keep=("seq",))
    assert rows(n, "database", "table_name", "type") == [("db", "t", "delete"), ("db", "t", "insert"),
                                                         ("db", "t", "insert"), ("db", "t", "update")]
    assert n.where("seq = 1").first().before == {}
    r = to_retract(n)
    assert rows(r.select("seq", "is_add", F.col("row")["v"])) == [
        (1, True, "a"), (2, False, "a"), (2, True, "b"), (3, True, "c"), (4, False, "c")]
    cur = apply_changelog(n, ["id"])
    assert rows(cur.select(F.col("after")["v"])) == [("b",)]


def test_routing_whitelist_and_sink_split(spark):
    ch = spark.createDataFrame([("t", "insert", {"id": "1", "a": "x", "b": "y"}, 1),
                                ("t", "update", {"id": "1", "a": "z"}, 2),
                                ("u", "insert", {"id": "2"}, 3)],
                               "table_name string, type string, after map<string,string>, seq long")
    cfg = spark.createDataFrame([("t", "insert", "kafka", "dwd_t", "id,a", "id", None),
                                 ("t", "update", "hbase", "dim_t", "id", "id", None)],
                                "source_table string, operate_type string, sink_type string, sink_table string, "
                                "sink_columns string, sink_pk string, sink_extend string")
    fact, dim = split_routes(route(ch, cfg))
    assert rows(fact.select("seq", "sink_table", "after")) == [(1, "dwd_t", {"id": "1", "a": "x"})]
    assert rows(dim.select("seq", "after")) == [(2, {"id": "1"})]
    m = spark.createDataFrame([({"x": "1", "y": "2"}, "y")], "m map<string,string>, c string")
    assert m.select(keep_columns(F.col("m"), F.col("c"))).first()[0] == {"y": "2"}


# ------------------------------------------------------------------ sinks
def test_upsert_and_write_once_are_idempotent(spark, tmp_dir):
    a = spark.createDataFrame([("k1", "v1", 1), ("k2", "v2", 2)], "k string, v string, seq long")
    b = spark.createDataFrame([("k1", "v3", 3), ("k2", "old", 0)], "k string, v string, seq long")
    K.upsert_dim(a, tmp_dir + "/dim", ["k"], "seq")
    K.upsert_dim(b, tmp_dir + "/dim", ["k"], "seq")
    K.upsert_dim(b, tmp_dir + "/dim", ["k"], "seq")          # replayed batch: no change
    assert rows(K.read_snapshot(spark, tmp_dir + "/dim"), "k", "v") == [("k1", "v3"), ("k2", "v2")]
    c = spark.createDataFrame([("k3", "v4", 5)], "k string, v string, seq long")
    assert K.upsert_dim(c, tmp_dir + "/dim", ["k"], "seq") == 1   # one row written
    assert K.read_snapshot(spark, tmp_dir + "/dim").count() == 3
    K.write_once(a, tmp_dir + "/once", 1)
    K.write_once(a, tmp_dir + "/once", 1)
    K.write_once(b, tmp_dir + "/once", 2)
    assert spark.read.parquet(tmp_dir + "/once").count() == 4


def test_ensure_table_defaults(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tw_ens LOCATION '{tmp_dir}/db'")
    name = K.ensure_table(spark, "t1", "a,b", tmp_dir + "/t1", database="tw_ens")
    assert [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields] == \
        [("id", "string"), ("a", "string"), ("b", "string")]
    K.ensure_table(spark, "t1", "zzz", tmp_dir + "/t1", database="tw_ens")   # exists: unchanged
    assert len(spark.table(name).columns) == 3


# ------------------------------------------------------------------ parsers
def test_parsers(spark):
    lines = spark.createDataFrame([(" 01 \t02\t0003\t00004\t2024-01-01 00:00:00\tc1\t 12.5 ",), ("a\tb",)],
                                  "value string")
    p = parse_car_lines(lines).collect()
    assert tuple(p[0]) == ("01", "02", "0003", "00004", "2024-01-01 00:00:00", "c1", 12.5)
    assert p[1].speed is None
    v = parse_csv_lines(spark.createDataFrame([("c1,v,2024-01-01 00:00:00",)], "value string"), VIOLATION)
    assert v.first().description is None


# ------------------------------------------------------------------ scalars
def test_text_functions(spark):
    df = spark.createDataFrame([("杭州", "近永盛路地铁站 · 萧山国际机场", "共12条评论", "4.6分", "¥199起",
                                 "西湖5A景区", "36条点评", "4.5/5分", "市西湖路(东门)",
                                 "正常情况下,单程50分,间隔10-15分")],
                               "city string, addr string, cc string, sc string, pr string, name string, "
                               "rc string, rs string, sa string, run string")
    r = df.select(T.hotel_address("city", "addr"), T.hotel_comment_count("cc"), T.hotel_score("sc"),
                  T.price("pr"), T.rank_class("name"), T.name_without_rank("name"), T.review_count("rc"),
                  T.review_score("rs"), T.sight_address("city", "sa"), T.between("run"),
                  T.strip_punctuation(F.lit("a，b（c）! d"))).first()
    assert tuple(r) == ("杭州永盛路地铁站", 12, 4.6, 199.0, "5", "西湖景区", 36, 4.5, "杭州市市西湖路", "50", "abcd")
    z = spark.createDataFrame([(None, "", "暂无")], "a string, b string, c string").select(
        T.hotel_score("a"), T.price("b"), T.review_count("c"), T.hotel_comment_count("c")).first()
    assert tuple(z) == (0.0, 0.0, 0, 0)


def test_time_functions(spark):
    df = spark.createDataFrame([(0,)], "ms long")
    r = df.select(TF.millis_to_text("ms"), TF.text_to_millis(F.lit("1970-01-01 08:00:00")),
                  TF.numeric_text_to_millis(F.lit("123")), TF.numeric_text_to_millis(F.lit("x"))).first()
    assert tuple(r) == ("1970-01-01 08:00:00", 0, 123, None)


def test_split_words(spark):
    df = spark.createDataFrame([(1, "Hello World 42x"), (2, None), (3, "  "), (4, "小米手机")], "id int, t string")
    assert rows(KW.split_words(df, "t", keep=("id",))) == [
        (1, "42x"), (1, "hello"), (1, "world"), (4, "小"), (4, "手"), (4, "机"), (4, "米")]
    vocab = spark.createDataFrame([("小米",), ("手机",)], "word string")
    assert rows(KW.split_words(df.where("id > 1"), "t", keep=("id",), dictionary=vocab)) == [(4, "小米"), (4, "手机")]


def test_split_words_with_a_dictionary(spark, monkeypatch):
    """Overlapping words, uncovered ideographs, words of one place or with letters; both forms and a plain one."""
    rng = random.Random(3)
    chars = "天地人山水火"
    vocab = {"".join(rng.choice(chars) for _ in range(rng.randint(2, 4))) for _ in range(60)} | {"天", "a天", None}
    texts = ["".join(rng.choice(chars + "aÉ1 ,") for _ in range(rng.randint(0, 40))) for _ in range(80)] + [None, "", "天" * 9]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    d = spark.createDataFrame([(w,) for w in vocab] * 2, "word string")
    want = []
    for i, t in enumerate(texts):
        hits = [(k, k + n) for k in range(len(t or "")) for n in (2, 3, 4) if (t[k:k + n] in vocab and len(t[k:k + n]) == n
                                                                          and all(c in chars for c in t[k:k + n]))]
        want += [(i, t[a:b]) for a, b in hits]
        want += [(i, c) for k, c in enumerate(t or "") if c in chars and not any(a <= k < b for a, b in hits)]
        want += [(i, w.lower()) for w in "".join(c if c in "aÉ1" else " " for c in t or "").split()]
    want.sort()
    assert rows(KW.split_words(df, "t", keep=("id",), dictionary=d)) == want
    monkeypatch.setattr(KW, "ahocorasick", None)
    assert rows(KW.split_words(df, "t", keep=("id",), dictionary=d)) == want
    assert rows(KW.split_words(df, "t", keep=("id",), dictionary=d.limit(0))) == rows(KW.split_words(df, "t", keep=("id",)))
    monkeypatch.undo()
    assert rows(KW.split_words(df, "t", keep=("id",), dictionary=d.limit(0))) == rows(KW.split_words(df, "t", keep=("id",)))


def test_sliding_windows_by_pane(spark):
    """The same windows as one aggregate; rows are not repeated before the first aggregate."""
    rng = random.Random(4)
    cars = spark.createDataFrame([("a", "r", f"m{rng.randint(0, 2)}", rng.randint(0, 40_000) / 100, rng.randint(-10 ** 6, 10 ** 6))
                                  for _ in range(400)], "area_id string, road_id string, monitor_id string, speed double, s long")
    cars = cars.withColumn("ts", F.timestamp_seconds("s"))
    for size, slide in (("5 minutes", "1 minute"), ("1 hour", "25 minutes"), ("1 day", "1 day"), ("90 seconds", "1 minute")):
        whole = (cars.groupBy(F.window("ts", size, slide).alias("window"), A.monitor_key().alias("monitor_id"))
                 .agg(F.count("*").alias("n"), F.sum(F.col("speed").cast("decimal(18,2)")).alias("s")))
        want = whole.select(*A.window_millis(), "monitor_id", F.round(F.col("s") / F.col("n"), 2).cast("double"), "n")
        assert rows(A.avg_speed(cars, size, slide)) == rows(want)
        bands = A.speed_bands(cars, size, slide)
        assert bands.agg(F.sum(sum(F.col(c) for c in bands.columns[3:]))).first()[0] == whole.agg(F.sum("n")).first()[0]
    plan = A.avg_speed(cars, "5 minutes", "1 minute")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")


def test_age(spark):
    r = spark.createDataFrame([("2000-01-01", "2020-12-31")], "b string, d string") \
        .select(J.age_years(F.col("b"), F.to_date("d"))).first()[0]
    assert r == 7670 // 365   # 365-day years (D2): 21


def test_match_or_timeout_random_matches_brute_force(spark):
    rnd = random.Random(13)
    l = [(rnd.choice("abc"), i, rnd.randint(0, 2_000)) for i in range(150)]
    r = [(rnd.choice("abcd"), 1000 + i, rnd.randint(0, 2_000)) for i in range(150)]
    ldf = spark.createDataFrame(l, "car string, seq long, ts long")
    rdf = spark.createDataFrame(r, "car string, seq long, ts long")
    got = rows(J.match_or_timeout(ldf, rdf, "car", "ts", "ts", 37), "car", "l_id", "r_id", "status")
    pairs = [(a, i, j, "matched") for a, i, x in l for b, j, y in r if a == b and abs(x - y) <= 37]
    lm = {p[1] for p in pairs}
    rm = {p[2] for p in pairs}
    want = pairs + [(a, i, None, "left_only") for a, i, _ in l if i not in lm] \
        + [(b, None, j, "right_only") for b, j, _ in r if j not in rm]
    assert got == sorted(want, key=_key)


def _max_partition_share(df, col):
    """Largest share of rows in one task of the stage that computes ``col``
    (the count uses ``col`` so the operator cannot be pruned away)."""
    counts = [r[1] for r in df.withColumn("_p", F.spark_partition_id())
              .groupBy("_p").agg(F.count(F.col(col))).collect()]
    return max(counts) / sum(counts)


def test_hot_key_is_spread_over_tasks(spark):
    """A key holding 60 % of the rows must not land in one task."""
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rnd = random.Random(1)
        data = [("hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 50)}", rnd.randint(0, 10_000_000), i)
                for i in range(20_000)]
        df = spark.createDataFrame(data, "k string, ts long, seq long")
        naive = df.withColumn("n", F.lead("ts").over(Window.partitionBy("k").orderBy("ts", "seq")))
        assert _max_partition_share(naive, "n") > 0.55            # the plain window: one task
        chunked = S.with_following(df, ["k"], "ts", "seq", horizon=10_000, fields=["ts"], chunk=100_000)
        assert _max_partition_share(chunked, "next1_ts") < 0.3
        prior = S.with_prior_max(df, ["k"], "seq", "ts", chunk_rows=1_000)
        assert _max_partition_share(prior, "prior_max") < 0.3
        other = spark.createDataFrame([(k, ts) for k, ts, _ in data[:5000]], "k string, rt long")
        j = J.interval_join(df.hint("shuffle_merge"), other, ["k"], "ts", "rt", -1000, 1000)
        assert _max_partition_share(j, "rt") < 0.3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_sizing_conf():
    from tidewater.session import sizing_conf
    c = sizing_conf(100 << 40, executors=1000, cores_per_executor=4)   # 100 TB
    assert int(c["spark.sql.shuffle.partitions"]) == 20000   # five waves
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    assert int(sizing_conf(1 << 30, executors=10)["spark.sql.shuffle.partitions"]) == 80


def test_top_monitors_options(spark):
    """Descending order and per-area ranking are options."""
    bands = spark.createDataFrame(
        [("w", "e", a, f"m{i}", i, 0, 0, 0) for a in ("x", "y") for i in range(4)],
        "stt string, edt string, area_id string, monitor_id string, high_speed_count long, "
        "middle_speed_count long, normal_speed_count long, low_speed_count long")
    top = W.top_monitors(bands, 1, ascending=False, partition_by=["area_id"], window_cols=("stt", "edt"))
    assert rows(top, "area_id", "monitor_id") == [("x", "m3"), ("y", "m3")]


def test_route_read_as_insert(spark):
    """Snapshot rows (type read) take the insert route only on request."""
    ch = spark.createDataFrame([("t", "read", {"id": "1"}, 1)],
                               "table_name string, type string, after map<string,string>, seq long")
    cfg = spark.createDataFrame([("t", "insert", "kafka", "dwd_t", "id", "id", None)],
                                "source_table string, operate_type string, sink_type string, sink_table string, "
                                "sink_columns string, sink_pk string, sink_extend string")
    assert route(ch, cfg).count() == 0
    assert route(ch, cfg, read_as_insert=True).count() == 1


def test_with_previous_matches_lag(spark):
    rnd = random.Random(9)
    data = [(rnd.randint(0, 3), i, rnd.randint(0, 99)) for i in range(300)]
    df = spark.createDataFrame(data, "k int, seq long, v int")
    got = {r["seq"]: r["prev_v"] for r in S.with_previous(df, ["k"], "seq", ["v"], chunk_rows=11).collect()}
    last, want = {}, {}
    for k, seq, v in data:
        want[seq] = last.get(k)
        last[k] = v
    assert got == want


def test_with_following_property(spark):
    """Any chunk width >= horizon gives the exact next rows within the horizon."""
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3_000)), min_size=1, max_size=60),
           st.integers(1, 200), st.integers(1, 5))
    def check(rows_in, horizon, factor):
        data = [(k, ts, i) for i, (k, ts) in enumerate(rows_in)]
        df = spark.createDataFrame(data, "k int, ts long, seq long")
        out = S.with_following(df, ["k"], "ts", "seq", horizon=horizon, fields=["ts"], chunk=horizon * factor)
        got = {r["seq"]: (r["next1_ts"] if r["next1_ts"] is not None and r["next1_ts"] - r["ts"] < horizon
                          else None) for r in out.collect()}
        assert got == _naive_next(data, horizon)

    check()


def test_upsert_keeps_stored_rows(spark, tmp_dir):
    """A batch with another column, a read error, a crash before the commit."""
    import pytest
    from tidewater import storage
    target = tmp_dir + "/dim50"
    K.upsert_dim(spark.createDataFrame([(f"k{i}", i, 1) for i in range(50)], "k string, v int, seq long"), target, ["k"], "seq")
    K.upsert_dim(spark.createDataFrame([("k1", 100, "n", 2), ("k60", 1, "n", 2)], "k string, v int, extra string, seq long"),
                 target, ["k"], "seq")
    snap = K.read_snapshot(spark, target)
    assert snap.count() == 51 and rows(snap.where("extra = 'n'"), "k", "v") == [("k1", 100), ("k60", 1)]
    # data written but no version: the old version stands, the next batch builds on it and collects the folder
    put, storage.put_new = storage.put_new, lambda *a: (_ for _ in ()).throw(OSError("crash"))
    try:
        with pytest.raises(OSError):
            K.upsert_dim(spark.createDataFrame([("k2", 5, 9)], "k string, v int, seq long"), target, ["k"], "seq")
    finally:
        storage.put_new = put
    assert K.read_snapshot(spark, target).count() == 51 and len(storage.names(spark, f"{target}/data")) == 3
    K.upsert_dim(spark.createDataFrame([("k3", 7, 9)], "k string, v int, seq long"), target, ["k"], "seq")
    assert len(storage.names(spark, f"{target}/data")) == 3
    # a stored folder that cannot be read raises instead of being passed over
    state = K.snapshot_state(spark, target)
    storage.delete(spark, f"{target}/{state['runs'][0]['path']}")
    with pytest.raises(Exception):
        K.read_snapshot(spark, target).count()
    assert K.snapshot_state(spark, target) == state


def test_match_or_timeout_keeps_null_and_repeated_rows(spark):
    l = spark.createDataFrame([("a", None, 1), ("a", 100, 2), ("a", 100, 2), ("b", 5, 3), (None, 5, 4), ("c", 10, 5)],
                              "car string, ts long, seq long")
    r = spark.createDataFrame([("b", 6, 10), ("c", None, 11), (None, 5, 12), ("b", 6, 10)], "car string, ts long, seq long")
    out = rows(J.match_or_timeout(l, r, "car", "ts", "ts", 5), "car", "l_id", "r_id", "status")
    assert sorted(out, key=str) == sorted([
        ("a", 1, None, "left_only"), ("a", 2, None, "left_only"), ("a", 2, None, "left_only"), ("c", 5, None, "left_only"),
        (None, 4, None, "left_only"), ("b", 3, 10, "matched"), ("b", 3, 10, "matched"),
        ("c", None, 11, "right_only"), (None, None, 12, "right_only")], key=str)


def test_match_or_timeout_joins_once(spark):
    d = spark.createDataFrame([("a", 1, 1)], "car string, ts long, seq long")
    plan = J.match_or_timeout(d, d, "car", "ts", "ts", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1


def test_order_times_of_millis_and_text(spark):
    d = spark.createDataFrame([("1650000000000",), ("2022-04-15 05:20:00",), ("rubbish",), (None,)], "create_time string")
    from tidewater.operators.orders import order_times
    got = [tuple(r) for r in order_times(d).select("create_date", "create_hour", "create_ts").collect()]
    assert got == [("2022-04-15", "05", 1650000000000)] * 2 + [(None, None, None)] * 2


def test_shared_dir_is_refused_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from tidewater.session import shared_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn", setCheckpointDir=None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError):
        shared_dir(fake)


def test_end_to_end_keys_aggregate(spark):
    """The rows of a windowed key are fewer than what goes in."""
    from tidewater.plans import fixtures as FX
    from tidewater.plans.catalog import QUERIES, load_all
    load_all()
    sf = "/root/testdata/sf0.001"
    out = QUERIES["e2e_keyword"](spark, sf)
    assert out.agg(F.sum("ct")).first()[0] > 2 * out.count()
    v = QUERIES["visitor_stats_11s"](spark, sf)
    assert v.count() < QUERIES["visitor_union"](spark, sf).count() / 2
    assert v.agg(F.sum("uv_ct"), F.sum("uj_ct")).first()[0] > 0


def test_read_changes_initial_snapshot(spark):
    from tidewater.sources.changes import read_changes
    ch = spark.createDataFrame([("db", "t", "insert", {"id": "2"}, 5), ("db2", "t", "insert", {"id": "3"}, 6)],
                               "database string, table_name string, type string, after map<string,string>, seq long")
    snap = spark.createDataFrame([("db", "t", {"id": "1"}, 0)],
                                 "database string, table_name string, after map<string,string>, seq long")
    init = read_changes(ch, databases=["db"], startup="initial", snapshot=snap)
    assert rows(init, "type", "seq") == [("insert", 5), ("read", 0)]
    assert rows(read_changes(ch, tables=["db.t"], startup="latest"), "seq") == [(5,)]


def test_avg_speed_processing_time_variant(spark):
    cars = spark.createDataFrame([("a", "r", "m", 10.0), ("a", "r", "m", 20.0)],
                                 "area_id string, road_id string, monitor_id string, speed double") \
        .withColumn("ts", F.current_timestamp())
    out = A.avg_speed(cars, "5 minutes", "1 minute", processing_time=True).collect()
    assert len(out) == 5 and {r.avg_speed for r in out} == {15.0}


def test_polled_table_reloads_after_ttl(spark):
    from tidewater.sources.config import PolledTable
    now = [0.0]
    t = PolledTable(lambda s: s.range(3), ttl=10, clock=lambda: now[0])
    assert t.get(spark).count() == 3 and t.loads == 1
    now[0] = 5
    t.get(spark)
    assert t.loads == 1          # within the TTL: the loaded copy
    now[0] = 10
    t.get(spark)
    assert t.loads == 2          # expired: re-read


def test_scans_push_filters_and_prune_columns(spark):
    from tidewater.plans.catalog import QUERIES, load_all
    load_all()
    sf = "/root/testdata/sf0.001"
    plan = QUERIES["payment_wide"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,P)" in plan                  # filter reaches the parquet scan
    plan = QUERIES["order_times"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan   # 2 of 6 columns


def test_approx_distinct_options(spark):
    from tidewater.plans import fixtures as FX
    w = FX.order_info(spark, "/root/testdata/sf0.001").select(
        F.col("id").alias("order_id"), (F.col("province_id")).alias("province_id"), "create_ts",
        F.lit("p").alias("province_name"), F.lit("a").alias("province_area_code"),
        F.lit("i").alias("province_iso_code"), F.lit("c").alias("province_3166_2_code"),
        F.lit(1).cast("decimal(18,2)").alias("split_total_amount"))
    exact = {r.stt + str(r.province_id): r.order_count for r in A.province_stats(w, "30 days").collect()}
    approx = {r.stt + str(r.province_id): r.order_count for r in A.province_stats(w, "30 days", approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= max(2, 0.05 * exact[k]) for k in exact)
