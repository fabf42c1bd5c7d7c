"""Domain inputs derived from the driver's tables (FIXTURES.md §2).

Every view is a pure DataFrame derivation of the given parquet tables, so its
size grows with them; the same definitions are written in DuckDB SQL in
``plans/oracle_views.py``.  Modulo expressions below *generate attribute values*
(channel, item type, number of displays ...); none of them samples rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import input_partitions
from ..operators.sequence import with_previous

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

TEXT_TS = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _millis(c: str) -> Column:
    # zone-less driver timestamps are read as TIMESTAMP_NTZ; session zone is UTC
    return F.unix_millis(F.col(c).cast("timestamp"))


def _text(c: str) -> Column:
    return F.date_format(F.col(c).cast("timestamp"), TEXT_TS)


def _events_k(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", _k())


# ---------------------------------------------------------------- behaviour log
def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested page/start log record per event (JSON log shape).

    The fields are computed flat first and the structs assembled from plain
    column references, so Catalyst can prune through them: a query that
    needs two fields reads only the columns behind those two.
    """
    e = _events_k(spark, sf_dir)
    item_type = F.when(F.col("k") % 2 == 0, "sku_id").otherwise("other")
    display = F.struct(F.col("k").cast("string").alias("item"), item_type.alias("item_type"))
    flat = e.select(
        F.concat(F.lit("m"), F.col("user_id")).alias("mid"),
        F.concat(F.lit("v"), F.col("user_id") % 3).alias("vc"),
        F.concat(F.lit("c"), F.col("user_id") % 5).alias("ch"),
        F.concat(F.lit("a"), F.col("user_id") % 7).alias("ar"),
        F.when(F.col("k") % 3 == 0, "1").otherwise("0").alias("is_new"),
        F.when(F.col("event_type") == "view", "good_detail").otherwise(F.col("event_type")).alias("page_id"),
        F.when(F.col("event_type") == "click", "")
         .when(F.col("event_type") == "error", "search")
         .when(F.col("event_type") == "purchase", "home").alias("last_page_id"),
        F.col("k").cast("string").alias("item"),
        item_type.alias("item_type"),
        F.round(F.col("value") * 1000).cast("long").alias("during_time"),
        F.array_repeat(display, (F.col("k") % 3).cast("int")).alias("displays"),
        F.when((F.col("event_type") == "signup") & (F.col("k") % 2 == 1), "boot").alias("start"),
        _millis("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )
    return flat.select(
        F.struct("mid", "vc", "ch", "ar", "is_new").alias("common"),
        F.struct("page_id", "last_page_id", "item", "item_type", "during_time").alias("page"),
        "displays", "start", "ts", "seq")


def _json_str(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def raw_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text line per event; k = 0 events become unparsable text.

    Built by string concatenation (fixed key order, nulls omitted) so that the
    oracle can produce the identical text.
    """
    e = _events_k(spark, sf_dir)
    lp = (F.when(F.col("event_type") == "click", "")
           .when(F.col("event_type") == "error", "search")
           .when(F.col("event_type") == "purchase", "home"))
    item_type = F.when(F.col("k") % 2 == 0, "sku_id").otherwise("other")
    disp = F.concat(F.lit('{"item":"'), F.col("k").cast("string"), F.lit('","item_type":"'),
                    item_type, F.lit('","pos_id":'), (F.col("k") % 6).cast("string"), F.lit("}"))
    n = (F.col("k") % 3).cast("int")
    displays = F.substr(F.expr("repeat(concat(',', disp), n)"), F.lit(2))
    start = F.when((F.col("event_type") == "signup") & (F.col("k") % 2 == 1), F.lit(',"start":"boot"')).otherwise(F.lit(""))
    line = F.concat(
        F.lit('{"common":{"mid":"m'), F.col("user_id").cast("string"),
        F.lit('","vc":"v'), (F.col("user_id") % 3).cast("string"),
        F.lit('","ch":"c'), (F.col("user_id") % 5).cast("string"),
        F.lit('","ar":"a'), (F.col("user_id") % 7).cast("string"),
        F.lit('","is_new":"'), F.when(F.col("k") % 3 == 0, "1").otherwise("0"),
        F.lit('","os":"os'), (F.col("user_id") % 4).cast("string"),
        F.lit('"},"page":{"page_id":"'),
        F.when(F.col("event_type") == "view", "good_detail").otherwise(F.col("event_type")),
        F.lit('"'),
        F.coalesce(F.concat(F.lit(',"last_page_id":'), _json_str(lp)), F.lit("")),
        F.lit(',"item":"'), F.col("k").cast("string"), F.lit('","item_type":"'), item_type,
        F.lit('","during_time":'), F.round(F.col("value") * 1000).cast("long").cast("string"),
        F.lit('},"displays":['), F.col("displays_txt"), F.lit("]"),
        start,
        F.lit(',"ts":'), _millis("ts").cast("string"), F.lit("}"))
    return (e.withColumn("disp", disp).withColumn("n", n)
             .withColumn("displays_txt", displays)
             .select(F.col("event_id").alias("seq"),
                     F.when(F.col("k") == 0, F.concat(F.lit("not json "), F.col("event_id").cast("string")))
                      .otherwise(line).alias("value")))


# --------------------------------------------------------------------- traffic
def car_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events_k(spark, sf_dir)
    return e.select(
        F.lpad((F.col("user_id") % 8).cast("string"), 2, "0").alias("area_id"),
        F.lpad((F.col("k") % 5).cast("string"), 2, "0").alias("road_id"),
        F.lpad((F.col("k") % 10).cast("string"), 4, "0").alias("monitor_id"),
        F.lpad(F.col("k").cast("string"), 5, "0").alias("camera_id"),
        _text("ts").alias("action_time"),
        F.concat(F.lit("c"), F.col("user_id")).alias("car_id"),
        F.col("value").alias("speed"),
        F.col("event_id").alias("seq"),
    )


def car_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's 7-field tab-separated line per car passage."""
    c = car_info(spark, sf_dir)
    return c.select("seq", F.concat_ws("\t", "area_id", "road_id", "monitor_id", "camera_id",
                                       "action_time", "car_id",
                                       F.col("speed").cast("string")).alias("value"))


def speed_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit table: monitors 0000-0004 have a configured limit (40 +
    monitor number); the others fall back to the default."""
    e = _events_k(spark, sf_dir)
    return (e.select(F.lpad((F.col("user_id") % 8).cast("string"), 2, "0").alias("area_id"),
                     F.lpad((F.col("k") % 5).cast("string"), 2, "0").alias("road_id"),
                     F.lpad((F.col("k") % 10).cast("string"), 4, "0").alias("monitor_id"),
                     (F.lit(40) + F.col("k") % 10).cast("double").alias("speed_limit"))
             .where(F.col("monitor_id") < "0005")
             .distinct())


def violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return e.select(F.concat(F.lit("c"), F.col("user_id")).alias("car_id"),
                    F.lit("violation").alias("violation"),
                    _text("ts").alias("create_time"),
                    F.concat(F.lit("event "), F.col("event_id")).alias("description"),
                    F.col("event_id").alias("seq"))


def police(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return e.select(F.concat(F.lit("p"), F.col("event_id")).alias("police_id"),
                    F.concat(F.lit("c"), F.col("user_id")).alias("car_id"),
                    _text("ts").alias("action_time"),
                    F.lit("done").alias("status"),
                    F.col("event_id").alias("seq"))


# -------------------------------------------------------------- e-commerce
def _dec(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        _dec(F.col("o_totalprice")).alias("total_amount"),
        _dec(F.col("o_orderkey") % 100).alias("activity_reduce_amount"),
        _dec(F.col("o_orderkey") % 7).alias("coupon_reduce_amount"),
        _dec(F.col("o_totalprice")).alias("original_total_amount"),
        _dec(F.col("o_orderkey") % 20).alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        _millis("o_orderdate").cast("string").alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
        _millis("o_orderdate").alias("create_ts"),
    )


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as order details.  ``id`` is NOT unique: (orderkey, linenumber)
    repeats in the driver data."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        _dec(F.col("l_extendedprice")).alias("order_price"),
        F.col("l_quantity").cast("long").alias("sku_num"),
        F.concat(F.lit("sku "), F.col("l_partkey")).alias("sku_name"),
        _millis("l_shipdate").cast("string").alias("create_time"),
        _dec(F.col("l_extendedprice")).alias("split_total_amount"),
        _dec(F.col("l_discount")).alias("split_activity_amount"),
        _dec(F.col("l_tax")).alias("split_coupon_amount"),
        _millis("l_shipdate").alias("create_ts"),
    )


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    pay_ts = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(days=(F.col("o_orderkey") % 30 - 10).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        _dec(F.col("o_totalprice")).alias("total_amount"),
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("subject"),
        F.lit("card").alias("payment_type"),
        F.date_format(pay_ts, TEXT_TS).alias("create_time"),
        F.lit(None).cast("string").alias("callback_time"),
        F.unix_millis(pay_ts).alias("create_ts"),
    )


def dim_user_info(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"),
                    F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
                    F.date_format(F.date_add(F.lit("1960-01-01").cast("date"),
                                             (F.col("c_custkey") % 15000).cast("int")), "yyyy-MM-dd").alias("birthday"))


def dim_base_province(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
             .select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
                     F.col("r_name").alias("area_code"),
                     F.concat(F.lit("ISO"), F.col("n_nationkey")).alias("iso_code"),
                     F.concat(F.lit("CN-"), F.col("n_nationkey")).alias("iso_3166_2")))


def _category_id(c: str = "p_type") -> Column:
    return (F.ascii(F.col(c)) * 100 + F.length(F.col(c))).cast("long")


def _tm_id() -> Column:
    return F.substring_index(F.col("p_brand"), "#", -1).cast("long")


def dim_sku_info(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
                    _dec(F.col("p_retailprice")).alias("sku_price"),
                    F.col("p_size").cast("long").alias("spu_id"), _tm_id().alias("tm_id"),
                    _category_id().alias("category3_id"))


def dim_spu_info(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return (p.select(F.col("p_size").cast("long").alias("id")).distinct()
             .withColumn("spu_name", F.concat(F.lit("spu "), F.col("id"))))


def dim_base_trademark(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(_tm_id().alias("id"), F.col("p_brand").alias("tm_name")).distinct()


def dim_base_category3(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(_category_id().alias("id"), F.col("p_type").alias("name")).distinct()


def _lineitem_by_flag(spark, sf_dir, flag: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag)


def favor_info(spark, sf_dir) -> DataFrame:
    li = _lineitem_by_flag(spark, sf_dir, "N")
    return li.select(F.col("l_partkey").alias("sku_id"), _millis("l_shipdate").cast("string").alias("create_time"))


def cart_info(spark, sf_dir) -> DataFrame:
    li = _lineitem_by_flag(spark, sf_dir, "A")
    return li.select(F.col("l_partkey").alias("sku_id"), _millis("l_shipdate").cast("string").alias("create_time"))


def refund_info(spark, sf_dir) -> DataFrame:
    li = _lineitem_by_flag(spark, sf_dir, "R")
    return li.select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("sku_id"),
                     _dec(F.col("l_extendedprice")).alias("refund_amount"),
                     _millis("l_shipdate").cast("string").alias("create_time"))


def comment_info(spark, sf_dir) -> DataFrame:
    li = _lineitem_by_flag(spark, sf_dir, "R")
    return li.select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("sku_id"),
                     F.when(F.col("l_linenumber") % 2 == 0, "1201").otherwise("1203").alias("appraise"),
                     _millis("l_shipdate").cast("string").alias("create_time"))


# ------------------------------------------------------------- change capture
def change_records(spark: SparkSession, sf_dir: str, images: bool = True) -> DataFrame:
    """Raw change envelopes as a capture connector hands them over.

    topic ``<server>.<database>.<table>``, upper-case operation, before/after
    maps (null when absent), source sequence number.  The before-image is the
    previous row of the same key, which takes a pass over the history; without
    ``images`` it is left out (null) for readers that never look at it.
    """
    e = _events_k(spark, sf_dir)
    row = F.create_map(F.lit("id"), F.col("user_id").cast("string"),
                       F.lit("value"), F.round(F.col("value") * 100).cast("long").cast("string"),
                       F.lit("k"), F.col("k").cast("string"))
    op = F.when(F.col("k") < 10, "DELETE").when(F.col("k") < 40, "CREATE").otherwise("UPDATE")
    # before-image: the previous row of the same (table, id), by source sequence
    prev = F.lit(None).cast("map<string,string>")
    if images:
        e = with_previous(e.withColumn("_row", row), ["event_type", "user_id"], "event_id", ["_row"])
        prev = F.col("prev__row")
    return e.select(
        F.concat(F.lit("binlog.shop."), F.col("event_type")).alias("topic"),
        op.alias("op"),
        F.when(op == "CREATE", F.lit(None)).otherwise(prev).alias("before"),
        F.when(op == "DELETE", F.lit(None)).otherwise(row).alias("after"),
        _millis("ts").alias("ts_ms"),
        F.col("event_id").alias("seq"),
    )


def table_process(spark: SparkSession) -> DataFrame:
    """Routing configuration rows (the reference keeps them in a config table)."""
    # fixed values: one row per (source table, operation) route
    rows = [
        ("view", "insert", "kafka", "dwd_view", "id,value", "id", None),
        ("view", "update", "kafka", "dwd_view", "id,k", "id", None),
        ("click", "insert", "hbase", "dim_click", "id,k", "id", None),
        ("signup", "insert", "clickhouse", "signup_stats", "id", "id", None),
    ]
    schema = ("source_table string, operate_type string, sink_type string, sink_table string, "
              "sink_columns string, sink_pk string, sink_extend string")
    return spark.createDataFrame(rows, schema)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt to all cores where a scan has fewer splits than there are cores (a small table in one file)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if splits < cores else df


# the shop's tables as changes: facts keep the first image, dimensions are upserted by their key
SHOP_FACTS = {
    "order_info": order_info, "order_detail": order_detail, "payment_info": payment_info, "favor_info": favor_info,
    "cart_info": cart_info, "order_refund_info": refund_info, "comment_info": comment_info,
}
SHOP_DIMS = {
    "base_province": dim_base_province, "sku_info": dim_sku_info, "spu_info": dim_spu_info,
    "base_trademark": dim_base_trademark, "base_category3": dim_base_category3,
}
SHOP_KEYS = {"base_category3": "category3_id"}   # key column other than the default


def shop_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shop table as the source database holds it."""
    d = {**SHOP_FACTS, **SHOP_DIMS}[name](spark, sf_dir).drop("create_ts")
    if name in SHOP_FACTS:
        d = spread(d)
    return d.withColumnRenamed("id", SHOP_KEYS[name]) if name in SHOP_KEYS else d


def shop_changes(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> DataFrame:
    """Raw change envelopes of the shop database.

    Every row is created once.  Orders divisible by 10 are deleted later and
    orders divisible by 7 updated (neither is routed); every trademark is
    created under an old name and the even ones are then renamed.
    """
    def envelopes(name: str, d: DataFrame, op: str, seq: int) -> DataFrame:
        row = F.create_map(*[x for c in d.columns for x in (F.lit(c), F.col(c).cast("string"))])
        none = F.lit(None).cast("map<string,string>")
        return d.select(F.lit(f"binlog.shop.{name}").alias("topic"), F.lit(op).alias("op"),
                        (none if op == "CREATE" else row).alias("before"), (none if op == "DELETE" else row).alias("after"),
                        F.lit(0).cast("long").alias("ts_ms"), F.lit(seq).cast("long").alias("seq"))

    out = None
    for name in tables:
        d = shop_table(spark, sf_dir, name)
        parts = [envelopes(name, d, "CREATE", 1)]
        if name == "order_info":
            parts += [envelopes(name, d.where("id % 7 = 0").withColumn("order_status", F.lit("X")), "UPDATE", 2),
                      envelopes(name, d.where("id % 10 = 0"), "DELETE", 3)]
        if name == "base_trademark":
            parts = [envelopes(name, d.withColumn("tm_name", F.concat(F.lit("old "), "tm_name")), "CREATE", 1),
                     envelopes(name, d.where("id % 2 = 0"), "UPDATE", 2)]
        for p in parts:
            out = p if out is None else out.unionByName(p)
    return out


def shop_process(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = (*SHOP_FACTS, *SHOP_DIMS)) -> DataFrame:
    """Routing of the shop tables: facts on insert, dimensions on insert and update."""
    rows = []
    for name in tables:
        cols = ",".join(c for c in shop_table(spark, sf_dir, name).columns if c not in ("expire_time", "operate_time"))
        kind, to = ("kafka", f"dwd_{name}") if name in SHOP_FACTS else ("hbase", f"dim_{name}")
        rows += [(name, op, kind, to, cols, SHOP_KEYS.get(name), None)
                 for op in (("insert",) if name in SHOP_FACTS else ("insert", "update"))]
    return spark.createDataFrame(rows, "source_table string, operate_type string, sink_type string, sink_table string, "
                                       "sink_columns string, sink_pk string, sink_extend string")


# ---------------------------------------------------------------- keywords
def search_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON log line per document: a search page view whose item is the
    document's text, ten a second (very short ones are reached from home)."""
    d = table(spark, sf_dir, "documents")
    page = F.struct(F.lit("good_list").alias("page_id"),
                    F.when(F.col("n_chars") < 200, "home").otherwise("search").alias("last_page_id"),
                    F.col("text").alias("item"))
    common = F.struct(F.concat(F.lit("m"), F.col("doc_id")).alias("mid"))
    return d.select(F.to_json(F.struct(common.alias("common"), page.alias("page"),
                                       (F.lit(1_704_067_200_000) + F.col("doc_id") * 100).alias("ts"))).alias("value"))


NUMERALS = "零一二三四五六七八九"  # fixed value: the ten digits


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of ideographs, letters and digits, one per supplier, each with a long number in words."""
    s = table(spark, sf_dir, "supplier")
    number = F.translate((F.col("s_suppkey").cast("bigint") * 7919 * 7919).cast("string"), "0123456789", NUMERALS)
    return s.select(F.col("s_suppkey").alias("id"), F.concat(
        F.lit("公交公司"), F.col("s_name"), number,
        F.when(F.col("s_suppkey") % 2 == 0, "中华人民共和国 Für").otherwise("人民公交站")).alias("text"))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of two to seven ideographs, and the number of every part in words."""
    # fixed values
    words = spark.createDataFrame([(w,) for w in ("人民", "共和国", "公交公司", "中华人民共和国")], "word string")
    number = F.translate(F.col("p_partkey").cast("string"), "0123456789", NUMERALS)
    return words.unionByName(table(spark, sf_dir, "part").select(number.alias("word")))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search page views: the whole document text is the searched phrase."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id"),
                    F.col("text").alias("full_word"),
                    (F.lit("2024-01-01 00:00:00").cast("timestamp")
                     + F.make_dt_interval(secs=F.col("doc_id").cast("decimal(18,6)"))).alias("rt"))


# ---------------------------------------------------------------- listings
def _tenths(c: str) -> Column:
    """``n/10`` as text with one decimal, by integer arithmetic."""
    return F.concat((F.col(c) / 10).cast("int").cast("string"), F.lit("."), (F.col(c) % 10).cast("string"))


def _city(col_key: str) -> Column:
    base = F.concat(F.lit("C"), F.lpad((F.col(col_key) % 25).cast("string"), 2, "0"))
    return F.when(F.col(col_key) % 7 == 0, F.concat(base, F.lit("市"))).otherwise(base)


def _street(col_key: str) -> Column:
    return F.concat(F.lit("S"), (F.col(col_key) % 5).cast("string"))


def hotel_raw(spark, sf_dir) -> DataFrame:
    """Raw hotel listing rows (the text formats the crawler stored)."""
    p = table(spark, sf_dir, "part")
    key = "p_partkey"
    city = _city(key)
    price_int = F.floor("p_retailprice").cast("string")
    v = F.col(key) % 4
    price = (F.when(v == 0, F.concat(F.lit("¥"), price_int, F.lit("起")))
              .when(v == 1, F.concat(price_int, F.lit("元")))
              .when(v == 2, F.lit("")))
    score = (F.when(F.col(key) % 3 == 0, F.concat(_tenths("p_size"), F.lit("分")))
              .when(F.col(key) % 3 == 1, _tenths("p_size"))
              .otherwise(F.lit("")))
    comment = F.when(F.col(key) % 2 == 0, F.concat(F.lit(" 共"), F.col("p_size").cast("string"), F.lit("条评论 "))) \
               .otherwise(F.lit("暂无评论"))
    street = _street(key)
    a = F.col(key) % 5
    address = (F.when(a == 0, F.concat(F.lit("近"), street, F.lit(" · "), F.col("p_name")))
                .when(a == 1, F.concat(F.lit("'"), city, street, F.lit('"')))
                .when(a == 2, F.concat(street, F.lit("\t"), F.lit("\n")))
                .when(a == 3, F.concat(F.lit("近 "), city, street))
                .otherwise(F.concat(street, F.lit(" · "), F.lit("近"), F.col("p_type"))))
    return p.select(F.col("p_partkey").alias("id"), city.alias("city"),
                    F.col("p_name").alias("hotel_name"), F.col("p_type").alias("hotel_type"),
                    score.alias("score"), comment.alias("comment_count"), address.alias("address"),
                    price.alias("price"), F.concat(F.lit("img/"), F.col(key)).alias("picture"))


def sight_raw(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = "p_partkey"
    city = F.concat(F.lit("C"), F.lpad((F.col(key) % 25).cast("string"), 2, "0"))
    r = F.col(key) % 7
    tag = (F.when(r == 0, "5A").when(r == 1, "4A").when(r == 2, "3A").when(r == 3, "2A")
            .when(r == 4, "1A").otherwise(""))
    name = F.when(F.col(key) % 11 == 0, F.concat(F.col("p_name"), tag, F.lit("4A")))\
            .otherwise(F.concat(F.col("p_name"), tag))
    street = _street(key)
    a = F.col(key) % 6
    address = (F.when(a == 0, F.concat(street, F.lit("(东门)")))
                .when(a == 1, F.concat(F.lit("市"), street, F.lit(" 北")))
                .when(a == 2, F.concat(city, F.lit("市"), street, F.lit("（南）")))
                .when(a == 3, F.concat(F.lit("某省")))
                .when(a == 4, F.concat(street, F.lit(","), F.lit("x"), F.lit("、y")))
                .otherwise(F.concat(street, F.lit("#1号!"))))
    return p.select(F.col("p_partkey").alias("id"), city.alias("city"), name.alias("name"),
                    F.concat(F.col("p_size").cast("string"), F.lit("条点评")).alias("comment_count"),
                    F.when(F.col(key) % 3 == 0, F.lit("暂无"))
                     .otherwise(F.concat(_tenths("p_size"), F.lit("/5分"))).alias("comment_score"),
                    F.concat(F.lit("rank "), F.col("p_brand")).alias("rank_class"),
                    (F.col("p_retailprice") / 100).alias("heat_score"),
                    address.alias("address"), F.lit("08:00-17:00").alias("open_info"),
                    F.concat(F.lit("tel-"), F.col(key)).alias("phone"))


#: Bytes of the order lines whose stops one task tells apart and cleans.
BUS_BYTES = 4 << 20


def bus_raw(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_partkey")
    # nearly all rows differ: dealt first, so that no task holds more of them when the table grows
    li = li.repartition(input_partitions(li, BUS_BYTES), *li.columns).distinct()
    b = li.join(s, li.l_suppkey == s.s_suppkey)
    city = F.concat(F.lit("C"), F.lpad((F.col("s_nationkey") % 25).cast("string"), 2, "0"))
    station = F.when(F.col("l_partkey") % 3 == 0,
                     F.concat(F.lit(" S"), (F.col("l_partkey") % 5).cast("string"), F.lit("公交站 ")))\
               .otherwise(F.concat(F.lit("S"), (F.col("l_partkey") % 5).cast("string")))
    return b.select(
        (F.col("l_suppkey") * 10_000_000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("id"),
        city.alias("city"),
        F.concat(F.lit("["), F.col("l_linenumber").cast("string"), F.lit("路]")).alias("line_name"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("路")).alias("bus_name"),
        F.when(F.col("l_partkey") % 2 == 0, "up").otherwise("down").alias("forward"),
        station.alias("station_name"),
        F.lit("06:00-22:00").alias("run_time"), F.lit("daily").alias("run_time_desc"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("公交公司："), F.col("s_name"))).alias("company"),
        F.concat(F.lit("2元"), F.lit("")).alias("price"),
        (F.col("l_partkey") % 50).cast("int").alias("station_id"),
    )


def gazetteer(spark, sf_dir) -> DataFrame:
    """Address -> coordinates table, ten entries per nation (city).

    Streets 0-2 are spelled ``C07S1``, streets 3-4 only ``C07市S3`` (so the
    second-spelling fallback is exercised); bus stops ``C07市S1公交站``.
    Nation 0 has lon 0 (no fix).
    """
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    g = (n.join(r, n.n_regionkey == r.r_regionkey, "left")
          .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(9))))
          .withColumn("s", F.col("i") % 5))
    city = F.concat(F.lit("C"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    street = F.concat(F.lit("S"), F.col("s").cast("string"))
    addr = (F.when(F.col("i") >= 5, F.concat(city, F.lit("市"), street, F.lit("公交站")))
             .when(F.col("s") < 3, F.concat(city, street))
             .otherwise(F.concat(city, F.lit("市"), street)))
    return g.select(addr.alias("address"),
                    (F.col("n_nationkey") * 3.5).alias("lon"),
                    (F.lit(20.0) + F.col("i")).alias("lat"),
                    F.col("r_name").alias("province"),
                    (F.lit(100000) + F.col("n_nationkey") * 100 + F.col("i")).cast("string").alias("adcode"),
                    F.concat(F.lit("D"), F.col("s")).alias("district"),
                    F.concat(F.lit("T"), F.col("i")).alias("town"))
