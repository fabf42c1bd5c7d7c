"""E-commerce keys: P8, P10, P12, P13, J0-J2, J4-J6, A2, A3, U3, F6, E2, E3."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import orders as O
from ..operators.joins import age_years, interval_join, lookup
from ..operators.measures import clicks_and_displays, product_measures
from ..operators.routing import SINK_DIM, SINK_FACT, route
from ..session import materialize, scratch_path
from ..sources import runs as R
from ..sources import sinks as K
from ..sources.changes import drop_deletes, normalize_changes
from . import fixtures as FX
from .catalog import register
from .oracle_views import view
from .oracle_views import with_views as V

DAY = 86_400_000
WIDE_LO, WIDE_HI = -20 * DAY, 20 * DAY
PAY_LO, PAY_HI = -15 * DAY, 5 * DAY
TSF = "'%Y-%m-%d %H:%M:%S'"

DETAIL = ("sku_id", "order_price", "sku_num", "sku_name", "split_activity_amount",
          "split_coupon_amount", "split_total_amount")
ORDER = ("province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
         "coupon_reduce_amount", "original_total_amount", "feight_fee", "expire_time",
         "create_time", "operate_time")

view("order_wide", f"""
SELECT d.id AS detail_id, o.id AS order_id, {", ".join("d." + c for c in DETAIL)},
       {", ".join("o." + c for c in ORDER)},
       strftime(epoch_ms(o.create_ts), '%Y-%m-%d') AS create_date, strftime(epoch_ms(o.create_ts), '%H') AS create_hour,
       o.create_ts
FROM order_info o JOIN order_detail d
  ON d.order_id = o.id AND d.create_ts BETWEEN o.create_ts + ({WIDE_LO}) AND o.create_ts + ({WIDE_HI})""",
     ("order_info", "order_detail"))

view("order_wide_enriched", """
SELECT w.*, u.gender AS user_gender,
       CAST(floor(date_diff('day', CAST(u.birthday AS DATE), CAST(w.create_date AS DATE)) / 365) AS INTEGER) AS user_age,
       p.name AS province_name, p.area_code AS province_area_code, p.iso_code AS province_iso_code,
       p.iso_3166_2 AS province_3166_2_code, s.spu_id, s.tm_id, s.category3_id,
       sp.spu_name, t.tm_name, c.name AS category3_name
FROM order_wide w
LEFT JOIN dim_user_info u ON w.user_id = u.id
LEFT JOIN dim_base_province p ON w.province_id = p.id
LEFT JOIN dim_sku_info s ON w.sku_id = s.id
LEFT JOIN dim_spu_info sp ON s.spu_id = sp.id
LEFT JOIN dim_base_trademark t ON s.tm_id = t.id
LEFT JOIN dim_base_category3 c ON s.category3_id = c.id""",
     ("order_wide", "dim_user_info", "dim_base_province", "dim_sku_info", "dim_spu_info",
      "dim_base_trademark", "dim_base_category3"))

view("payment_wide", f"""
SELECT p.id AS payment_id, p.order_id, p.user_id, p.total_amount, p.subject, p.payment_type,
       p.callback_time, p.create_time AS payment_create_time, p.create_ts AS payment_create_ts,
       w.detail_id, {", ".join("w." + c for c in DETAIL)}, w.province_id, w.order_status,
       w.activity_reduce_amount, w.coupon_reduce_amount, w.original_total_amount, w.feight_fee,
       w.expire_time, w.create_time AS order_create_time, w.operate_time, w.create_date,
       w.create_hour, w.create_ts, w.user_gender, w.user_age, w.province_name, w.province_area_code,
       w.province_iso_code, w.province_3166_2_code, w.spu_id, w.tm_id, w.category3_id, w.spu_name,
       w.tm_name, w.category3_name, CAST(NULL AS DECIMAL(18,2)) AS split_feight_fee
FROM payment_info p JOIN order_wide_enriched w
  ON w.order_id = p.order_id AND w.create_ts BETWEEN p.create_ts + ({PAY_LO}) AND p.create_ts + ({PAY_HI})""",
     ("payment_info", "order_wide_enriched"))

PRODUCT_ZERO = dict(display_ct="0::BIGINT", click_ct="0::BIGINT", favor_ct="0::BIGINT",
                    cart_ct="0::BIGINT", order_sku_num="0::BIGINT", comment_ct="0::BIGINT",
                    good_comment_ct="0::BIGINT", order_amount="0::DECIMAL(18,2)",
                    payment_amount="0::DECIMAL(18,2)", refund_amount="0::DECIMAL(18,2)",
                    order_id="NULL::BIGINT", paid_order_id="NULL::BIGINT",
                    refund_order_id="NULL::BIGINT")


def _product_part(src: str, ts: str, **vals) -> str:
    cols = {**PRODUCT_ZERO, **vals}
    return f"SELECT sku_id, {', '.join(f'{v} AS {k}' for k, v in cols.items())}, {ts} AS ts FROM {src}"


PAGE_PAGES = "page_log"
view("product_union", "\nUNION ALL\n".join([
    _product_part("page_log WHERE page_id = 'good_detail' AND item_type = 'sku_id'", "ts",
                  click_ct="1::BIGINT").replace("SELECT sku_id", "SELECT CAST(item AS BIGINT) AS sku_id", 1),
    _product_part("page_log, range(n_displays) t(i) WHERE item_type = 'sku_id'", "ts",
                  display_ct="1::BIGINT").replace("SELECT sku_id", "SELECT CAST(item AS BIGINT) AS sku_id", 1),
    _product_part("favor_info", "CAST(create_time AS BIGINT)", favor_ct="1::BIGINT"),
    _product_part("cart_info", "CAST(create_time AS BIGINT)", cart_ct="1::BIGINT"),
    _product_part("order_wide", "create_ts", order_sku_num="sku_num", order_amount="order_price",
                  order_id="order_id"),
    _product_part("payment_wide", "payment_create_ts", payment_amount="order_price",
                  paid_order_id="order_id"),
    _product_part("refund_info", "CAST(create_time AS BIGINT)", refund_amount="refund_amount",
                  refund_order_id="id"),
    _product_part("comment_info", "CAST(create_time AS BIGINT)", comment_ct="1::BIGINT",
                  good_comment_ct="CASE WHEN appraise = '1201' THEN 1 ELSE 0 END::BIGINT"),
]), ("page_log", "favor_info", "cart_info", "order_wide", "payment_wide", "refund_info", "comment_info"))

PRODUCT_COUNTS = ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct",
                  "good_comment_ct")
PRODUCT_AMOUNTS = ("order_amount", "payment_amount", "refund_amount")
PRODUCT_AGGS = ", ".join([f"CAST(sum({c}) AS BIGINT) AS {c}" for c in PRODUCT_COUNTS]
                         + [f"CAST(sum({c}) AS DECIMAL(18,2)) AS {c}" for c in PRODUCT_AMOUNTS]
                         + ["count(DISTINCT order_id) AS order_ct",
                            "count(DISTINCT paid_order_id) AS paid_order_ct",
                            "count(DISTINCT refund_order_id) AS refund_order_ct"])
view("product_stats", f"""
SELECT strftime(epoch_ms(ws), {TSF}) AS stt, strftime(epoch_ms(ws + {DAY}), {TSF}) AS edt, sku_id, {PRODUCT_AGGS}
FROM (SELECT *, ts - (ts % {DAY}) AS ws FROM product_union) GROUP BY ws, sku_id""", ("product_union",))

view("product_stats_enriched", """
SELECT ps.*, s.sku_name, s.sku_price, s.spu_id, s.tm_id, s.category3_id, sp.spu_name,
       c.name AS category3_name, t.tm_name
FROM product_stats ps
LEFT JOIN dim_sku_info s ON ps.sku_id = s.id
LEFT JOIN dim_spu_info sp ON s.spu_id = sp.id
LEFT JOIN dim_base_category3 c ON s.category3_id = c.id
LEFT JOIN dim_base_trademark t ON s.tm_id = t.id""",
     ("product_stats", "dim_sku_info", "dim_spu_info", "dim_base_category3", "dim_base_trademark"))

PROVINCE = ("province_id", "province_name", "province_area_code", "province_iso_code",
            "province_3166_2_code")
view("province_stats", f"""
SELECT strftime(epoch_ms(ws), {TSF}) AS stt, strftime(epoch_ms(ws + {DAY}), {TSF}) AS edt,
       {", ".join(PROVINCE)}, count(DISTINCT order_id) AS order_count,
       CAST(sum(split_total_amount) AS DECIMAL(18,2)) AS order_amount
FROM (SELECT *, create_ts - (create_ts % {DAY}) AS ws FROM order_wide_enriched)
GROUP BY ws, {", ".join(PROVINCE)}""", ("order_wide_enriched",))


# ------------------------------------------------------------------ spark side
def _wide(spark, sf):
    return O.order_wide(FX.order_info(spark, sf), FX.order_detail(spark, sf), WIDE_LO, WIDE_HI)


def _enriched(spark, sf):
    return O.enrich_order(_wide(spark, sf), FX.dim_user_info(spark, sf), FX.dim_base_province(spark, sf),
                          FX.dim_sku_info(spark, sf), FX.dim_spu_info(spark, sf),
                          FX.dim_base_trademark(spark, sf), FX.dim_base_category3(spark, sf))


def _payment_wide(spark, sf, wide=None):
    wide = _enriched(spark, sf) if wide is None else wide
    return O.payment_wide(FX.payment_info(spark, sf), wide, PAY_LO, PAY_HI)


#: What the product measures and the payment join read of an order wide row.
NARROW = ("order_id", "sku_id", "sku_num", "order_price", "create_ts")


def _product_union(spark, sf):
    # dimensions come after the aggregation: the wide rows stay narrow, and
    # are handed off once as two branches read them
    wide = materialize(_wide(spark, sf).select(*NARROW), "dwm_order_wide")
    payments = O.payment_wide(FX.payment_info(spark, sf), wide, PAY_LO, PAY_HI)
    return product_measures(FX.page_log(spark, sf), FX.favor_info(spark, sf), FX.cart_info(spark, sf),
                            wide, payments, FX.refund_info(spark, sf), FX.comment_info(spark, sf))


def _product_stats(spark, sf):
    return A.product_stats(_product_union(spark, sf), "1 day")


@register("order_times", V("""
SELECT id, strftime(epoch_ms(CAST(create_time AS BIGINT)), '%Y-%m-%d') AS create_date,
       strftime(epoch_ms(CAST(create_time AS BIGINT)), '%H') AS create_hour, CAST(create_time AS BIGINT) AS create_ts
FROM order_info""", "order_info"))
def order_times(spark, sf):
    return O.order_times(FX.order_info(spark, sf)).select("id", "create_date", "create_hour", "create_ts")


@register("interval_join_exclusive", V("""
SELECT o.id AS order_id, d.id AS detail_id, o.create_ts, d.create_ts AS detail_ts
FROM order_info o JOIN order_detail d
  ON d.order_id = o.id AND d.create_ts > o.create_ts AND d.create_ts <= o.create_ts + 864000000""",
                                       "order_info", "order_detail"))
def interval_join_exclusive(spark, sf):
    """Lower end exclusive (same day excluded), upper end inclusive (+10 days)."""
    o = FX.order_info(spark, sf).select(F.col("id").alias("order_id"), "create_ts")
    d = FX.order_detail(spark, sf).select(F.col("id").alias("detail_id"), "order_id",
                                          F.col("create_ts").alias("detail_ts"))
    return interval_join(o, d, ["order_id"], "create_ts", "detail_ts", 0, 10 * DAY,
                         lo_inclusive=False, hi_inclusive=True)


@register("order_detail_join", V("SELECT * FROM order_wide", "order_wide"))
def order_detail_join(spark, sf):
    """Order x detail within +-20 days (the reference uses +-20 s)."""
    return _wide(spark, sf)


@register("order_wide_merge", V("""
SELECT id, coalesce(CASE WHEN id % 3 = 0 THEN NULL ELSE order_status END, order_status) AS order_status,
       coalesce(CASE WHEN id % 2 = 0 THEN NULL ELSE total_amount END, total_amount) AS total_amount,
       coalesce(CASE WHEN id % 5 = 0 THEN NULL ELSE create_time END, create_time) AS create_time,
       coalesce(NULL::BIGINT, user_id) AS user_id
FROM order_info""", "order_info"))
def order_wide_merge(spark, sf):
    """First-non-null merge of two partial wide rows of the same order."""
    o = FX.order_info(spark, sf)
    a = F.struct(F.when(F.col("id") % 3 != 0, F.col("order_status")).alias("order_status"),
                 F.when(F.col("id") % 2 != 0, F.col("total_amount")).alias("total_amount"),
                 F.when(F.col("id") % 5 != 0, F.col("create_time")).alias("create_time"),
                 F.lit(None).cast("long").alias("user_id"))
    b = F.struct("order_status", "total_amount", "create_time", "user_id")
    d = o.select("id", a.alias("a"), b.alias("b"))
    return O.merge_wide(d, "a", "b", ["order_status", "total_amount", "create_time", "user_id"],
                        keep=("id",))


@register("dim_lookup", V("""
SELECT o.id, o.user_id, u.gender, u.birthday FROM order_info o LEFT JOIN dim_user_info u ON o.user_id = u.id""",
                          "order_info", "dim_user_info"))
def dim_lookup(spark, sf):
    """Left lookup by id; missing dimension rows keep nulls."""
    o = FX.order_info(spark, sf).select("id", "user_id")
    return lookup(o, FX.dim_user_info(spark, sf), "user_id", ["gender", "birthday"])


@register("fn_age", V("""
SELECT o.id, CAST(floor(date_diff('day', CAST(u.birthday AS DATE), CAST(epoch_ms(o.create_ts) AS DATE)) / 365) AS INTEGER) AS user_age
FROM order_info o LEFT JOIN dim_user_info u ON o.user_id = u.id""", "order_info", "dim_user_info"))
def fn_age(spark, sf):
    """age in whole 365-day years at the order date."""
    o = O.order_times(FX.order_info(spark, sf)).select("id", "user_id", "create_date")
    j = lookup(o, FX.dim_user_info(spark, sf), "user_id", ["birthday"])
    return j.select("id", age_years(F.col("birthday"), F.to_date("create_date")).alias("user_age"))


@register("order_wide_enriched", V("SELECT * FROM order_wide_enriched", "order_wide_enriched"))
def order_wide_enriched(spark, sf):
    return _enriched(spark, sf)


@register("payment_wide", V("SELECT * FROM payment_wide", "payment_wide"))
def payment_wide(spark, sf):
    """J2 + P13: payment x (enriched) order wide, order time in [pay - 15 d, pay + 5 d]."""
    return _payment_wide(spark, sf)


@register("product_clicks_displays", V("""
SELECT sku_id, click_ct, display_ct, ts FROM product_union WHERE click_ct = 1 OR display_ct = 1""",
                                       "product_union"))
def product_clicks_displays(spark, sf):
    """P10 (page part)."""
    d = clicks_and_displays(FX.page_log(spark, sf)).fillna(0, ["click_ct", "display_ct"])
    return d.select("sku_id", "click_ct", "display_ct", "ts")


@register("product_union", V("SELECT * FROM product_union", "product_union"))
def product_union(spark, sf):
    """Seven-way union of conformed product measure rows."""
    return _product_union(spark, sf)


@register("product_stats", V("SELECT * FROM product_stats", "product_stats"))
def product_stats(spark, sf):
    """A2 with a 1-day window."""
    return _product_stats(spark, sf)


@register("product_stats_enriched", V("SELECT * FROM product_stats_enriched", "product_stats_enriched"))
def product_stats_enriched(spark, sf):
    """Dimension lookups after aggregation."""
    return O.enrich_product(_product_stats(spark, sf), FX.dim_sku_info(spark, sf),
                            FX.dim_spu_info(spark, sf), FX.dim_base_category3(spark, sf),
                            FX.dim_base_trademark(spark, sf))


@register("province_stats", V("SELECT * FROM province_stats", "province_stats"))
def province_stats(spark, sf):
    """A3 with a 1-day window over enriched order wide rows."""
    return A.province_stats(_enriched(spark, sf), "1 day")


# ------------------------------------------------------------ E2, E3: from changes
TRADEMARKS = """
SELECT id, CASE WHEN id % 2 = 0 THEN tm_name ELSE 'old ' || tm_name END AS tm_name FROM dim_base_trademark"""


def dwd(spark, sf, tables: tuple[str, ...]):
    """The change capture layer: raw envelopes -> normalise -> drop deletes ->
    configured routes -> one topic per fact table, one upserted table per
    dimension.  Returns a reader of either by source table name."""
    config = FX.shop_process(spark, sf, tables)
    changes = drop_deletes(normalize_changes(FX.shop_changes(spark, sf, tables)))
    rules = config.collect()  # configuration rows
    # each layer reads the changes of its own tables
    routed = {kind: route(changes.where(F.col("table_name").isin(sorted({c["source_table"] for c in rules if c["sink_type"] == kind}))),
                          config) for kind in (SINK_FACT, SINK_DIM)}
    base = scratch_path(spark, "dwd")
    K.write_routed(routed[SINK_FACT].select(
        "sink_table", F.to_json("after").alias("value"), "seq"), f"{base}/topics", keep=("seq",))
    dims = {c["sink_table"]: (c["sink_columns"].split(","), c["sink_pk"] or "id", c["source_table"])
            for c in rules if c["sink_type"] == SINK_DIM and c["operate_type"] == "insert"}
    for t, (cols, pk, _) in dims.items():
        R.create(spark, f"{base}/dim/{t}", cols, [pk])
    R.upsert_many(routed[SINK_DIM], f"{base}/dim", {t: d[:2] for t, d in dims.items()})
    topics = spark.read.schema("value string, seq bigint, sink_table string").parquet(f"{base}/topics")
    stored = {source: t for t, (_, _, source) in dims.items()}

    def read(name: str):
        schema = FX.shop_table(spark, sf, name).schema
        if name in FX.SHOP_DIMS:
            d = R.read(spark, f"{base}/dim/{stored[name]}")
        else:
            fields = ", ".join(f"`{f.name}` string" for f in schema)
            d = topics.where(F.col("sink_table") == f"dwd_{name}").select(F.from_json("value", fields).alias("r")).select("r.*")
        return d.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    return read


def _routed_wide(read):
    detail = read("order_detail").withColumn("create_ts", F.col("create_time").cast("long"))
    return O.order_wide(read("order_info"), detail, WIDE_LO, WIDE_HI)


@register("e2e_product", V(f"""
SELECT e.* EXCLUDE (tm_name), t.tm_name FROM product_stats_enriched e LEFT JOIN ({TRADEMARKS}) t ON e.tm_id = t.id""",
                           "product_stats_enriched", "dim_base_trademark"))
def e2e_product(spark, sf):
    """Change envelopes -> routing to fact topics and dimension tables ->
    order wide -> payment wide -> seven measures -> product stats per day ->
    names from the upserted dimensions."""
    read = dwd(spark, sf, (*FX.SHOP_FACTS, "sku_info", "spu_info", "base_trademark", "base_category3"))
    wide = materialize(_routed_wide(read).select(*NARROW), "dwm_order_wide")
    pay = read("payment_info")
    pay = pay.withColumn("create_ts", F.unix_millis(F.to_timestamp("create_time", "yyyy-MM-dd HH:mm:ss")))
    payments = O.payment_wide(pay, wide, PAY_LO, PAY_HI)
    measures = product_measures(FX.page_log(spark, sf), read("favor_info"), read("cart_info"), wide, payments,
                                read("order_refund_info"), read("comment_info"))
    return O.enrich_product(A.product_stats(measures, "1 day"), read("sku_info"), read("spu_info"),
                            read("base_category3").withColumnRenamed("category3_id", "id"), read("base_trademark"))


@register("e2e_province", V("SELECT * FROM province_stats", "province_stats"))
def e2e_province(spark, sf):
    """E3 in SQL: routed orders and details -> order wide -> province names
    from the upserted dimension -> daily totals."""
    read = dwd(spark, sf, ("order_info", "order_detail", "base_province"))
    names = {"wide": f"order_wide_{uuid.uuid4().hex[:8]}", "dim": f"province_{uuid.uuid4().hex[:8]}"}
    _routed_wide(read).select("province_id", "order_id", "split_total_amount", "create_ts").createOrReplaceTempView(names["wide"])
    read("base_province").createOrReplaceTempView(names["dim"])
    return spark.sql(f"""
        SELECT date_format(w.start, 'yyyy-MM-dd HH:mm:ss') AS stt, date_format(w.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
               province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
               order_count, order_amount
        FROM (SELECT window(timestamp_millis(create_ts), '1 day') AS w, province_id,
                     p.name AS province_name, p.area_code AS province_area_code, p.iso_code AS province_iso_code,
                     p.iso_3166_2 AS province_3166_2_code, count(DISTINCT order_id) AS order_count,
                     CAST(sum(split_total_amount) AS DECIMAL(18,2)) AS order_amount
              FROM {names['wide']} o LEFT JOIN {names['dim']} p ON o.province_id = p.id
              GROUP BY 1, 2, 3, 4, 5, 6)""")
