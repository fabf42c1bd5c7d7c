"""Conformed measure rows for the subject tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .logs import is_entry

VISITOR_KEYS = ("vc", "ch", "ar", "is_new")
VISITOR_MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")


def _visitor_row(df: DataFrame, uv, pv, sv, uj, dur) -> DataFrame:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    measures = dict(zip(VISITOR_MEASURES, (uv, pv, sv, uj, dur)))
    return df.select(*[F.col(f"common.{k}").alias(k) for k in VISITOR_KEYS],
                     *[as_col(v).cast("long").alias(n) for n, v in measures.items()],
                     F.col("ts"))


def visitor_measures(uv: DataFrame | None, uj: DataFrame | None, pv: DataFrame | None) -> DataFrame:
    """P9 + U2: unique-visit, bounce and page rows in one measure schema
    (any input may be None).

    PV row: pv=1, sv=1 when it is an entry page, dur=during_time.
    """
    parts = []
    if uv is not None:
        parts.append(_visitor_row(uv, 1, 0, 0, 0, 0))
    if uj is not None:
        parts.append(_visitor_row(uj, 0, 0, 0, 1, 0))
    if pv is not None:
        parts.append(_visitor_row(pv, 0, 1, F.when(is_entry("page.last_page_id"), 1).otherwise(0), 0,
                                  F.col("page.during_time")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


PRODUCT_COUNTS = ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
                  "comment_ct", "good_comment_ct")
PRODUCT_AMOUNTS = ("order_amount", "payment_amount", "refund_amount")
APPRAISE_GOOD = "1201"  # fixed value: code table, "good" appraisal


def clicks_and_displays(page_df: DataFrame) -> DataFrame:
    """P10 (page part): a click per ``good_detail`` page on a sku item and a
    display per displayed sku item; page records only.  One pass: each page
    row becomes an array of measure rows (its click, its sku displays) that
    is exploded."""
    one = lambda c: F.lit(c).cast("long")
    zero_or_null = F.lit(None).cast("long")
    click = F.when((F.col("page.page_id") == "good_detail") & (F.col("page.item_type") == "sku_id"),
                   F.array(F.struct(F.col("page.item").try_cast("long").alias("sku_id"),
                                    one(1).alias("click_ct"), zero_or_null.alias("display_ct"))))
    shown = F.transform(F.filter(F.coalesce(F.col("displays"), F.array()), lambda d: d["item_type"] == "sku_id"),
                        lambda d: F.struct(d["item"].try_cast("long").alias("sku_id"), zero_or_null.alias("click_ct"),
                                           one(1).alias("display_ct")))
    empty = F.array().cast("array<struct<sku_id:bigint,click_ct:bigint,display_ct:bigint>>")
    events = F.concat(F.coalesce(click, empty), shown)
    return page_df.select("ts", F.explode(events).alias("_m")).select("_m.sku_id", "_m.click_ct",
                                                                      "_m.display_ct", "ts")


def product_measures(page_df: DataFrame, favor: DataFrame, cart: DataFrame, order_wide: DataFrame,
                     payment_wide: DataFrame, refund: DataFrame, comment: DataFrame) -> DataFrame:
    """P10 + U3: seven inputs in one measure schema; missing measures are 0 and
    the id columns feed the distinct counts (order, paid order, refund)."""
    text_ms = lambda c: F.col(c).try_cast("long")  # numeric text -> millis
    parts = [
        clicks_and_displays(page_df),
        favor.select("sku_id", F.lit(1).cast("long").alias("favor_ct"), text_ms("create_time").alias("ts")),
        cart.select("sku_id", F.lit(1).cast("long").alias("cart_ct"), text_ms("create_time").alias("ts")),
        order_wide.select("sku_id", F.col("sku_num").alias("order_sku_num"),
                          F.col("order_price").alias("order_amount"),
                          F.col("order_id").alias("order_id"), F.col("create_ts").alias("ts")),
        payment_wide.select("sku_id", F.col("order_price").alias("payment_amount"),
                            F.col("order_id").alias("paid_order_id"),
                            F.col("payment_create_ts").alias("ts")),
        refund.select("sku_id", F.col("refund_amount"), F.col("id").alias("refund_order_id"),
                      text_ms("create_time").alias("ts")),
        comment.select("sku_id", F.lit(1).cast("long").alias("comment_ct"),
                       F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0).cast("long").alias("good_comment_ct"),
                       text_ms("create_time").alias("ts")),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    fill = {c: 0 for c in PRODUCT_COUNTS}
    u = u.fillna(fill)
    for c in PRODUCT_AMOUNTS:
        u = u.withColumn(c, F.coalesce(F.col(c).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")))
    return u
