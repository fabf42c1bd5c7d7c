"""Order / payment wide-table assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import age_years, interval_join, lookup, total_bytes

ORDER_COLS = ("province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
              "coupon_reduce_amount", "original_total_amount", "feight_fee", "expire_time",
              "create_time", "operate_time", "create_date", "create_hour", "create_ts")
DETAIL_COLS = ("sku_id", "order_price", "sku_num", "sku_name", "split_activity_amount",
               "split_coupon_amount", "split_total_amount")


def order_times(df: DataFrame, time_col: str = "create_time") -> DataFrame:
    """Date, hour and epoch millis of a creation time given as epoch
    millis (number or text) or as ``yyyy-MM-dd HH:mm:ss``; null when neither."""
    c = F.col(time_col).cast("string")
    t = F.coalesce(F.timestamp_millis(c.try_cast("long")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")))
    return (df.withColumn("create_date", F.date_format(t, "yyyy-MM-dd"))
              .withColumn("create_hour", F.date_format(t, "HH"))
              .withColumn("create_ts", F.unix_millis(t)))


def order_wide(order_info: DataFrame, order_detail: DataFrame, lo: int = -20_000,
               hi: int = 20_000) -> DataFrame:
    """J1 + P12: orders x details on order id with the detail time in
    ``[order time + lo, order time + hi]``; one wide row per pair."""
    o = order_times(order_info).select(F.col("id").alias("order_id"), *ORDER_COLS)
    d = order_detail.select(F.col("id").alias("detail_id"), "order_id",
                            F.col("create_ts").alias("detail_ts"), *DETAIL_COLS)
    j = interval_join(o, d, ["order_id"], "create_ts", "detail_ts", lo, hi)
    return j.select("detail_id", "order_id", *DETAIL_COLS, *ORDER_COLS)


def merge_wide(df: DataFrame, first: str, second: str, columns: Sequence[str],
               keep: Sequence[str] = ()) -> DataFrame:
    """First-non-null merge of two wide rows held as structs
    ``first`` and ``second``."""
    return df.select(*keep, *[F.coalesce(F.col(f"{first}.{c}"), F.col(f"{second}.{c}")).alias(c)
                       for c in columns])


def sku_dimension(sku: DataFrame, spu: DataFrame, trademark: DataFrame,
                  category: DataFrame) -> DataFrame:
    """The sku dimension with its spu / trademark / category names resolved
    on the dimension side (D3: through the sku's ids), so a fact table is
    joined once on ``sku_id`` instead of four times."""
    d = sku.select(F.col("id"), "sku_name", "sku_price", "spu_id", "tm_id", "category3_id")
    d = lookup(d, spu, "spu_id", {"spu_name": "spu_name"})
    d = lookup(d, trademark, "tm_id", {"tm_name": "tm_name"})
    return lookup(d, category, "category3_id", {"name": "category3_name"})


def enrich_order(wide: DataFrame, user: DataFrame, province: DataFrame, sku: DataFrame,
                 spu: DataFrame, trademark: DataFrame, category: DataFrame) -> DataFrame:
    """Six dimension lookups; spu / trademark / category use the ids found
    in the sku row (resolved on the sku dimension first, so the order rows are
    joined three times, not six).  Age: whole 365-day years at the order date
    (D2)."""
    w = lookup(wide, user, "user_id", {"gender": "user_gender", "birthday": "_tw_birthday"})
    w = w.withColumn("user_age", age_years(F.col("_tw_birthday"), F.to_date("create_date"))).drop("_tw_birthday")
    w = lookup(w, province, "province_id", {"name": "province_name", "area_code": "province_area_code",
                                            "iso_code": "province_iso_code",
                                            "iso_3166_2": "province_3166_2_code"})
    return lookup(w, sku_dimension(sku, spu, trademark, category), "sku_id",
                  ["spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"],
                  size_bytes=total_bytes(sku, spu, trademark, category))


def payment_wide(payment: DataFrame, wide: DataFrame, lo: int = -15 * 60_000,
                 hi: int = 5_000) -> DataFrame:
    """J2 + P13: payments x order wide rows on order id with the order time in
    ``[pay time + lo, pay time + hi]``.  Same-named order columns are copied,
    payment columns take precedence (order id, user id, total amount)."""
    p = payment.select(F.col("id").alias("payment_id"), "order_id",
                       F.col("user_id").alias("_tw_pay_user"),
                       F.col("total_amount").alias("_tw_pay_total"),
                       "subject", "payment_type", "callback_time",
                       F.col("create_time").alias("payment_create_time"),
                       F.col("create_ts").alias("payment_create_ts"))
    w = wide.withColumnRenamed("create_time", "order_create_time")
    j = interval_join(p, w, ["order_id"], "payment_create_ts", "create_ts", lo, hi)
    keep = [c for c in w.columns if c not in ("order_id", "user_id", "total_amount")]
    # The split freight fee is part of the wide row but never filled
    return j.select("payment_id", "order_id", F.col("_tw_pay_user").alias("user_id"),
                    F.col("_tw_pay_total").alias("total_amount"), "subject", "payment_type",
                    "callback_time", "payment_create_time", "payment_create_ts", *keep,
                    F.lit(None).cast("decimal(18,2)").alias("split_feight_fee"))


def enrich_product(stats: DataFrame, sku: DataFrame, spu: DataFrame, category: DataFrame,
                   trademark: DataFrame) -> DataFrame:
    """After aggregation, sku -> spu -> category -> trademark (D3: the spu
    is found through the sku's spu id); one join of the stats on ``sku_id``."""
    return lookup(stats, sku_dimension(sku, spu, trademark, category), "sku_id",
                  ["sku_name", "sku_price", "spu_id", "tm_id", "category3_id", "spu_name",
                   "category3_name", "tm_name"], size_bytes=total_bytes(sku, spu, trademark, category))
