"""What one task holds follows the input, whatever the session's shuffle partitions are."""
import re

from pyspark.sql import functions as F

from tidewater.functions import keywords as KW
from tidewater.operators.joins import BROADCAST_CONF, input_bytes
from pyspark.sql import DataFrameWriter
from tidewater.operators import aggregates as A
from tidewater.operators.measures import PRODUCT_AMOUNTS, PRODUCT_COUNTS
from tidewater.operators.routing import route
from tidewater.sources import sinks as K
from tidewater.sources.changes import drop_deletes, normalize_changes
from tidewater.plans import fixtures as FX

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bus_rows_are_dealt_by_the_size_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(FX, "BUS_BYTES", 5_000)
    size = input_bytes(FX.table(spark, SF, "lineitem"))
    n = -(-size // 5_000)
    assert n > 2 * 8  # shuffle partitions of the test session
    assert "RepartitionByExpression [l_suppkey" in plan(FX.bus_raw(spark, SF))
    assert re.search(rf"RepartitionByExpression \[l_suppkey.*\], {n}", plan(FX.bus_raw(spark, SF)))


def test_grams_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(KW, "GRAMS_EACH", 4)
    spark.conf.set(BROADCAST_CONF, "0")
    try:
        df = spark.createDataFrame([(1, "人民公交站"), (2, "公交公司人民"), (3, None)], "id int, t string")
        d = spark.createDataFrame([("人民",), ("公交公司",), ("人民",)], "word string")
        got = KW.split_words(df, "t", keep=("id",), dictionary=d)
        # 11 places, words of 2 and 4 ideographs
        assert plan(got).count(", 6\n") >= 4 and "], 6" in plan(got)
        assert sorted(map(tuple, got.collect())) == sorted(
            [(1, "人民"), (1, "公"), (1, "交"), (1, "站"), (2, "公交公司"), (2, "人民")])
    finally:
        spark.conf.unset(BROADCAST_CONF)


def test_product_stats_shuffle_once_by_the_size_of_the_input(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(A, "DEALT_BYTES", 500)
    zero = [F.lit(0).cast("long").alias(c) for c in PRODUCT_COUNTS] + [
        F.lit(1).cast("decimal(18,2)").alias(c) for c in PRODUCT_AMOUNTS]
    (spark.range(5000).select((F.col("id") % 50).alias("sku_id"), (F.col("id") * 7919).alias("ts"), *zero,
                              F.when(F.col("id") % 2 == 0, F.col("id") % 20).alias("order_id"),
                              F.lit(None).cast("long").alias("paid_order_id"),
                              F.lit(None).cast("long").alias("refund_order_id")).write.parquet(tmp_dir))
    df = spark.read.parquet(tmp_dir)
    got = A.product_stats(df, "10 seconds")
    n = -(-input_bytes(df) // 500)
    assert n > 2 * 8
    physical = got._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange") == 1 and f"sku_id#" in physical and f", {n}), REPARTITION_BY_NUM" in physical
    want = df.groupBy(F.window(F.timestamp_millis("ts"), "10 seconds").alias("w"), "sku_id").agg(
        F.countDistinct("order_id").alias("order_ct"), F.sum("order_amount").cast("decimal(18,2)").alias("order_amount"))
    want = want.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("stt"), "sku_id", "order_ct", "order_amount")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_a_configuration_of_unknown_size_is_broadcast(spark):
    changes = drop_deletes(normalize_changes(FX.shop_changes(spark, SF, ("order_info", "base_province"))))
    routed = route(changes, FX.shop_process(spark, SF, ("order_info", "base_province")))
    physical = routed._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical


def test_topics_are_written_without_a_sort(spark, monkeypatch, tmp_dir):
    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(K.OPEN_CONF)), write(self, *a, **k))[1])
    before = spark.conf.get(K.OPEN_CONF)
    rows = spark.range(40).select(F.concat(F.lit("t"), F.col("id") % 20).alias("sink_table"), F.col("id").cast("string").alias("value"))
    K.write_routed(rows.coalesce(1), tmp_dir)  # more topics than are kept open
    assert seen == [str(K.OPEN_TOPICS)] and spark.conf.get(K.OPEN_CONF) == before
    back = spark.read.parquet(tmp_dir).select("sink_table", "value")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
