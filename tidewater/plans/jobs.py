"""Deployable streaming jobs: the reference's applications as Structured
Streaming queries built from the library's operators.

Jobs talk through topics, as in the reference: a ``Topic`` is a Kafka topic
(JSON values) or, for tests and file-based deployments, a folder of parquet
files (typed, exactly-once through the file sink's commit log).  Every query
has its own checkpoint folder; outputs written in ``foreachBatch`` are
idempotent by batch id, so a restarted or retried batch does not duplicate
rows.

Layers (reference job -> function):
ODS change capture -> ``ods_changes``; DWD log split -> ``log_split``; DWD
routing -> ``db_routing``; DWM unique visits / bounces / order wide / payment
wide -> ``unique_visit``, ``user_jump``, ``order_wide``, ``payment_wide``; DWS
subject tables -> ``visitor_stats``, ``product_stats``, ``province_stats``,
``keyword_stats``; traffic -> ``overspeed``, ``danger_drive``,
``repeat_plates``, ``avg_speed``, ``car_count``, ``top_monitors``,
``police_dispatch``, ``police_connect``; listings -> ``listings``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.keywords import split_words_sql
from ..operators import aggregates as A
from ..operators import listings as LS
from ..operators import logs as L
from ..operators import orders as O
from ..operators.joins import overspeed as overspeed_rows, with_speed_limit
from ..operators.measures import product_measures, visitor_measures
from ..operators.patterns import top_monitors as rank_monitors
from ..operators.routing import SINK_DIM, route, split_routes
from ..schemas import PAGE_LOG, PAGE_VIEW_MAPS
from ..sources import runs as R
from ..sources import sinks as K
from ..sources.changes import drop_deletes, normalize_changes, read_changes
from ..sources.config import PolledTable
from ..sources.lines import parse_car_lines, read_json_table, read_lines
from ..sources.snapshot import SnapshotThenChanges, SourceTable
from ..streaming import forms as SF
from ..streaming import stateful as ST
from ..streaming.routing import route_as_of_stream


@dataclass
class Topic:
    """A hand-off between jobs: Kafka topic ``name`` (JSON values) when
    ``kafka_servers`` is set, else a parquet folder ``name`` (or a text folder
    with ``fmt='text'`` for raw lines).

    File topics are exactly-once (file sink commit log, batch-id partitions);
    the Kafka sink is at-least-once, so consumers of Kafka topics rely on the
    keyed, idempotent operators downstream (upserts, first-per-key).  A Kafka
    source's ``seq`` is the partition offset: it orders the rows of one
    partition, i.e. of one key when producers key by it."""

    name: str
    schema: T.StructType | None = None
    kafka_servers: str | None = None
    fmt: str = "parquet"
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None   # bounds the micro-batch of a Kafka backlog

    def read(self, spark: SparkSession) -> DataFrame:
        if self.kafka_servers:
            limit = {"maxOffsetsPerTrigger": self.max_offsets_per_trigger} if self.max_offsets_per_trigger else {}
            lines = read_lines(spark, self.name, streaming=True, kafka_servers=self.kafka_servers, **limit)
            if self.fmt == "text" or self.schema is None:
                return lines
            return lines.select(F.from_json("value", self.schema).alias("_r")).select("_r.*")
        r = spark.readStream
        if self.max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", self.max_files_per_trigger)
        if self.fmt == "text":
            return r.format("text").load(self.name)
        return r.schema(self.schema).parquet(self.name)

    def write(self, df: DataFrame, checkpoint: str, trigger: dict | None = None,
              mode: str = "append") -> StreamingQuery:
        if self.kafka_servers:
            w = (df.select(F.to_json(F.struct(*df.columns)).alias("value")).writeStream
                   .format("kafka").option("kafka.bootstrap.servers", self.kafka_servers)
                   .option("topic", self.name))
            return (w.outputMode(mode).option("checkpointLocation", checkpoint)
                     .trigger(**(trigger or {"availableNow": True})).start())
        return SF.start(df, checkpoint, self.name, fmt=self.fmt, mode=mode, trigger=trigger)

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Write one micro-batch (inside ``foreachBatch``), idempotently."""
        if self.kafka_servers:
            K.write_lines(df, self.name, kafka_servers=self.kafka_servers)
        else:
            K.write_once(df, self.name, batch_id)


def _trigger(t):
    return t or {"availableNow": True}


def with_seq(df: DataFrame, ts_ms, value: str = "value") -> DataFrame:
    """The arrival sequence: the source's ``seq`` (Kafka offset, or a column of
    the topic) when present; otherwise the event time in millis, with a hash of
    the line only to tell rows of one millisecond apart."""
    if "seq" in df.columns:
        return df
    return df.withColumn("seq", ts_ms * 1000 + F.pmod(F.xxhash64(F.col(value)), F.lit(1000)))


# ------------------------------------------------------------------ ODS / DWD
def ods_changes(spark, raw: Topic, out: Topic, checkpoint: str, trigger=None, databases: Sequence[str] | None = None,
                tables: Sequence[str] | None = None) -> StreamingQuery:
    """ODS: capture records -> normalised change envelopes of the allowed tables."""
    return out.write(read_changes(normalize_changes(raw.read(spark)), databases, tables, startup="latest"), checkpoint, trigger)


def ods_snapshot(spark, raw: Topic, out: Topic, checkpoint: str, source: Sequence[SourceTable], trigger=None,
                 databases: Sequence[str] | None = None, tables: Sequence[str] | None = None, chunks_per_step: int = 1,
                 log_end: Callable[[SparkSession], int] | None = None) -> tuple[StreamingQuery, SnapshotThenChanges]:
    """ODS from the initial state: the tables of ``source`` chunk by chunk as
    ``read`` changes while their changes are consumed.  The second value goes on
    without new changes (``drain``) and says whether the snapshot is out.
    ``log_end`` is needed where the topic is no folder."""
    def end(s: SparkSession) -> int:
        top = s.read.schema(raw.schema).parquet(raw.name).agg(F.max("seq")).first()[0]
        return -1 if top is None else top

    if log_end is None and raw.kafka_servers:
        raise ValueError("a Kafka topic needs log_end: the highest sequence number in the log")
    handler = SnapshotThenChanges(source, out.write_batch, log_end or end, f"{checkpoint}/snapshot", databases, tables,
                                  chunks_per_step)
    return SF.start(normalize_changes(raw.read(spark)), f"{checkpoint}/changes", handler, trigger=_trigger(trigger)), handler


def log_split(spark, raw: Topic, start: Topic, page: Topic, display: Topic, dirty: Topic,
              checkpoint: str, trigger=None) -> list[StreamingQuery]:
    """DWD behaviour log: parse (dirty lines to their own topic), repair the
    new-visitor flag per device, split start / page / display records."""
    lines = raw.read(spark)
    keep = tuple(c for c in ("seq", "value") if c in lines.columns)
    good, bad = L.split_dirty(lines, PAGE_LOG, keep=keep)
    q_dirty = dirty.write(bad.select("value"), f"{checkpoint}/dirty", trigger)
    good = with_seq(good, F.col("ts"))
    flat = good.withColumn("mid", F.col("common.mid")).withColumn("is_new", F.col("common.is_new"))
    fixed = (ST.fix_is_new_stream(flat)
               .withColumn("value", L.with_flag(F.col("value"), F.col("common.is_new"), F.col("is_new")))
               .withColumn("common", F.col("common").withField("is_new", F.col("is_new")))
               .drop("mid", "is_new"))

    def fan_out(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the stateful plan runs once for three topics
        try:
            st, pg = L.split_logs(batch)
            start.write_batch(st, batch_id)
            page.write_batch(pg, batch_id)
            display.write_batch(L.explode_displays(pg, record="value"), batch_id)
        finally:
            batch.unpersist()

    q_main = SF.start(fixed, f"{checkpoint}/main", fan_out, trigger=_trigger(trigger))
    return [q_dirty, q_main]


def db_routing(spark, changes: Topic, config: PolledTable, fact: Topic, dim_target: str,
               checkpoint: str, trigger=None) -> StreamingQuery:
    """DWD database changes: drop deletes, route by the (polled) config table.
    Fact rows go to the topic of their sink table (``fact.name`` is the folder
    above the topics); each configured dimension table is created below
    ``dim_target`` when its configuration is first seen and upserted by its
    configured key (``id`` by default), all of them in one pass."""
    created: set[str] = set()

    def handle(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        rules = config.get(s)
        routed = route(drop_deletes(batch), rules).persist()
        try:
            f, d = split_routes(routed)
            K.write_routed(f.select("sink_table", F.to_json("after").alias("value"), "seq"), fact.name,
                           kafka_servers=fact.kafka_servers, batch_id=batch_id, keep=("seq",))
            tables = {}
            for c in rules.where(F.col("sink_type") == SINK_DIM).groupBy("sink_table").agg(  # configuration rows
                    F.first("sink_pk", ignorenulls=True).alias("pk"),
                    F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split("sink_columns", ","))))).alias("cols")).collect():
                pk = c["pk"] or "id"
                tables[c["sink_table"]] = ([x.strip() for x in c["cols"] if x.strip() != pk], pk)
                if c["sink_table"] not in created:
                    R.create(s, f"{dim_target}/{c['sink_table']}", tables[c["sink_table"]][0], [pk])
                    created.add(c["sink_table"])
            R.upsert_many(d, dim_target, tables, batch_id=batch_id)
        finally:
            routed.unpersist()
    return SF.start(changes.read(spark), checkpoint, handle, trigger=_trigger(trigger))


def db_routing_as_of(spark, changes: Topic, config: Topic, fact: Topic, dim_target: str, checkpoint: str,
                     wait: bool = False, slots: int = 8, trigger=None) -> StreamingQuery:
    """``db_routing`` with the configuration as a change stream (``config``:
    change rows with ``type, seq`` and the columns of a route): every change is
    routed by the version that held at its sequence number.  ``wait``: changes
    ahead of their first route wait for it instead of being dropped."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        batch = batch.persist()
        try:
            f, d = split_routes(batch)
            K.write_routed(f.select("sink_table", F.to_json("after").alias("value"), "seq"), fact.name,
                           kafka_servers=fact.kafka_servers, batch_id=batch_id, keep=("seq",))
            seen: dict[str, tuple[list[str], str]] = {}
            for c in d.select("sink_table", "sink_pk", "sink_columns").distinct().collect():  # routes, not rows
                cols, pk = seen.setdefault(c["sink_table"], ([], c["sink_pk"] or "id"))
                cols += [x.strip() for x in c["sink_columns"].split(",") if x.strip() not in (pk, *cols)]
            for t, (cols, pk) in seen.items():
                R.create(s, f"{dim_target}/{t}", cols, [pk])
            R.upsert_many(d, dim_target, seen, batch_id=batch_id)
        finally:
            batch.unpersist()

    routed = route_as_of_stream(drop_deletes(changes.read(spark)), config.read(spark), wait, slots=slots)
    return SF.start(routed, checkpoint, handle, trigger=_trigger(trigger))


# ------------------------------------------------------------------------ DWM
def _flat_pages(pages: DataFrame) -> DataFrame:
    return pages.withColumn("mid", F.col("common.mid"))


def unique_visit(spark, page: Topic, out: Topic, checkpoint: str, delay: str = "0 seconds",
                 trigger=None) -> StreamingQuery:
    """DWM unique visits: first entry page per device and day."""
    # watermark on the whole page stream (before the entry filter), as at the source
    p = SF.watermarked(_flat_pages(page.read(spark)), "ts", delay, "et").where(L.is_entry())
    uv = ST.unique_visits_stream(p).drop("mid", "et")
    return out.write(uv, checkpoint, trigger)


def user_jump(spark, page: Topic, out: Topic, checkpoint: str, within_ms: int = 10_000,
              delay: str = "2 seconds", trigger=None) -> StreamingQuery:
    """DWM bounces: entry pages followed by another entry (or nothing)
    within ``within_ms``; the full page record is carried through."""
    p = page.read(spark)
    rec_schema = p.schema
    flat = (SF.watermarked(_flat_pages(p), "ts", delay, "et")
              .withColumn("entry", L.is_entry())
              .withColumn("page_id", F.col("page.page_id"))
              .withColumn("payload", F.to_json(F.struct(*[F.col(c) for c in p.columns]))))
    b = ST.bounces_stream(flat, within_ms, payload=True)
    return out.write(b.select(F.from_json("payload", rec_schema).alias("r")).select("r.*"), checkpoint, trigger)


Dim = DataFrame | R.DimReader


def _dim(dim: Dim, spark: SparkSession, ids: DataFrame | None = None) -> DataFrame:
    """A dimension as of now: a static frame as it is, else the newest version (cut down to ``ids``)."""
    return dim.get(spark, ids) if isinstance(dim, R.DimReader) else dim


def order_wide(spark, orders: Topic, details: Topic, dims: dict[str, Dim], out: Topic,
               checkpoint: str, lo_ms: int = -20_000, hi_ms: int = 20_000, delay: str = "0 seconds",
               trigger=None) -> StreamingQuery:
    """DWM order wide: orders x details within [lo, hi] (stream-stream join,
    watermarked), then the six dimension lookups: per micro-batch against the
    newest version of dimensions given as ``DimReader``, or against static tables."""
    o = SF.watermarked(O.order_times(orders.read(spark)).withColumnRenamed("id", "order_id"),
                       "create_ts", delay, "o_et")
    d = SF.watermarked(details.read(spark).select(
        F.col("id").alias("detail_id"), F.col("order_id").alias("d_order_id"),
        F.col("create_ts").alias("detail_ts"), *O.DETAIL_COLS), "detail_ts", delay, "d_et")
    j = (SF.interval_join_stream(o.withColumnRenamed("order_id", "k"),
                                 d.withColumnRenamed("d_order_id", "k"), ["k"], "o_et", "d_et", lo_ms, hi_ms)
           .select(F.col("detail_id"), F.col("l.k").alias("order_id"), *O.DETAIL_COLS, *O.ORDER_COLS))
    names = ("user", "province", "sku", "spu", "trademark", "category")
    if not any(isinstance(dims[n], R.DimReader) for n in names):
        return out.write(O.enrich_order(j, *[dims[n] for n in names]), checkpoint, trigger)

    def enrich(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # looked up by three ids
        try:
            ids = {"user": "user_id", "province": "province_id", "sku": "sku_id"}
            now = [_dim(dims[n], batch.sparkSession, batch.select(ids[n]) if n in ids else None) for n in names]
            out.write_batch(O.enrich_order(batch, *now), batch_id)
        finally:
            batch.unpersist()
    return SF.start(j, checkpoint, enrich, trigger=_trigger(trigger))


def payment_wide(spark, payments: Topic, wide: Topic, out: Topic, checkpoint: str,
                 lo_ms: int = -15 * 60_000, hi_ms: int = 5_000, delay: str = "0 seconds",
                 trigger=None) -> StreamingQuery:
    """DWM payment wide: payments x order wide rows, order time within
    [pay + lo, pay + hi]."""
    p = SF.watermarked(payments.read(spark).select(
        F.col("id").alias("payment_id"), F.col("order_id").alias("k"),
        F.col("user_id").alias("pay_user_id"), F.col("total_amount").alias("pay_total_amount"),
        "subject", "payment_type", "callback_time", F.col("create_time").alias("payment_create_time"),
        F.col("create_ts").alias("payment_create_ts")), "payment_create_ts", delay, "p_et")
    w = SF.watermarked(wide.read(spark), "create_ts", delay, "w_et").withColumnRenamed("order_id", "k")
    j = SF.interval_join_stream(p, w, ["k"], "p_et", "w_et", lo_ms, hi_ms)
    keep = [c for c in wide.schema.names if c not in ("order_id", "user_id", "total_amount", "create_time")]
    return out.write(j.select("payment_id", F.col("l.k").alias("order_id"),
                              F.col("pay_user_id").alias("user_id"),
                              F.col("pay_total_amount").alias("total_amount"), "subject", "payment_type",
                              "callback_time", "payment_create_time", "payment_create_ts",
                              F.col("create_time").alias("order_create_time"), *keep,
                              F.lit(None).cast("decimal(18,2)").alias("split_feight_fee")),
                     checkpoint, trigger)


# ------------------------------------------------------------------------ DWS
def visitor_stats(spark, uv: Topic, uj: Topic, page: Topic, out: Topic, checkpoint: str,
                  size: str = "10 seconds", delay: str = "1 second", trigger=None) -> StreamingQuery:
    """DWS visitor table: conformed UV / bounce / page rows, tumbling window."""
    m = visitor_measures(uv.read(spark), uj.read(spark), page.read(spark))
    stats = A.visitor_stats(SF.watermarked(m, "ts", delay, "et"), size, event_col="et")
    return out.write(stats, checkpoint, trigger)


def product_stats(spark, page: Topic, favor: Topic, cart: Topic, wide: Topic, payments: Topic,
                  refund: Topic, comment: Topic, dims: dict[str, Dim], out: Topic,
                  checkpoint: str, size: str = "10 seconds", delay: str = "2 seconds",
                  trigger=None, approx: bool = False) -> StreamingQuery:
    """DWS product table: seven measure streams, tumbling window per sku,
    names added per closed window from the dimensions as they are by then
    (``DimReader``) or from static tables.  ``approx`` keeps HyperLogLog
    sketches instead of the ids seen per group."""
    m = product_measures(page.read(spark), favor.read(spark), cart.read(spark), wide.read(spark),
                         payments.read(spark), refund.read(spark), comment.read(spark))
    stats = A.product_stats(SF.watermarked(m, "ts", delay, "et"), size, event_col="et",
                            approx=approx)

    def enrich(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            sku = _dim(dims["sku"], batch.sparkSession, batch.select("sku_id"))
            out.write_batch(O.enrich_product(batch, sku, *[_dim(dims[n], batch.sparkSession) for n in (
                "spu", "category", "trademark")]), batch_id)
        finally:
            batch.unpersist()
    return SF.start(stats, checkpoint, enrich, trigger=_trigger(trigger))


def province_stats(spark, wide: Topic, out: Topic, checkpoint: str, size: str = "10 seconds",
                   delay: str = "1 second", trigger=None, approx: bool = False) -> StreamingQuery:
    """DWS province table from the order wide stream (``approx``: sketch state)."""
    w = SF.watermarked(wide.read(spark), "create_ts", delay, "et")
    return out.write(A.province_stats(w, size, event_col="et", approx=approx),
                     checkpoint, trigger)


def keyword_stats(spark, page_lines: Topic, out: Topic, checkpoint: str, size: str = "10 seconds",
                  view: str = "page_view", trigger=None) -> StreamingQuery:
    """DWS keyword table in SQL: the page log lines declared as a table with
    map columns and ``rt - 1 s`` watermark (S2), filtered to searches, split
    with LATERAL VIEW, counted per tumbling window."""
    rt = F.to_timestamp(F.from_unixtime((F.col("ts") / 1000).cast("long")))
    read_json_table(page_lines.read(spark), PAGE_VIEW_MAPS, rt, "1 second", view=view)
    q = spark.sql(f"""
        SELECT 'search' AS source, date_format(w.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(w.end, 'yyyy-MM-dd HH:mm:ss') AS edt, word AS keyword, ct
        FROM (SELECT window(rt, '{size}') AS w, word, count(*) AS ct
              FROM (SELECT word, rt FROM {view}
                    LATERAL VIEW explode({split_words_sql("page['item']")}) t AS word
                    WHERE page['last_page_id'] = 'search' AND page['item'] IS NOT NULL)
              GROUP BY window(rt, '{size}'), word)""")
    return out.write(q, checkpoint, trigger)


# -------------------------------------------------------------------- traffic
def _cars(spark, lines: Topic) -> DataFrame:
    """Parsed car passages with event time.  Without a source sequence the
    arrival order inside a micro-batch is taken as the passage time (ties
    broken by a hash of the line)."""
    raw = lines.read(spark)
    has_seq = "seq" in raw.columns
    if not has_seq:
        raw = raw.withColumn("_h", F.pmod(F.xxhash64("value"), F.lit(1000)))
    c = parse_car_lines(raw, keep=("seq",) if has_seq else ("_h",))
    t = F.try_to_timestamp("action_time", F.lit("yyyy-MM-dd HH:mm:ss"))
    # a line without a readable time has no place on the clock: see dirty_cars
    c = c.withColumn("ts", t).withColumn("ts_ms", F.unix_millis(t)).where("ts is not null")
    return c if has_seq else c.withColumn("seq", F.col("ts_ms") * 1000 + F.col("_h")).drop("_h")


def dirty_cars(spark, lines: Topic, out: Topic, checkpoint: str, trigger=None) -> StreamingQuery:
    """The lines that the traffic jobs cannot use: no readable time or speed."""
    raw = lines.read(spark)
    c = parse_car_lines(raw, keep=("value",))
    bad = F.try_to_timestamp("action_time", F.lit("yyyy-MM-dd HH:mm:ss")).isNull() | F.col("speed").isNull()
    return out.write(c.where(bad).select("value"), checkpoint, trigger)


def overspeed(spark, lines: Topic, limits: PolledTable, out: Topic, checkpoint: str,
              trigger=None) -> StreamingQuery:
    """Overspeed alerts against a limit table re-read every ``ttl``."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        out.write_batch(overspeed_rows(batch, limits.get(batch.sparkSession)), batch_id)
    return SF.start(_cars(spark, lines), checkpoint, handle, trigger=_trigger(trigger))


def danger_drive(spark, lines: Topic, limits: DataFrame, out: Topic, checkpoint: str,
                 within_ms: int = 10_000, delay: str = "5 seconds", trigger=None) -> StreamingQuery:
    """Three overspeed passages of one car within ``within_ms``."""
    cars = _cars(spark, lines).withColumn("et", F.col("ts")).withWatermark("et", delay)  # at the source
    over = (with_speed_limit(cars, limits)
            .where(F.col("speed") > F.col("limit_speed") * 1.2)
            .select("car_id", F.col("ts_ms").alias("ts"), "seq", "action_time", "et"))
    return out.write(ST.danger_drive_stream(over, within_ms), checkpoint, trigger)


def repeat_plates(spark, lines: Topic, out: Topic, checkpoint: str, within_ms: int = 10_000,
                  trigger=None) -> StreamingQuery:
    """Duplicate plates: passages within ``within_ms`` of the plate's latest."""
    c = _cars(spark, lines).select("car_id", F.col("ts_ms").alias("ts"), "seq", "action_time")
    return out.write(ST.repeat_plates_stream(c, within_ms), checkpoint, trigger)


def avg_speed(spark, lines: Topic, out: Topic, checkpoint: str, size: str = "5 minutes",
              slide: str = "1 minute", delay: str = "1 second", trigger=None) -> StreamingQuery:
    """Sliding average speed per monitor (event time, D11)."""
    c = _cars(spark, lines).withWatermark("ts", delay)
    return out.write(A.avg_speed(c, size, slide), checkpoint, trigger)


def car_count(spark, lines: Topic, out: Topic, checkpoint: str, size: str = "1 minute",
              delay: str = "1 second", approx: bool = False, trigger=None) -> StreamingQuery:
    """Distinct cars per area and tumbling window."""
    c = _cars(spark, lines).withWatermark("ts", delay)
    return out.write(A.car_count(c, size, approx=approx), checkpoint, trigger)


def top_monitors(spark, lines: Topic, out: Topic, checkpoint: str, n: int = 5,
                 size: str = "5 minutes", slide: str = "1 minute", delay: str = "1 second",
                 trigger=None) -> StreamingQuery:
    """Speed bands per monitor and sliding window; the closed windows of each
    batch ranked and the first ``n`` written."""
    bands = A.speed_bands(_cars(spark, lines).withWatermark("ts", delay), size, slide)

    def handle(batch: DataFrame, batch_id: int) -> None:
        out.write_batch(rank_monitors(batch, n, window_cols=("stt", "edt")), batch_id)
    return SF.start(bands, checkpoint, handle, trigger=_trigger(trigger))


def _violations(spark, lines: Topic, names: tuple[str, ...], time_col: str, delay: str) -> DataFrame:
    parts = F.split("value", ",")
    d = lines.read(spark).select("*", *[F.get(parts, i).alias(n) for i, n in enumerate(names)])
    t = F.try_to_timestamp(F.col(time_col), F.lit("yyyy-MM-dd HH:mm:ss"))
    d = d.withColumn("et", t).withColumn("ts", F.unix_millis(t)).where("et is not null")
    return with_seq(d, F.col("ts")).select("seq", *names, "et", "ts").withWatermark("et", delay)


def police_dispatch(spark, violations: Topic, police: Topic, out: Topic, checkpoint: str,
                    within_ms: int = 10_000, delay: str = "3 seconds", trigger=None) -> StreamingQuery:
    """Violations x dispatches of the same car within +-``within_ms``."""
    v = _violations(spark, violations, ("car_id", "violation", "create_time", "description"),
                    "create_time", delay)
    p = _violations(spark, police, ("police_id", "car_id", "action_time", "status"), "action_time", delay)
    j = SF.interval_join_stream(v, p, ["car_id"], "et", "et", -within_ms, within_ms)
    # fixed values: the dispatch report text of the reference
    text = F.concat(F.lit("车辆："), F.col("l.car_id"), F.lit("，违法时间："), F.col("l.create_time"),
                    F.lit("，出警时间："), F.col("r.action_time"), F.lit("，处理状态：成功"))
    return out.write(j.select(F.col("l.car_id").alias("car_id"), F.col("l.create_time").alias("create_time"),
                              F.col("r.action_time").alias("action_time"), text.alias("result")),
                     checkpoint, trigger)


def police_connect(spark, violations: Topic, police: Topic, out: Topic, checkpoint: str,
                   wait_ms: int = 5_000, delay: str = "3 seconds", trigger=None) -> StreamingQuery:
    """Match-or-timeout of violations and dispatches per car (timers)."""
    v = _violations(spark, violations, ("car_id", "violation", "create_time", "description"),
                    "create_time", delay)
    p = _violations(spark, police, ("police_id", "car_id", "action_time", "status"), "action_time", delay)
    return out.write(ST.match_or_timeout_stream(v, p, "car_id", "et", wait_ms, None), checkpoint, trigger)


# ------------------------------------------------------------------- listings
CLEANERS: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "bus": (LS.clean_bus, "address"),
    "hotel": (LS.clean_hotel, "analysis_address"),
    "sight": (LS.clean_sight, "clean_address"),
}


def listings(spark, kind: str, rows: Topic, gazetteer: DataFrame, target: str, checkpoint: str,
             trigger=None) -> StreamingQuery:
    """Listing after-images (bus / hotel / sight rows): clean, skip keys an
    earlier batch already produced, geocode with fallback, keep rows with
    coordinates.  A key is remembered once it was located, so a listing that
    was not is tried again when it comes back.  Change envelopes are mapped to
    after-images upstream."""
    clean, key = CLEANERS[kind]

    def handle(batch: DataFrame, batch_id: int) -> None:
        fresh = SF.unseen_rows(clean(batch), f"{target}/_keys", batch_id)
        located = LS.locate(fresh, gazetteer, key).persist()
        try:
            K.write_once(located, f"{target}/rows", batch_id)
            SF.record_keys(located, f"{target}/_keys", batch_id)
        finally:
            located.unpersist()
    return SF.start(rows.read(spark), checkpoint, handle, trigger=_trigger(trigger))
