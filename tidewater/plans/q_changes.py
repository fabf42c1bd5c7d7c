"""Change-capture keys: S3-S6, P2, P6, P7, K1-K6."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.routing import config_versions, route, route_as_of, split_routes
from ..session import materialize, scratch_path
from ..sources import sinks as K
from ..sources import transactional as TX
from ..sources.changes import apply_changelog, drop_deletes, normalize_changes, read_changes, to_retract
from ..sources.snapshot import SourceTable
from . import fixtures as FX
from .catalog import register
from .jobs import Topic, ods_snapshot
from .oracle_views import view
from .oracle_views import with_views as V

FIELDS = ("id", "value", "k")


def _norm(spark, sf, images: bool = True):
    return normalize_changes(FX.change_records(spark, sf, images))


def _flat(df, side="after", keep=("seq",)):
    return df.select(*keep, *[F.col(side)[f].alias(f) for f in FIELDS])


@register("cdc_envelope", V("""
SELECT database, table_name, type, before_id, before_value, before_k, after_id, after_value, after_k, seq
FROM changes""", "changes"))
def cdc_envelope(spark, sf):
    """S3: dotted topic -> database/table, maps ({} when null), lower-case op,
    create -> insert."""
    n = _norm(spark, sf)
    return n.select("database", "table_name", "type",
                    *[F.col("before")[f].alias(f"before_{f}") for f in FIELDS],
                    *[F.col("after")[f].alias(f"after_{f}") for f in FIELDS], "seq")


@register("cdc_scan", V("""
SELECT seq, table_name, type FROM changes WHERE database = 'shop' AND table_name IN ('view', 'click')""",
                       "changes"))
def cdc_scan(spark, sf):
    """Database / table allow-list, latest-offset startup."""
    d = read_changes(_norm(spark, sf, images=False), databases=["shop"], tables=["shop.view", "click"],
                     startup="latest")
    return d.select("seq", "table_name", "type")


@register("cdc_scan_initial", V("""
SELECT seq, table_name, type FROM changes WHERE database = 'shop' AND table_name IN ('view', 'click')
UNION ALL
SELECT seq, table_name, 'read' FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, coalesce(after_id, before_id) ORDER BY seq DESC) AS rn
  FROM changes) WHERE rn = 1 AND type <> 'delete' AND table_name IN ('view', 'click')""", "changes"))
def cdc_scan_initial(spark, sf):
    """Initial-snapshot startup: the current rows of all tables as ``read``
    changes, then the changes; the allow-list holds for both."""
    n = _norm(spark, sf)
    d = read_changes(n, databases=["shop"], tables=["shop.view", "click"], startup="initial",
                     snapshot=apply_changelog(n, ["id"]))
    return d.select("seq", "table_name", "type")


@register("cdc_no_delete", V("SELECT seq, table_name, type FROM changes WHERE type <> 'delete'", "changes"))
def cdc_no_delete(spark, sf):
    """P2."""
    return drop_deletes(_norm(spark, sf, images=False)).select("seq", "table_name", "type")


@register("cdc_current_table", V("""
SELECT table_name, after_id AS id, after_value AS value, after_k AS k, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, coalesce(after_id, before_id) ORDER BY seq DESC) AS rn
  FROM changes) WHERE rn = 1 AND type <> 'delete'""", "changes"))
def cdc_current_table(spark, sf):
    """Changelog -> current table keyed by the row's ``id``."""
    cur = apply_changelog(_norm(spark, sf), ["id"])
    return _flat(cur, keep=("table_name", "seq"))


@register("cdc_retract", V("""
SELECT table_name, seq, false AS is_add, before_id AS id, before_value AS value, before_k AS k
FROM changes WHERE type IN ('update', 'delete')
UNION ALL
SELECT table_name, seq, true, after_id, after_value, after_k FROM changes WHERE type IN ('insert', 'update')""",
                           "changes"))
def cdc_retract(spark, sf):
    """(is_add, row) retract rows; an update gives two rows."""
    r = to_retract(_norm(spark, sf))
    return r.select("table_name", "seq", "is_add", *[F.col("row")[f].alias(f) for f in FIELDS])


view("routed", """
SELECT c.*, t.sink_type, t.sink_table, t.sink_columns,
       CASE WHEN list_contains(string_split(t.sink_columns, ','), 'id') THEN after_id END AS r_id,
       CASE WHEN list_contains(string_split(t.sink_columns, ','), 'value') THEN after_value END AS r_value,
       CASE WHEN list_contains(string_split(t.sink_columns, ','), 'k') THEN after_k END AS r_k
FROM changes c JOIN table_process t ON c.table_name = t.source_table AND c.type = t.operate_type""",
     ("changes", "table_process"))


def _routed(spark, sf):
    return route(_norm(spark, sf, images=False), FX.table_process(spark))


@register("route_columns", V("""
SELECT seq, sink_type, sink_table,
       array_to_string(list_sort(list_filter(['id', 'value', 'k'], lambda x: list_contains(string_split(sink_columns, ','), x))), ',') AS kept
FROM routed""", "routed"))
def route_columns(spark, sf):
    """Config column whitelist applied to ``after``."""
    r = _routed(spark, sf)
    return r.select("seq", "sink_type", "sink_table",
                    F.array_join(F.array_sort(F.map_keys("after")), ",").alias("kept"))


ROUTE_SQL = "SELECT seq, sink_table, r_id AS id, r_value AS value, r_k AS k FROM routed WHERE sink_type = '{}'"


@register("route_fact", V(ROUTE_SQL.format("kafka"), "routed"))
def route_fact(spark, sf):
    """Fact (kafka) output of config routing."""
    fact, _ = split_routes(_routed(spark, sf))
    return _flat(fact, keep=("seq", "sink_table"))


@register("route_dim", V(ROUTE_SQL.format("hbase"), "routed"))
def route_dim(spark, sf):
    """Dimension (hbase) output of config routing."""
    _, dim = split_routes(_routed(spark, sf))
    return _flat(dim, keep=("seq", "sink_table"))


AFTER_SCHEMA = "seq long, sink_table string, after map<string,string>"


# the configuration as a change stream: a route that moves midway, one that ends, one that comes late
view("config_versions", """
SELECT *, row_number() OVER (PARTITION BY source_table, operate_type ORDER BY from_seq) = 1 AS first FROM (
  SELECT type, source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, seq AS from_seq,
         lead(seq) OVER (PARTITION BY source_table, operate_type ORDER BY seq) AS to_seq
  FROM (SELECT 'insert' AS type, 0 AS seq, source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk FROM table_process
        UNION ALL SELECT 'update', mid, 'click', 'insert', 'kafka', 'dwd_click', 'id,value,k', 'id' FROM (SELECT max(seq) // 2 AS mid FROM changes)
        UNION ALL SELECT 'delete', late, 'view', 'insert', NULL, NULL, NULL, NULL FROM (SELECT max(seq) // 4 * 3 AS late FROM changes)
        UNION ALL SELECT 'insert', mid, 'signup', 'update', 'hbase', 'dim_signup', 'value', NULL FROM (SELECT max(seq) // 2 AS mid FROM changes)))
WHERE type <> 'delete'""", ("table_process", "changes"))


def config_changes(spark, sf):
    """``table_process`` as change rows: 'click' moves to a fact topic and 'signup' updates get a route
    midway, the route of 'view' inserts ends after three quarters of the changes."""
    top = _norm(spark, sf, images=False).agg(F.max("seq")).first()[0]
    mid, late = top // 2, top // 4 * 3
    cols = ["source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk"]
    # fixed values: the versions that the oracle's view lists
    more = spark.createDataFrame(
        [("update", mid, "click", "insert", "kafka", "dwd_click", "id,value,k", "id"),
         ("delete", late, "view", "insert", None, None, None, None),
         ("insert", mid, "signup", "update", "hbase", "dim_signup", "value", None)],
        "type string, seq bigint, " + ", ".join(f"{c} string" for c in cols))
    return FX.table_process(spark).select(F.lit("insert").alias("type"), F.lit(0).cast("bigint").alias("seq"), *cols).unionByName(more)


@register("route_as_of", V("""
SELECT c.seq, v.sink_type, v.sink_table,
       CASE WHEN list_contains(string_split(v.sink_columns, ','), 'id') OR v.sink_type = 'hbase' THEN after_id END AS id,
       CASE WHEN list_contains(string_split(v.sink_columns, ','), 'value') THEN after_value END AS value,
       CASE WHEN list_contains(string_split(v.sink_columns, ','), 'k') THEN after_k END AS k
FROM changes c JOIN config_versions v ON c.table_name = v.source_table AND c.type = v.operate_type
 AND (v.first OR c.seq >= v.from_seq) AND (v.to_seq IS NULL OR c.seq < v.to_seq)""", "changes", "config_versions"))
def route_as_of_key(spark, sf):
    """Every change by the route that held at its sequence number; changes
    ahead of their first route wait for it."""
    r = route_as_of(_norm(spark, sf, images=False), config_versions(config_changes(spark, sf)), wait=True)
    return _flat(r, keep=("seq", "sink_type", "sink_table"))


@register("cdc_snapshot_stream", V("""
SELECT table_name, after_id AS id, after_value AS value, after_k AS k, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, coalesce(after_id, before_id) ORDER BY seq DESC) AS rn
  FROM changes) WHERE rn = 1 AND type <> 'delete' AND table_name IN ('view', 'click')""", "changes"))
def cdc_snapshot_stream(spark, sf):
    """S4 as a stream: the log holds the second half of the changes, the tables
    all of them; chunks of the tables are read while the log is consumed.
    ``seq`` is that of the row in the source table."""
    base = scratch_path(spark, "ods")
    changes = _norm(spark, sf)
    whole = materialize(changes, "changes")
    mid = whole.agg(F.max("seq")).first()[0] // 2
    raw = materialize(FX.change_records(spark, sf), "records")
    for lo, hi in ((mid, mid + mid // 2), (mid + mid // 2, None)):
        part = raw.where(F.col("seq") >= lo)
        (part if hi is None else part.where(F.col("seq") < hi)).write.mode("append").parquet(f"{base}/log")

    def rows(name):
        return lambda s: (apply_changelog(whole.where(F.col("table_name") == name), ["id"])
                          .select(*[F.col("after")[f].alias(f) for f in FIELDS], F.col("seq").cast("string").alias("row_seq")))

    log = Topic(f"{base}/log", raw.schema, max_files_per_trigger=4)
    out = Topic(f"{base}/out")
    source = [SourceTable("shop", t, "id", rows(t), chunks=2) for t in ("view", "click", "signup")]
    q, snap = ods_snapshot(spark, log, out, f"{base}/ck", source, databases=["shop"], tables=["shop.view", "click"], chunks_per_step=2)
    q.awaitTermination()
    snap.drain(spark)
    told = apply_changelog(spark.read.parquet(out.name), ["id"])
    return told.select("table_name", *[F.col("after")[f].alias(f) for f in FIELDS],
                       F.coalesce(F.col("after")["row_seq"].cast("bigint"), "seq").alias("seq"))


@register("sink_lines", V(ROUTE_SQL.format("kafka"), "routed"))
def sink_lines(spark, sf):
    """K1 + F8: fact rows as JSON lines to a topic folder, read back."""
    fact, _ = split_routes(_routed(spark, sf))
    path = scratch_path(spark, "dwd_fact")
    K.write_lines(fact.select("seq", "sink_table", "after"), path)
    back = spark.read.text(path).select(F.from_json("value", AFTER_SCHEMA).alias("r")).select("r.*")
    return _flat(back, keep=("seq", "sink_table"))


@register("sink_routed", V("""
SELECT sink_table, r_id AS id, array_to_string(list_sort(list_filter(['id', 'value', 'k'],
       lambda x: list_contains(string_split(sink_columns, ','), x))), ',') AS kept
FROM routed WHERE sink_type = 'kafka'""", "routed"))
def sink_routed(spark, sf):
    """K2: each fact row to the topic named by its sink table, read back."""
    fact, _ = split_routes(_routed(spark, sf))
    path = scratch_path(spark, "routed")
    K.write_routed(fact.select("sink_table", F.to_json("after").alias("value")), path)
    back = spark.read.parquet(path)
    m = F.from_json("value", "map<string,string>")
    return back.select("sink_table", m["id"].alias("id"),
                       F.array_join(F.array_sort(F.map_keys(m)), ",").alias("kept"))


@register("sink_once", V(ROUTE_SQL.format("hbase"), "routed"))
def sink_once(spark, sf):
    """K3: the same batch written twice under one batch id keeps one copy."""
    _, dim = split_routes(_routed(spark, sf))
    rows = _flat(dim, keep=("seq", "sink_table"))
    path = scratch_path(spark, "once")
    K.write_once(rows, path, batch_id=7)
    K.write_once(rows, path, batch_id=7)
    return spark.read.parquet(path).drop("batch_id")


@register("sink_transactional", V("SELECT seq, sink_table, r_id AS id, r_k AS k FROM routed WHERE sink_type = 'kafka'", "routed"))
def sink_transactional(spark, sf):
    """K3 + K4: staged files and one manifest per batch; the batch given twice leaves one copy."""
    fact, _ = split_routes(_routed(spark, sf))
    rows = _flat(fact, keep=("seq", "sink_table"))
    path = scratch_path(spark, "committed")
    TX.register(spark)
    for _ in range(2):
        rows.write.format(TX.FORMAT).option("path", path).option("batch_id", 3).option("exclude", "value").mode("append").save()
    return TX.read_committed(spark, path, rows.drop("value").schema)


@register("sink_columns", V("SELECT seq, sink_table, r_id AS id, r_k AS k FROM routed WHERE sink_type = 'kafka'",
                            "routed"))
def sink_columns(spark, sf):
    """K4: relational sink with a transient (excluded) column, read back."""
    fact, _ = split_routes(_routed(spark, sf))
    path = scratch_path(spark, "table")
    K.write_table(_flat(fact, keep=("seq", "sink_table")), path, exclude=["value"], batchsize=500)
    return spark.read.parquet(path)


SPLIT_TS = 1705363200000  # 2024-01-16 00:00:00 UTC: the two upsert batches


@register("dim_upsert", V("""
SELECT sink_table, id, k, seq FROM (
  SELECT sink_table, r_id AS id, r_k AS k, seq,
         row_number() OVER (PARTITION BY sink_table, r_id ORDER BY seq DESC) AS rn
  FROM routed WHERE sink_type = 'hbase') WHERE rn = 1""", "routed"))
def dim_upsert(spark, sf):
    """K5: dimension rows upserted in two batches (before / after a date);
    the newest row per (table, id) wins."""
    _, dim = split_routes(_routed(spark, sf))
    rows = dim.select("sink_table", F.col("after")["id"].alias("id"), F.col("after")["k"].alias("k"),
                      "seq", "ts_ms")
    target = scratch_path(spark, "dim")
    K.upsert_dim(rows.where(F.col("ts_ms") < SPLIT_TS).drop("ts_ms"), target, ["sink_table", "id"], "seq")
    K.upsert_dim(rows.where(F.col("ts_ms") >= SPLIT_TS).drop("ts_ms"), target, ["sink_table", "id"], "seq")
    return K.read_snapshot(spark, target)


@register("ensure_table", V("""
SELECT sink_table, r_id AS id, r_value AS value, r_k AS k FROM routed WHERE sink_type IN ('kafka', 'hbase')""",
                            "routed"))
def ensure_table(spark, sf):
    """K6: create each configured sink table (all-string columns, pk id) and
    load the routed rows into it; read the tables back."""
    # routed once, then loaded table by table
    routed = materialize(_routed(spark, sf).where(F.col("sink_type").isin("kafka", "hbase"))
                         .select("sink_table", "after"), "routed")
    cfg = (FX.table_process(spark).where(F.col("sink_type").isin("kafka", "hbase"))
           .groupBy("sink_table").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(
               F.collect_list(F.split("sink_columns", ","))))), ",").alias("cols"),
               F.first("sink_pk").alias("pk")))
    base = scratch_path(spark, "tables")
    db = "tw_" + base.rstrip("/").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{base}-db'")
    tables = {}
    for row in cfg.collect():  # configuration rows: a handful
        tables[row["sink_table"]] = K.ensure_table(spark, row["sink_table"], row["cols"],
                                                   f"{base}/sink={row['sink_table']}", row["pk"], database=db)
    # one pass over the routed rows fills the folders of all tables
    cols = sorted({f.name for name in tables.values() for f in spark.table(name).schema.fields})
    routed.select(F.col("sink_table").alias("sink"), *[F.col("after")[c].alias(c) for c in cols]) \
        .write.mode("append").partitionBy("sink").parquet(base)
    out = None
    for t, name in tables.items():
        spark.catalog.refreshTable(name)
        back = spark.table(name).withColumn("sink_table", F.lit(t))
        out = back if out is None else out.unionByName(back, allowMissingColumns=True)
    # the tables are external: dropping the database leaves the files that the result reads
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out.select("sink_table", "id", "value", "k")
