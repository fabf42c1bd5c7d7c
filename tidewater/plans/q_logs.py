"""Behaviour-log keys: P1, P3-P5, W1-W3, U1, U2, A1, S1, S2, F7, E1."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import aggregates as A
from ..operators import logs as L
from ..operators import patterns as W
from ..operators.measures import visitor_measures
from ..schemas import PAGE_LOG, PAGE_VIEW_MAPS
from ..session import materialize, scratch_path
from ..sources.lines import read_json_table, read_lines
from . import fixtures as FX
from .catalog import register
from .oracle_views import with_views as V

H12 = 12 * 3600 * 1000
DAY = "1 day"


def _flat(df):
    return df.select("seq", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                     F.col("ts"))


ENTRY = "(last_page_id IS NULL OR length(last_page_id) = 0)"


@register("page_entries", V(f"SELECT seq, mid, page_id, last_page_id FROM page_log WHERE {ENTRY}", "page_log"))
def page_entries(spark, sf):
    p = FX.page_log(spark, sf).select("seq", F.col("common.mid").alias("mid"),
                                      F.col("page.page_id").alias("page_id"),
                                      F.col("page.last_page_id").alias("last_page_id"))
    return p.where(L.is_entry("last_page_id"))


# ------------------------------------------------------------------ raw lines
def _good_dirty(spark, sf):
    return L.split_dirty(FX.raw_log_lines(spark, sf), PAGE_LOG, keep=("seq", "value"))


@register("log_good", V("SELECT seq, mid, page_id, is_new, ts FROM page_log WHERE k <> 0", "page_log"))
def log_good(spark, sf):
    good, _ = _good_dirty(spark, sf)
    return good.select("seq", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                       F.col("common.is_new").alias("is_new"), "ts")


@register("log_dirty", V("SELECT seq, value FROM raw_log WHERE k = 0", "raw_log"))
def log_dirty(spark, sf):
    _, dirty = L.split_dirty(FX.raw_log_lines(spark, sf), PAGE_LOG, keep=("seq",))
    return dirty


@register("log_start", V("SELECT seq, mid, start, ts FROM page_log WHERE k <> 0 AND start IS NOT NULL", "page_log"))
def log_start(spark, sf):
    good, _ = _good_dirty(spark, sf)
    start, _ = L.split_logs(good)
    return start.select("seq", F.col("common.mid").alias("mid"), "start", "ts")


@register("log_page", V("""
SELECT seq, mid, page_id, ts, 'os' || (user_id % 4) AS os FROM page_log WHERE k <> 0 AND start IS NULL""", "page_log"))
def log_page(spark, sf):
    """P4, with a field of the record that the typed columns do not have."""
    good, _ = _good_dirty(spark, sf)
    _, page = L.split_logs(good)
    return page.select("seq", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts",
                       F.get_json_object("value", "$.common.os").alias("os"))


@register("log_display", V("""
SELECT item, item_type, page_id, k % 6 AS pos_id FROM page_log, range(n_displays) t(i)
WHERE k <> 0 AND start IS NULL""", "page_log"))
def log_display(spark, sf):
    """P5, whole elements."""
    good, _ = _good_dirty(spark, sf)
    _, page = L.split_logs(good)
    return L.explode_displays(page, record="value").select(
        "item", "item_type", "page_id", F.get_json_object("display", "$.pos_id").cast("int").alias("pos_id"))


@register("src_lines", V("SELECT value FROM raw_log", "raw_log"))
def src_lines(spark, sf):
    """Round trip through the file form of the topic source."""
    path = scratch_path(spark, "ods_base_log")
    FX.raw_log_lines(spark, sf).select("value").write.text(path)
    return read_lines(spark, path)


@register("src_json_table", V("""
SELECT mid, page_id, last_page_id, item, ts, strftime(epoch_ms(ts - ts % 1000), '%Y-%m-%d %H:%M:%S') AS rt
FROM page_log WHERE k <> 0""", "page_log"))
def src_json_table(spark, sf):
    lines = FX.raw_log_lines(spark, sf)
    rt = F.to_timestamp(F.from_unixtime((F.col("ts") / 1000).cast("long")))
    t = read_json_table(lines, PAGE_VIEW_MAPS, rt, "1 second")
    return t.select(t.common["mid"].alias("mid"), t.page["page_id"].alias("page_id"),
                    t.page["last_page_id"].alias("last_page_id"), t.page["item"].alias("item"),
                    "ts", F.date_format("rt", "yyyy-MM-dd HH:mm:ss").alias("rt"))


@register("fn_json", V("""
SELECT seq, mid, page_id, item, CAST(n_displays AS BIGINT) AS n_displays, ts
FROM page_log WHERE k <> 0""", "page_log"))
def fn_json(spark, sf):
    """field, nested field and array access on the JSON text; each line
    is parsed once against the fields it needs."""
    need = T.StructType.fromDDL("common struct<mid string>, page struct<page_id string, item string>, "
                                "displays array<string>, ts long")
    good, _ = L.split_dirty(FX.raw_log_lines(spark, sf), need, keep=("seq",))
    r = good.select("seq", F.struct(*need.names).alias("r"))
    return r.select("seq", F.col("r.common.mid").alias("mid"), F.col("r.page.page_id").alias("page_id"),
                    F.col("r.page.item").alias("item"),
                    F.coalesce(F.size("r.displays"), F.lit(0)).cast("long").alias("n_displays"),
                    F.col("r.ts").alias("ts"))


# ------------------------------------------------------------- device history
@register("fix_is_new", V("""
SELECT seq, mid, CASE WHEN is_new = '1' AND seq <> min(CASE WHEN is_new = '1' THEN seq END) OVER (PARTITION BY mid)
                      THEN '0' ELSE is_new END AS is_new
FROM page_log""", "page_log"))
def fix_is_new(spark, sf):
    p = L.fix_is_new(FX.page_log(spark, sf))
    return p.select("seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"))


UV_SQL = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, CAST(epoch_ms(ts) AS DATE) ORDER BY ts, seq) AS rn
  FROM page_log WHERE {ENTRY}) WHERE rn = 1"""


@register("unique_visits", V(f"SELECT seq, mid, page_id, ts FROM ({UV_SQL})", "page_log"))
def unique_visits(spark, sf):
    return _flat(W.unique_visits(FX.page_log(spark, sf)))


def _bounce_sql(cond: str, within: int = H12, cols: str = "seq, mid, page_id, ts") -> str:
    return f"""
SELECT {cols} FROM (
  SELECT *, lead(ts) OVER w AS nts, lead({ENTRY}) OVER w AS nentry
  FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
WHERE {ENTRY} AND ({cond.format(within=within)})"""


MATCHED = "nts IS NOT NULL AND nts - ts < {within} AND nentry"
TIMEOUT = "nts IS NULL OR nts - ts >= {within}"


@register("bounces_matched", V(_bounce_sql(MATCHED), "page_log"))
def bounces_matched(spark, sf):
    return _flat(W.bounces(FX.page_log(spark, sf), H12, kind="matched"))


@register("bounces_timeout", V(_bounce_sql(TIMEOUT), "page_log"))
def bounces_timeout(spark, sf):
    return _flat(W.bounces(FX.page_log(spark, sf), H12, kind="timeout"))


@register("bounces", V(_bounce_sql(f"({MATCHED}) OR ({TIMEOUT})"), "page_log"))
def bounces(spark, sf):
    """Union of matched and timed-out bounces, in one pass."""
    return _flat(W.bounces(FX.page_log(spark, sf), H12, kind="all"))


# ------------------------------------------------------------- visitor table
VISITOR_UNION_SQL = f"""
SELECT vc, ch, ar, is_new, 1::BIGINT AS uv_ct, 0::BIGINT AS pv_ct, 0::BIGINT AS sv_ct, 0::BIGINT AS uj_ct, 0::BIGINT AS dur_sum, ts FROM ({UV_SQL})
UNION ALL
SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM ({_bounce_sql(f"({MATCHED}) OR ({TIMEOUT})", cols="*")})
UNION ALL
SELECT vc, ch, ar, is_new, 0, 1, CASE WHEN {ENTRY} THEN 1 ELSE 0 END, 0, during_time, ts FROM page_log"""


def _visitor_union(spark, sf, page=None):
    p = page if page is not None else FX.page_log(spark, sf)
    return visitor_measures(W.unique_visits(p), W.bounces(p, H12), p)


@register("visitor_union", V(VISITOR_UNION_SQL, "page_log"))
def visitor_union(spark, sf):
    return _visitor_union(spark, sf)


def window_sql(src: str, size_ms: int, keys: str, aggs: str, ts: str = "ts") -> str:
    """Tumbling window aggregation in DuckDB (epoch-aligned like F.window)."""
    return f"""
SELECT strftime(epoch_ms(ws), '%Y-%m-%d %H:%M:%S') AS stt,
       strftime(epoch_ms(ws + {size_ms}), '%Y-%m-%d %H:%M:%S') AS edt, {keys}, {aggs}
FROM (SELECT *, {ts} - ({ts} % {size_ms}) AS ws FROM ({src}) s) x
GROUP BY ws, {keys}"""


DAY_MS = 86_400_000
VISITOR_AGGS = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in
                         ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"))


@register("visitor_stats", V(window_sql(VISITOR_UNION_SQL, DAY_MS, "vc, ch, ar, is_new", VISITOR_AGGS), "page_log"))
def visitor_stats(spark, sf):
    return A.visitor_stats(_visitor_union(spark, sf), DAY)


@register("visitor_stats_11s", V(window_sql(
    f"SELECT * REPLACE (ts // 86400 AS ts) FROM ({VISITOR_UNION_SQL})", 11_000, "vc, ch, ar, is_new", VISITOR_AGGS), "page_log"))
def visitor_stats_11s(spark, sf):
    """The 11-second window as written (epoch-aligned) over all three
    measures, on a clock that runs 86,400 times slower: the given events are
    hours apart, and a window must hold several."""
    u = _visitor_union(spark, sf)
    return A.visitor_stats(u.withColumn("ts", F.floor(F.col("ts") / 86_400).cast("long")), "11 seconds")


# -------------------------------------------------------------------- E1
PIPE_PAGE = "SELECT * FROM page_log WHERE k <> 0 AND start IS NULL"


def _e2e_visitor_sql() -> str:
    fixed = """
SELECT * REPLACE (CASE WHEN is_new = '1' AND seq <> min(CASE WHEN is_new = '1' THEN seq END) OVER (PARTITION BY mid)
                  THEN '0' ELSE is_new END AS is_new)
FROM page_log WHERE k <> 0"""
    pages = "SELECT * FROM fixed WHERE start IS NULL"
    uv = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, CAST(epoch_ms(ts) AS DATE) ORDER BY ts, seq) rn
              FROM pages WHERE {ENTRY}) WHERE rn = 1"""
    uj = f"""SELECT * FROM (SELECT *, lead(ts) OVER w AS nts, lead({ENTRY}) OVER w AS nentry
              FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
             WHERE {ENTRY} AND (({MATCHED}) OR ({TIMEOUT}))""".format(within=H12)
    union = f"""
SELECT vc, ch, ar, is_new, 1::BIGINT AS uv_ct, 0::BIGINT AS pv_ct, 0::BIGINT AS sv_ct, 0::BIGINT AS uj_ct, 0::BIGINT AS dur_sum, ts FROM uv
UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM uj
UNION ALL SELECT vc, ch, ar, is_new, 0, 1, CASE WHEN {ENTRY} THEN 1 ELSE 0 END, 0, during_time, ts FROM pages"""
    body = window_sql(union, DAY_MS, "vc, ch, ar, is_new", VISITOR_AGGS)
    return V(f", fixed AS ({fixed}), pages AS ({pages}), uv AS ({uv}), uj AS ({uj})\n{body}", "page_log")


@register("e2e_visitor", _e2e_visitor_sql())
def e2e_visitor(spark, sf):
    """Raw lines -> dirty split -> flag repair -> {UV, bounce, PV} -> visitor stats."""
    good, _dirty = L.split_dirty(FX.raw_log_lines(spark, sf), PAGE_LOG, keep=("seq",))
    # parsed once: the flag repair joins its input to itself, so the parsed
    # lines are handed off before it
    good = materialize(good, "ods_log")
    _start, pages = L.split_logs(L.fix_is_new(good))
    # DWD hand-off: the cleaned page log is written once and read by the
    # three DWM branches (unique visits, bounces, page views)
    pages = materialize(pages, "dwd_page_log")
    return A.visitor_stats(visitor_measures(W.unique_visits(pages), W.bounces(pages, H12), pages), DAY)
