"""Traffic keys: S7-S9, J3, J7-J9, W4-W6, A5-A7, E5."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import patterns as W
from ..operators.joins import interval_join, match_or_timeout, overspeed, with_speed_limit
from ..schemas import VIOLATION
from ..sources.config import latest_per_key
from ..sources.lines import parse_car_lines, parse_csv_lines
from . import fixtures as FX
from .catalog import register
from .oracle_views import view
from .oracle_views import with_views as V

HOUR = 3_600_000
DAY = 24 * HOUR
TSF = "'%Y-%m-%d %H:%M:%S'"


def cars(spark, sf):
    """car_info with event time (``ts``) and epoch millis (``ts_ms``)."""
    c = FX.car_info(spark, sf)
    return with_times(c)


def with_times(c):
    t = F.try_to_timestamp("action_time", F.lit("yyyy-MM-dd HH:mm:ss"))
    return c.withColumn("ts", t).withColumn("ts_ms", F.unix_millis(t))


view("cars_limited", """
SELECT c.*, coalesce(l.speed_limit, 60.0) AS limit_speed
FROM car_info c LEFT JOIN speed_limit l USING (area_id, road_id, monitor_id)""", ("car_info", "speed_limit"))


@register("parse_tsv", V("""
SELECT area_id, road_id, monitor_id, camera_id, action_time, car_id, speed FROM car_info""", "car_info"))
def parse_tsv(spark, sf):
    """The tab-separated car line parser."""
    return parse_car_lines(FX.car_lines(spark, sf))


@register("overspeed", V("""
SELECT car_id, monitor_id, road_id, speed AS real_speed, limit_speed, ts_ms AS action_time
FROM cars_limited WHERE speed > limit_speed * 1.2""", "cars_limited"))
def overspeed_q(spark, sf):
    """Limit by (area, road, monitor), default 60, emit above 1.2 x limit."""
    return overspeed(cars(spark, sf), FX.speed_limit(spark, sf))


@register("speed_limit_lookup", V("SELECT seq, car_id, speed, limit_speed FROM cars_limited", "cars_limited"))
def speed_limit_lookup(spark, sf):
    """Every passage with its limit (default 60)."""
    d = with_speed_limit(cars(spark, sf), FX.speed_limit(spark, sf))
    return d.select("seq", "car_id", "speed", "limit_speed")


@register("danger_drive", V(f"""
SELECT car_id, '危险驾驶' AS violation, action_time AS create_time, action_time AS time_1,
       n1 AS time_2, n2 AS time_3, '车辆涉嫌危险驾驶，第一次经过卡口时间: ' || action_time || '第二次经过卡口时间: ' || n1
       || '第二次经过卡口时间: ' || n2 AS description
FROM (SELECT *, lead(action_time, 1) OVER w AS n1, lead(action_time, 2) OVER w AS n2,
             lead(ts_ms, 2) OVER w AS n2ts
      FROM cars_limited WHERE speed > limit_speed * 1.2
      WINDOW w AS (PARTITION BY car_id ORDER BY ts_ms, seq))
WHERE n2ts IS NOT NULL AND n2ts - ts_ms < {72 * HOUR}""", "cars_limited"))
def danger_drive(spark, sf):
    """W4 with within = 72 h (reference: 10 s)."""
    d = with_speed_limit(cars(spark, sf), FX.speed_limit(spark, sf))
    return W.danger_drive(d, 72 * HOUR)


@register("repeat_plates", V(f"""
SELECT car_id, '套牌车辆' AS violation, action_time AS create_time,
       strftime(epoch_ms(prev), {TSF}) AS previous_time, seq,
       '车辆：' || car_id || ' 涉嫌套牌,上次经过卡口时间：' || strftime(epoch_ms(prev), {TSF}) || ',本次经过时间：' || action_time AS description
FROM (SELECT *, max(ts_ms) OVER (PARTITION BY car_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
      FROM car_info)
WHERE prev IS NOT NULL AND abs(ts_ms - prev) <= {HOUR}""", "car_info"))
def repeat_plates(spark, sf):
    """W5 with within = 1 h (reference: 10 s)."""
    return W.repeat_plates(cars(spark, sf), HOUR)


def _tumble_sql(src, size, keys, aggs, ts="ts_ms"):
    return f"""
SELECT strftime(epoch_ms(ws), {TSF}) AS stt, strftime(epoch_ms(ws + {size}), {TSF}) AS edt, {keys}, {aggs}
FROM (SELECT *, {ts} - ({ts} % {size}) AS ws FROM {src}) GROUP BY ws, {keys}"""


def _slide_src(src, size, slide, ts="ts_ms"):
    n = size // slide
    return f"""(SELECT s.*, ({ts} - {ts} % {slide}) - i * {slide} AS ws
   FROM {src} s, range({n}) t(i)
   WHERE ({ts} - {ts} % {slide}) - i * {slide} + {size} > {ts})"""


@register("car_count", V(_tumble_sql("car_info", HOUR, "area_id", "count(DISTINCT car_id) AS car_count"), "car_info"))
def car_count(spark, sf):
    """Distinct cars per area per hour (reference: per minute)."""
    return A.car_count(cars(spark, sf), "1 hour")


@register("car_count_approx", V(_tumble_sql("car_info", HOUR, "area_id", "count(DISTINCT car_id) AS car_count, true AS close"),
                                "car_info"))
def car_count_approx(spark, sf):
    """A6 approximate variant (HyperLogLog++, 1 % relative error) beside the exact
    count: ``close`` says that they are within 3 % of each other."""
    approx = A.car_count(cars(spark, sf), "1 hour", approx=True).withColumnRenamed("car_count", "told")
    both = A.car_count(cars(spark, sf), "1 hour").join(approx, ["stt", "edt", "area_id"])
    close = F.abs(F.col("told") - F.col("car_count")) <= 0.03 * F.col("car_count")
    return both.withColumn("close", close).drop("told")


SLIDE = 6 * HOUR
MONITOR = "area_id || '_' || road_id || '_' || monitor_id"

view("avg_speed", f"""
SELECT ws AS start, ws + {DAY} AS "end", {MONITOR} AS monitor_id,
       ((2 * sum(CAST(round(speed * 100) AS BIGINT)) + count(*)) // (2 * count(*))) / CAST(100 AS DOUBLE) AS avg_speed,
       count(*) AS car_count
FROM {_slide_src("car_info", DAY, SLIDE)} GROUP BY ws, {MONITOR}""", ("car_info",))

view("speed_bands", f"""
SELECT strftime(epoch_ms(ws), {TSF}) AS stt, strftime(epoch_ms(ws + {DAY}), {TSF}) AS edt,
       {MONITOR} AS monitor_id,
       count(*) FILTER (WHERE speed >= 120) AS high_speed_count,
       count(*) FILTER (WHERE speed >= 90 AND speed < 120) AS middle_speed_count,
       count(*) FILTER (WHERE speed >= 60 AND speed < 90) AS normal_speed_count,
       count(*) FILTER (WHERE speed < 60) AS low_speed_count
FROM {_slide_src("car_info", DAY, SLIDE)} GROUP BY ws, {MONITOR}""", ("car_info",))


@register("avg_speed", V("SELECT * FROM avg_speed", "avg_speed"))
def avg_speed(spark, sf):
    """A5: sliding 1 day / 6 h (reference: 5 min / 1 min)."""
    return A.avg_speed(cars(spark, sf), "1 day", "6 hours")


@register("speed_bands", V("SELECT * FROM speed_bands", "speed_bands"))
def speed_bands(spark, sf):
    """Sliding 1 day / 6 h."""
    return A.speed_bands(cars(spark, sf), "1 day", "6 hours")


TOP_SQL = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stt, edt ORDER BY high_speed_count, middle_speed_count,
                                     normal_speed_count, low_speed_count, monitor_id) AS rank
               FROM speed_bands) WHERE rank <= 5"""


@register("top_monitors", V(TOP_SQL, "speed_bands"))
def top_monitors(spark, sf):
    """Five most free-flowing monitors per sliding window."""
    return W.top_monitors(A.speed_bands(cars(spark, sf), "1 day", "6 hours"), 5,
                          window_cols=("stt", "edt"))


@register("e2e_traffic", V(TOP_SQL, "speed_bands"))
def e2e_traffic(spark, sf):
    """E5: tab-separated lines -> parse -> speed bands -> top 5 per window."""
    parsed = with_times(parse_car_lines(FX.car_lines(spark, sf)))
    return W.top_monitors(A.speed_bands(parsed, "1 day", "6 hours"), 5, window_cols=("stt", "edt"))


@register("e2e_danger", V(f"""
SELECT car_id, '危险驾驶' AS violation, action_time AS create_time, action_time AS time_1,
       n1 AS time_2, n2 AS time_3, '车辆涉嫌危险驾驶，第一次经过卡口时间: ' || action_time || '第二次经过卡口时间: ' || n1
       || '第二次经过卡口时间: ' || n2 AS description
FROM (SELECT *, lead(action_time, 1) OVER w AS n1, lead(action_time, 2) OVER w AS n2,
             lead(ts_ms, 2) OVER w AS n2ts
      FROM cars_limited WHERE speed > limit_speed * 1.2
      WINDOW w AS (PARTITION BY car_id ORDER BY ts_ms, seq))
WHERE n2ts IS NOT NULL AND n2ts - ts_ms < {72 * HOUR}""", "cars_limited"))
def e2e_danger(spark, sf):
    """E5: tab-separated lines -> parse -> limit lookup -> dangerous driving."""
    lines = FX.car_lines(spark, sf)
    parsed = with_times(parse_car_lines(lines, keep=("seq",)))
    return W.danger_drive(with_speed_limit(parsed, FX.speed_limit(spark, sf)), 72 * HOUR)


# ------------------------------------------------------------- violations
def _viol(spark, sf):
    v = FX.violation(spark, sf)
    return v.withColumn("ts_ms", F.unix_millis(F.to_timestamp("create_time")))


def _police(spark, sf):
    p = FX.police(spark, sf)
    return p.withColumn("ts_ms", F.unix_millis(F.to_timestamp("action_time")))


@register("violation_dispatch", V(f"""
SELECT v.car_id, v.create_time, p.action_time,
       '车辆：' || v.car_id || '，违法时间：' || v.create_time || '，出警时间：' || p.action_time || '，处理状态：成功' AS result
FROM violation v JOIN police p ON v.car_id = p.car_id
 AND p.ts_ms BETWEEN v.ts_ms - {6 * HOUR} AND v.ts_ms + {6 * HOUR}""", "violation", "police"))
def violation_dispatch(spark, sf):
    """Violation x dispatch within +-6 h (reference: +-10 s) on car id."""
    v = _viol(spark, sf).select("car_id", "create_time", F.col("ts_ms").alias("v_ts"))
    p = _police(spark, sf).select("car_id", "action_time", F.col("ts_ms").alias("p_ts"))
    j = interval_join(v, p, ["car_id"], "v_ts", "p_ts", -6 * HOUR, 6 * HOUR)
    # fixed values: the dispatch report text of the reference
    text = F.concat(F.lit("车辆："), F.col("car_id"), F.lit("，违法时间："), F.col("create_time"),
                    F.lit("，出警时间："), F.col("action_time"), F.lit("，处理状态：成功"))
    return j.select("car_id", "create_time", "action_time", text.alias("result"))


@register("match_timeout", V(f"""
SELECT coalesce(v.car_id, p.car_id) AS car_id, v.seq AS l_id, p.seq AS r_id, v.ts_ms AS l_ts, p.ts_ms AS r_ts,
       CASE WHEN v.seq IS NOT NULL AND p.seq IS NOT NULL THEN 'matched'
            WHEN v.seq IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS status
FROM violation v FULL OUTER JOIN police p ON v.car_id = p.car_id
 AND p.ts_ms BETWEEN v.ts_ms - {6 * HOUR} AND v.ts_ms + {6 * HOUR}""", "violation", "police"))
def match_timeout(spark, sf):
    """J9 batch form: full outer match within +-6 h (reference wait: 5 s)."""
    return match_or_timeout(_viol(spark, sf), _police(spark, sf), "car_id", "ts_ms", "ts_ms", 6 * HOUR)


@register("parse_csv", V("""
SELECT car_id, violation, create_time, CASE WHEN seq % 10 = 0 THEN NULL ELSE description END AS description
FROM violation""", "violation"))
def parse_csv(spark, sf):
    """Comma-separated violation lines; lines missing the 4th field give null."""
    v = FX.violation(spark, sf)
    line = F.when(F.col("seq") % 10 == 0, F.concat_ws(",", "car_id", "violation", "create_time")) \
            .otherwise(F.concat_ws(",", "car_id", "violation", "create_time", "description"))
    return parse_csv_lines(v.select(line.alias("value")), VIOLATION)


view("limit_history", """
SELECT lpad(CAST(user_id % 8 AS VARCHAR), 2, '0') AS area_id, lpad(CAST(k % 5 AS VARCHAR), 2, '0') AS road_id,
       lpad(CAST(k % 10 AS VARCHAR), 4, '0') AS monitor_id,
       CAST(40 + k % 10 + 5 * (event_id % 3) AS DOUBLE) AS speed_limit, event_id AS loaded_seq
FROM ev""", ("ev",))


@register("poll_config", V("""
SELECT area_id, road_id, monitor_id, speed_limit, loaded_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY area_id, road_id, monitor_id ORDER BY loaded_seq DESC) AS rn
  FROM limit_history) WHERE rn = 1""", "limit_history"))
def poll_config(spark, sf):
    """Successive config reads (one per event), newest row per key wins."""
    e = FX.table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    hist = e.select(F.lpad((F.col("user_id") % 8).cast("string"), 2, "0").alias("area_id"),
                    F.lpad((F.col("k") % 5).cast("string"), 2, "0").alias("road_id"),
                    F.lpad((F.col("k") % 10).cast("string"), 4, "0").alias("monitor_id"),
                    (F.lit(40) + F.col("k") % 10 + 5 * (F.col("event_id") % 3)).cast("double").alias("speed_limit"),
                    F.col("event_id").alias("loaded_seq"))
    return latest_per_key(hist, ["area_id", "road_id", "monitor_id"], ["loaded_seq"])
