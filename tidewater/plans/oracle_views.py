"""The fixture views of ``plans/fixtures.py`` written in DuckDB SQL.

Each entry is the body of one CTE.  ``with_views(sql, *names)`` prefixes a
query with the CTEs it needs (dependencies are resolved in declaration
order).  The SQL reads only the driver's pre-registered tables.
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S'"

VIEWS: dict[str, str] = {}
DEPS: dict[str, tuple[str, ...]] = {}


def view(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    VIEWS[name] = sql
    DEPS[name] = deps


view("ev", """
SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")

view("page_log", f"""
SELECT event_id AS seq,
       'm' || user_id AS mid,
       'v' || (user_id % 3) AS vc, 'c' || (user_id % 5) AS ch, 'a' || (user_id % 7) AS ar,
       CASE WHEN k % 3 = 0 THEN '1' ELSE '0' END AS is_new,
       CASE WHEN event_type = 'view' THEN 'good_detail' ELSE event_type END AS page_id,
       CASE event_type WHEN 'click' THEN '' WHEN 'error' THEN 'search' WHEN 'purchase' THEN 'home' END AS last_page_id,
       CAST(k AS VARCHAR) AS item,
       CASE WHEN k % 2 = 0 THEN 'sku_id' ELSE 'other' END AS item_type,
       CAST(round(value * 1000) AS BIGINT) AS during_time,
       CAST(k % 3 AS INTEGER) AS n_displays,
       CASE WHEN event_type = 'signup' AND k % 2 = 1 THEN 'boot' END AS start,
       (epoch_us(ts) // 1000) AS ts,
       k, user_id
FROM ev""", ("ev",))

view("raw_log", """
SELECT seq,
       CASE WHEN k = 0 THEN 'not json ' || seq ELSE
         '{"common":{"mid":"' || mid || '","vc":"' || vc || '","ch":"' || ch || '","ar":"' || ar
         || '","is_new":"' || is_new || '","os":"os' || (user_id % 4) || '"},"page":{"page_id":"' || page_id || '"'
         || coalesce(',"last_page_id":"' || last_page_id || '"', '')
         || ',"item":"' || item || '","item_type":"' || item_type || '","during_time":' || during_time
         || '},"displays":[' || substring(repeat(',{"item":"' || item || '","item_type":"' || item_type || '","pos_id":' || (k % 6) || '}', n_displays), 2)
         || ']' || CASE WHEN start IS NOT NULL THEN ',"start":"boot"' ELSE '' END
         || ',"ts":' || ts || '}'
       END AS value,
       k
FROM page_log""", ("page_log",))

view("car_info", f"""
SELECT lpad(CAST(user_id % 8 AS VARCHAR), 2, '0') AS area_id,
       lpad(CAST(k % 5 AS VARCHAR), 2, '0') AS road_id,
       lpad(CAST(k % 10 AS VARCHAR), 4, '0') AS monitor_id,
       lpad(CAST(k AS VARCHAR), 5, '0') AS camera_id,
       strftime(ts, {TS}) AS action_time,
       'c' || user_id AS car_id,
       value AS speed,
       event_id AS seq,
       (epoch_us(CAST(strftime(ts, {TS}) AS TIMESTAMP)) // 1000) AS ts_ms
FROM ev""", ("ev",))

view("speed_limit", """
SELECT DISTINCT * FROM (
  SELECT lpad(CAST(user_id % 8 AS VARCHAR), 2, '0') AS area_id,
         lpad(CAST(k % 5 AS VARCHAR), 2, '0') AS road_id,
         lpad(CAST(k % 10 AS VARCHAR), 4, '0') AS monitor_id,
         CAST(40 + k % 10 AS DOUBLE) AS speed_limit
  FROM ev) WHERE monitor_id < '0005'""", ("ev",))

view("violation", f"""
SELECT 'c' || user_id AS car_id, 'violation' AS violation, strftime(ts, {TS}) AS create_time,
       'event ' || event_id AS description, event_id AS seq,
       (epoch_us(CAST(strftime(ts, {TS}) AS TIMESTAMP)) // 1000) AS ts_ms
FROM events WHERE event_type = 'error'""")

view("police", f"""
SELECT 'p' || event_id AS police_id, 'c' || user_id AS car_id, strftime(ts, {TS}) AS action_time,
       'done' AS status, event_id AS seq,
       (epoch_us(CAST(strftime(ts, {TS}) AS TIMESTAMP)) // 1000) AS ts_ms
FROM events WHERE event_type = 'purchase'""")

view("order_info", f"""
SELECT o_orderkey AS id, o_custkey % 25 AS province_id, o_orderstatus AS order_status,
       o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
       CAST(o_orderkey % 100 AS DECIMAL(18,2)) AS activity_reduce_amount,
       CAST(o_orderkey % 7 AS DECIMAL(18,2)) AS coupon_reduce_amount,
       CAST(o_totalprice AS DECIMAL(18,2)) AS original_total_amount,
       CAST(o_orderkey % 20 AS DECIMAL(18,2)) AS feight_fee,
       CAST(NULL AS VARCHAR) AS expire_time, CAST(epoch_us(o_orderdate) // 1000 AS VARCHAR) AS create_time,
       CAST(NULL AS VARCHAR) AS operate_time, (epoch_us(o_orderdate) // 1000) AS create_ts
FROM orders""")

view("order_detail", f"""
SELECT l_orderkey * 100 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
       'sku ' || l_partkey AS sku_name, CAST(epoch_us(l_shipdate) // 1000 AS VARCHAR) AS create_time,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS split_total_amount,
       CAST(l_discount AS DECIMAL(18,2)) AS split_activity_amount,
       CAST(l_tax AS DECIMAL(18,2)) AS split_coupon_amount,
       (epoch_us(l_shipdate) // 1000) AS create_ts
FROM lineitem""")

view("payment_info", f"""
SELECT o_orderkey AS id, o_orderkey AS order_id, o_custkey AS user_id,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, 'order ' || o_orderkey AS subject,
       'card' AS payment_type,
       strftime(o_orderdate + to_days(CAST(o_orderkey % 30 - 10 AS INTEGER)), {TS}) AS create_time,
       CAST(NULL AS VARCHAR) AS callback_time,
       (epoch_us(o_orderdate + to_days(CAST(o_orderkey % 30 - 10 AS INTEGER))) // 1000) AS create_ts
FROM orders WHERE o_orderstatus = 'P'""")

view("dim_user_info", """
SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       strftime(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%Y-%m-%d') AS birthday
FROM customer""")

view("dim_base_province", """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, r_name AS area_code,
       'ISO' || n_nationkey AS iso_code, 'CN-' || n_nationkey AS iso_3166_2
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")

view("dim_sku_info", """
SELECT p_partkey AS id, p_name AS sku_name, CAST(p_retailprice AS DECIMAL(18,2)) AS sku_price,
       CAST(p_size AS BIGINT) AS spu_id, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS tm_id,
       CAST(ascii(p_type) * 100 + length(p_type) AS BIGINT) AS category3_id
FROM part""")

view("dim_spu_info", """
SELECT DISTINCT CAST(p_size AS BIGINT) AS id, 'spu ' || p_size AS spu_name FROM part""")

view("dim_base_trademark", """
SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS id, p_brand AS tm_name FROM part""")

view("dim_base_category3", """
SELECT DISTINCT CAST(ascii(p_type) * 100 + length(p_type) AS BIGINT) AS id, p_type AS name FROM part""")

view("favor_info", """
SELECT l_partkey AS sku_id, CAST((epoch_us(l_shipdate) // 1000) AS VARCHAR) AS create_time
FROM lineitem WHERE l_returnflag = 'N'""")

view("cart_info", """
SELECT l_partkey AS sku_id, CAST((epoch_us(l_shipdate) // 1000) AS VARCHAR) AS create_time
FROM lineitem WHERE l_returnflag = 'A'""")

view("refund_info", """
SELECT l_orderkey AS id, l_partkey AS sku_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS refund_amount,
       CAST((epoch_us(l_shipdate) // 1000) AS VARCHAR) AS create_time
FROM lineitem WHERE l_returnflag = 'R'""")

view("comment_info", """
SELECT l_orderkey AS id, l_partkey AS sku_id,
       CASE WHEN l_linenumber % 2 = 0 THEN '1201' ELSE '1203' END AS appraise,
       CAST((epoch_us(l_shipdate) // 1000) AS VARCHAR) AS create_time
FROM lineitem WHERE l_returnflag = 'R'""")

# change envelopes, flattened: after_* / before_* hold the map values
view("changes", """
SELECT 'binlog.shop.' || event_type AS topic,
       CASE WHEN k < 10 THEN 'DELETE' WHEN k < 40 THEN 'CREATE' ELSE 'UPDATE' END AS op,
       'shop' AS database, event_type AS table_name,
       CASE WHEN k < 10 THEN 'delete' WHEN k < 40 THEN 'insert' ELSE 'update' END AS type,
       CASE WHEN k < 40 AND k >= 10 THEN NULL ELSE lag(CAST(user_id AS VARCHAR)) OVER w END AS before_id,
       CASE WHEN k < 40 AND k >= 10 THEN NULL ELSE lag(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)) OVER w END AS before_value,
       CASE WHEN k < 40 AND k >= 10 THEN NULL ELSE lag(CAST(k AS VARCHAR)) OVER w END AS before_k,
       CASE WHEN k < 10 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS after_id,
       CASE WHEN k < 10 THEN NULL ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS after_value,
       CASE WHEN k < 10 THEN NULL ELSE CAST(k AS VARCHAR) END AS after_k,
       (epoch_us(ts) // 1000) AS ts_ms, event_id AS seq, user_id
FROM ev WINDOW w AS (PARTITION BY event_type, user_id ORDER BY event_id)""", ("ev",))

view("table_process", """
SELECT * FROM (VALUES
  ('view', 'insert', 'kafka', 'dwd_view', 'id,value', 'id', CAST(NULL AS VARCHAR)),
  ('view', 'update', 'kafka', 'dwd_view', 'id,k', 'id', NULL),
  ('click', 'insert', 'hbase', 'dim_click', 'id,k', 'id', NULL),
  ('signup', 'insert', 'clickhouse', 'signup_stats', 'id', 'id', NULL))
  AS t(source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend)""")

view("search_pages", """
SELECT doc_id, text AS full_word, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS rt
FROM documents""")


def _city(key: str) -> str:
    base = f"'C' || lpad(CAST({key} % 25 AS VARCHAR), 2, '0')"
    return f"CASE WHEN {key} % 7 = 0 THEN {base} || '市' ELSE {base} END"


def _tenths(c: str) -> str:
    return f"(CAST({c} // 10 AS VARCHAR) || '.' || CAST({c} % 10 AS VARCHAR))"


view("hotel_raw", f"""
SELECT p_partkey AS id, {_city('p_partkey')} AS city, p_name AS hotel_name, p_type AS hotel_type,
  CASE WHEN p_partkey % 3 = 0 THEN {_tenths('p_size')} || '分'
       WHEN p_partkey % 3 = 1 THEN {_tenths('p_size')} ELSE '' END AS score,
  CASE WHEN p_partkey % 2 = 0 THEN ' 共' || p_size || '条评论 ' ELSE '暂无评论' END AS comment_count,
  CASE p_partkey % 5
    WHEN 0 THEN '近' || 'S' || (p_partkey % 5) || ' · ' || p_name
    WHEN 1 THEN '''' || {_city('p_partkey')} || 'S' || (p_partkey % 5) || '"'
    WHEN 2 THEN 'S' || (p_partkey % 5) || chr(9) || chr(10)
    WHEN 3 THEN '近 ' || {_city('p_partkey')} || 'S' || (p_partkey % 5)
    ELSE 'S' || (p_partkey % 5) || ' · ' || '近' || p_type END AS address,
  CASE p_partkey % 4 WHEN 0 THEN '¥' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) || '起'
       WHEN 1 THEN CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) || '元'
       WHEN 2 THEN '' END AS price,
  'img/' || p_partkey AS picture
FROM part""")

view("sight_raw", f"""
SELECT p_partkey AS id, 'C' || lpad(CAST(p_partkey % 25 AS VARCHAR), 2, '0') AS city,
  CASE WHEN p_partkey % 11 = 0 THEN p_name || tag || '4A' ELSE p_name || tag END AS name,
  CAST(p_size AS VARCHAR) || '条点评' AS comment_count,
  CASE WHEN p_partkey % 3 = 0 THEN '暂无' ELSE {_tenths('p_size')} || '/5分' END AS comment_score,
  'rank ' || p_brand AS rank_class, p_retailprice / 100 AS heat_score,
  CASE p_partkey % 6
    WHEN 0 THEN 'S' || (p_partkey % 5) || '(东门)'
    WHEN 1 THEN '市' || 'S' || (p_partkey % 5) || ' 北'
    WHEN 2 THEN 'C' || lpad(CAST(p_partkey % 25 AS VARCHAR), 2, '0') || '市' || 'S' || (p_partkey % 5) || '（南）'
    WHEN 3 THEN '某省'
    WHEN 4 THEN 'S' || (p_partkey % 5) || ',' || 'x' || '、y'
    ELSE 'S' || (p_partkey % 5) || '#1号!' END AS address,
  '08:00-17:00' AS open_info, 'tel-' || p_partkey AS phone
FROM (SELECT *, CASE p_partkey % 7 WHEN 0 THEN '5A' WHEN 1 THEN '4A' WHEN 2 THEN '3A'
                  WHEN 3 THEN '2A' WHEN 4 THEN '1A' ELSE '' END AS tag FROM part) p""")

view("bus_raw", """
SELECT l_suppkey * 10000000 + l_partkey * 10 + l_linenumber AS id,
  'C' || lpad(CAST(s_nationkey % 25 AS VARCHAR), 2, '0') AS city,
  '[' || l_linenumber || '路]' AS line_name, l_linenumber || '路' AS bus_name,
  CASE WHEN l_partkey % 2 = 0 THEN 'up' ELSE 'down' END AS forward,
  CASE WHEN l_partkey % 3 = 0 THEN ' S' || (l_partkey % 5) || '公交站 ' ELSE 'S' || (l_partkey % 5) END AS station_name,
  '06:00-22:00' AS run_time, 'daily' AS run_time_desc,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE '公交公司：' || s_name END AS company,
  '2元' AS price, CAST(l_partkey % 50 AS INTEGER) AS station_id
FROM (SELECT DISTINCT l_suppkey, l_linenumber, l_partkey FROM lineitem) li
JOIN supplier ON l_suppkey = s_suppkey""")

view("gazetteer", """
SELECT CASE WHEN i >= 5 THEN 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '市' || 'S' || (i % 5) || '公交站'
            WHEN i % 5 < 3 THEN 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || 'S' || (i % 5)
            ELSE 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '市' || 'S' || (i % 5) END AS address,
       CAST(n_nationkey * 3.5 AS DOUBLE) AS lon, CAST(20.0 + i AS DOUBLE) AS lat, r_name AS province,
       CAST(100000 + n_nationkey * 100 + i AS VARCHAR) AS adcode, 'D' || (i % 5) AS district, 'T' || i AS town
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey, range(10) t(i)""")


def with_views(sql: str, *names: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS[n]:
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in order)
    return f"WITH {ctes}\n{sql}"
