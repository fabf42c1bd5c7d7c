"""Listing keys: F14-F23, P14-P17, U4, J10, E6."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import listings as LS
from ..operators.joins import geocode, has_coordinates
from . import fixtures as FX
from .catalog import register
from .oracle_views import view
from .oracle_views import with_views as V


# the oracle's own copy of the punctuation class
PUNCTUATION = "[\n`~!@#$%^&*()+=|{}':;',\\[\\].<>/?~！@#￥%……&*（）——+|{}【】‘；\r\t：”“’。， 、？]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------- DuckDB twins of F14-F23
def sql_hotel_comment_count(c):
    t = f"trim({c})"
    return (f"CASE WHEN contains({t}, '共') AND contains({t}, '条评论') "
            f"THEN TRY_CAST(trim(replace(replace({t}, '共', ''), '条评论', '')) AS INTEGER) ELSE 0 END")


def sql_hotel_score(s):
    return (f"CASE WHEN {s} IS NULL OR length({s}) = 0 THEN 0.0::DOUBLE "
            f"WHEN contains({s}, '分') THEN TRY_CAST(trim(replace({s}, '分', '')) AS DOUBLE) "
            f"ELSE TRY_CAST(trim({s}) AS DOUBLE) END")


def sql_price(p):
    return (f"CASE WHEN {p} IS NULL OR length({p}) = 0 THEN 0.0::DOUBLE "
            f"WHEN contains({p}, '起') AND contains({p}, '¥') "
            f"THEN TRY_CAST(trim(replace(replace({p}, '起', ''), '¥', '')) AS DOUBLE) ELSE 0.0::DOUBLE END")


def sql_hotel_address(city, a):
    a1 = a
    for ch in ("'", '"', "\r", "\t", "\n"):
        a1 = f"replace({a1}, {q(ch)}, '')"
    a2 = f"(CASE WHEN contains({a1}, ' · ') THEN trim(split_part({a1}, ' · ', 1)) ELSE {a1} END)"
    a3 = f"(CASE WHEN starts_with({a2}, '近') THEN trim(substr({a2}, 2)) ELSE {a2} END)"
    return f"(CASE WHEN contains({a3}, {city}) THEN {a3} ELSE {city} || {a3} END)"


def sql_rank_class(n):
    return ("CASE " + " ".join(f"WHEN contains({n}, '{t}') THEN '{t[0]}'" for t in ('5A', '4A', '3A', '2A', '1A'))
            + " ELSE '0' END")


def sql_name_without_rank(n):
    return ("CASE " + " ".join(f"WHEN contains({n}, '{t}') THEN replace({n}, '{t}', '')" for t in ('5A', '4A', '3A', '2A', '1A'))
            + f" ELSE {n} END")


def sql_review_count(t):
    return f"CASE WHEN contains({t}, '条点评') THEN TRY_CAST(trim(replace({t}, '条点评', '')) AS INTEGER) ELSE 0 END"


def sql_review_score(t):
    return (f"CASE WHEN contains({t}, '/5分') THEN TRY_CAST(trim(replace({t}, '/5分', '')) AS DOUBLE) "
            f"ELSE 0.0::DOUBLE END")


def sql_sight_address(city, a):
    for cut in ('(', ' ', '（', ',', '、'):
        a = f"split_part({a}, {q(cut)}, 1)"
    out = (f"(CASE WHEN starts_with({a}, '市') THEN {city} || '市' || {a} "
           f"WHEN contains({a}, '市') THEN trim({a}) "
           f"WHEN ends_with({a}, '省') THEN trim({a}) || {city} || '市' "
           f"ELSE {city} || '市' || {a} END)")
    return f"replace({out}, ' ', '')"


def sql_strip_punctuation(t):
    for ch in ("\u2003", " "):
        t = f"replace({t}, {q(ch)}, '')"
    t = f"regexp_replace({t}, {q(PUNCTUATION)}, '', 'g')"
    for ch in ("\u00a0", '"', "\n", "\r", "\t"):
        t = f"replace({t}, {q(ch)}, '')"
    return t


# ------------------------------------------------------------ scalar keys
@register("fn_hotel", V(f"""
SELECT id, {sql_price('price')} AS price, {sql_hotel_score('score')} AS score,
       {sql_hotel_comment_count('comment_count')} AS comment_count FROM hotel_raw""", "hotel_raw"))
def fn_hotel(spark, sf):
    """Comment count, score and price text parsers."""
    h = FX.hotel_raw(spark, sf)
    return h.select("id", T.price("price").alias("price"), T.hotel_score("score").alias("score"),
                    T.hotel_comment_count("comment_count").alias("comment_count"))


@register("fn_hotel_address", V(f"""
SELECT id, {sql_hotel_address('city', 'address')} AS analysis_address FROM hotel_raw""", "hotel_raw"))
def fn_hotel_address(spark, sf):
    """F17."""
    h = FX.hotel_raw(spark, sf)
    return h.select("id", T.hotel_address("city", "address").alias("analysis_address"))


@register("fn_rank", V(f"""
SELECT id, {sql_rank_class('name')} AS rank_class, {sql_name_without_rank('name')} AS name FROM sight_raw""",
                       "sight_raw"))
def fn_rank(spark, sf):
    """F18, F19."""
    s = FX.sight_raw(spark, sf)
    return s.select("id", T.rank_class("name").alias("rank_class"), T.name_without_rank("name").alias("name"))


@register("fn_sight", V(f"""
SELECT id, {sql_review_count('comment_count')} AS comment_count,
       {sql_review_score('comment_score')} AS comment_score FROM sight_raw""", "sight_raw"))
def fn_sight(spark, sf):
    """F20."""
    s = FX.sight_raw(spark, sf)
    return s.select("id", T.review_count("comment_count").alias("comment_count"),
                    T.review_score("comment_score").alias("comment_score"))


@register("fn_sight_address", V(f"""
SELECT id, {sql_sight_address('city', 'address')} AS address,
       {sql_strip_punctuation(sql_sight_address('city', 'address'))} AS clean_address FROM sight_raw""",
                                "sight_raw"))
def fn_sight_address(spark, sf):
    """F21, F22."""
    s = FX.sight_raw(spark, sf)
    a = T.sight_address("city", "address")
    return s.select("id", a.alias("address"), T.strip_punctuation(a).alias("clean_address"))


BETWEEN_SRC = "'正常情况下,单程' || p_size || '分,间隔' || (p_partkey % 20) || '分'"


@register("fn_between", V(f"""
SELECT p_partkey, CASE WHEN strpos(t, '单程') > 0 AND strpos(t, '分') >= strpos(t, '单程') + 2
                       THEN substr(t, strpos(t, '单程') + 2, strpos(t, '分') - strpos(t, '单程') - 2) END AS minutes
FROM (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '约' || p_size || '分钟,' || {BETWEEN_SRC}
                             ELSE {BETWEEN_SRC} END AS t FROM part)"""))
def fn_between(spark, sf):
    """text between two markers (run-time descriptions built from part)."""
    p = FX.table(spark, sf, "part")
    src = F.concat(F.lit("正常情况下,单程"), F.col("p_size").cast("string"), F.lit("分,间隔"),
                   (F.col("p_partkey") % 20).cast("string"), F.lit("分"))
    t = F.when(F.col("p_partkey") % 4 == 0,
               F.concat(F.lit("约"), F.col("p_size").cast("string"), F.lit("分钟,"), src)).otherwise(src)
    return p.select("p_partkey", T.between(t).alias("minutes"))


# ------------------------------------------------------------ cleaning keys
view("bus_clean", f"""
SELECT id, city, replace(replace(line_name, '[', ''), ']', '') AS line_name, bus_name AS bus_line_name,
       forward, station_name, run_time, run_time_desc,
       CASE WHEN company IS NULL THEN '' ELSE trim(replace(company, '公交公司：', '')) END AS company,
       price AS price_info, station_id, trim(city || stop) AS address,
       city || '_' || replace(replace(line_name, '[', ''), ']', '') || '_' || forward || '_' || stop AS dedup_key,
       city || '市' || stop AS geo_fallback
FROM (SELECT *, CASE WHEN contains(trim(station_name), '公交站') THEN trim(station_name)
                     ELSE trim(station_name) || '公交站' END AS stop FROM bus_raw)""", ("bus_raw",))

view("hotel_clean", f"""
SELECT id, city, hotel_name, hotel_type, {sql_hotel_score('score')} AS score,
       {sql_hotel_comment_count('comment_count')} AS comment_count, address,
       {sql_hotel_address('city', 'address')} AS analysis_address, {sql_price('price')} AS price, picture,
       'hotel_' || city || '_' || hotel_name || '_' || address AS dedup_key,
       CASE WHEN contains(hotel_name, city) THEN hotel_name ELSE city || hotel_name END AS geo_fallback
FROM hotel_raw""", ("hotel_raw",))

view("sight_clean", f"""
SELECT *, 'sight_' || city || '_' || name || '_' || clean_address AS dedup_key,
       city || '市' || clean_address AS geo_fallback
FROM (SELECT id, city, {sql_name_without_rank('name')} AS name, {sql_rank_class('name')} AS rank_class,
             heat_score, {sql_review_score('comment_score')} AS comment_score,
             {sql_review_count('comment_count')} AS comment_count, rank_class AS rank_info, address,
             {sql_strip_punctuation(sql_sight_address('city', 'address'))} AS clean_address, open_info, phone
      FROM sight_raw)""", ("sight_raw",))

BUS_COLS = ("id", "city", "line_name", "bus_line_name", "forward", "station_name", "company", "price_info",
            "station_id", "address", "dedup_key")
HOTEL_COLS = ("id", "city", "hotel_name", "score", "comment_count", "analysis_address", "price", "dedup_key")
SIGHT_COLS = ("id", "city", "name", "rank_class", "rank_info", "comment_count", "comment_score",
              "clean_address", "dedup_key")


@register("clean_bus", V(f"SELECT {', '.join(BUS_COLS)} FROM bus_clean", "bus_clean"))
def clean_bus(spark, sf):
    """P15."""
    return LS.clean_bus(FX.bus_raw(spark, sf)).select(*BUS_COLS)


@register("clean_hotel", V(f"SELECT {', '.join(HOTEL_COLS)} FROM hotel_clean", "hotel_clean"))
def clean_hotel(spark, sf):
    """P16."""
    return LS.clean_hotel(FX.hotel_raw(spark, sf)).select(*HOTEL_COLS)


@register("clean_sight", V(f"SELECT {', '.join(SIGHT_COLS)} FROM sight_clean", "sight_clean"))
def clean_sight(spark, sf):
    """P17 + F22."""
    return LS.clean_sight(FX.sight_raw(spark, sf)).select(*SIGHT_COLS)


@register("listing_dedup", V(f"""
SELECT {', '.join(BUS_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY id) AS rn FROM bus_clean) WHERE rn = 1""",
                             "bus_clean"))
def listing_dedup(spark, sf):
    """U4 within a run: first bus stop row per key."""
    return LS.dedup_listings(LS.clean_bus(FX.bus_raw(spark, sf))).select(*BUS_COLS)


@register("listing_incremental", V(f"""
SELECT {', '.join(HOTEL_COLS)} FROM hotel_clean h
WHERE dedup_key NOT IN (SELECT h2.dedup_key FROM hotel_clean h2 JOIN part ON h2.id = p_partkey
                        WHERE p_size <= 25)""", "hotel_clean"))
def listing_incremental(spark, sf):
    """U4 across runs: a second run over all hotels skips the keys the first
    run (hotels of size <= 25) already produced."""
    part = FX.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_size")
    hotels = LS.clean_hotel(FX.hotel_raw(spark, sf))
    first_run = hotels.join(part, "id").where(F.col("p_size") <= 25).drop("p_size")
    return LS.new_listings(hotels, first_run).select(*HOTEL_COLS)


GEO = ("lon", "lat", "province", "adcode", "district", "town")


def _geo_sql(src: str, key: str, cols: tuple[str, ...]) -> str:
    g = ", ".join(f"CASE WHEN g1.lon IS NOT NULL AND g1.lon <> 0 THEN g1.{f} ELSE g2.{f} END AS {f}" for f in GEO)
    return f"""
SELECT {', '.join('s.' + c for c in cols)}, {g},
       CASE WHEN g1.lon IS NOT NULL AND g1.lon <> 0 THEN 'address' WHEN g2.lon IS NOT NULL THEN 'fallback' END AS geo_source
FROM {src} s LEFT JOIN gazetteer g1 ON s.{key} = g1.address LEFT JOIN gazetteer g2 ON s.geo_fallback = g2.address"""


@register("geocode_lookup", V(_geo_sql("sight_clean", "clean_address", SIGHT_COLS), "sight_clean", "gazetteer"))
def geocode_lookup(spark, sf):
    """Gazetteer lookup with second-spelling fallback (all rows kept)."""
    s = LS.clean_sight(FX.sight_raw(spark, sf)).select(*SIGHT_COLS, "geo_fallback")
    return geocode(s, FX.gazetteer(spark, sf), "clean_address", "geo_fallback").drop("geo_fallback")


@register("geo_valid", V(f"""
SELECT * FROM ({_geo_sql("sight_clean", "clean_address", SIGHT_COLS)})
WHERE lat IS NOT NULL AND lon IS NOT NULL AND lon <> 0""", "sight_clean", "gazetteer"))
def geo_valid(spark, sf):
    """Rows with a non-zero longitude."""
    s = LS.clean_sight(FX.sight_raw(spark, sf)).select(*SIGHT_COLS, "geo_fallback")
    return has_coordinates(geocode(s, FX.gazetteer(spark, sf), "clean_address", "geo_fallback")) \
        .drop("geo_fallback")


HOTEL_OUT = ("id", "city", "hotel_name", "hotel_type", "score", "comment_count", "analysis_address",
             "price", "picture")


@register("e2e_listings", V(f"""
SELECT {', '.join(HOTEL_OUT)}, {', '.join(GEO)} FROM (
  {_geo_sql('''(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY id) AS rn
                FROM hotel_clean) WHERE rn = 1)''', 'analysis_address', HOTEL_OUT)})
WHERE lat IS NOT NULL AND lon IS NOT NULL AND lon <> 0""", "hotel_clean", "gazetteer"))
def e2e_listings(spark, sf):
    """Hotel listings -> clean -> dedup -> geocode -> valid coordinates -> sink columns."""
    h = LS.dedup_listings(LS.clean_hotel(FX.hotel_raw(spark, sf)))
    return LS.locate(h, FX.gazetteer(spark, sf), "analysis_address").select(*HOTEL_OUT, *GEO)


@register("e2e_bus", V(f"""
SELECT {', '.join(BUS_COLS)}, {', '.join(GEO)} FROM (
  {_geo_sql('''(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY id) AS rn
                FROM bus_clean) WHERE rn = 1)''', 'address', BUS_COLS)})
WHERE lat IS NOT NULL AND lon IS NOT NULL AND lon <> 0""", "bus_clean", "gazetteer"))
def e2e_bus(spark, sf):
    """E6 for bus stops: clean -> dedup -> geocode (stop, then city+市+stop)."""
    b = LS.dedup_listings(LS.clean_bus(FX.bus_raw(spark, sf)))
    return LS.locate(b, FX.gazetteer(spark, sf), "address").select(*BUS_COLS, *GEO)
