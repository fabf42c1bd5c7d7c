"""Keyword and time keys: X1, P11, A4, E4 (SQL form), F1-F4."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import timefmt as TF
from ..functions.keywords import split_words, split_words_sql
from ..operators import aggregates as A
from ..schemas import PAGE_VIEW_MAPS
from ..sources.lines import read_json_table
from . import fixtures as FX
from .catalog import register
from .oracle_views import view
from .oracle_views import with_views as V

TSF = "'%Y-%m-%d %H:%M:%S'"

# letter runs outside the ideographs, and single ideographs
RUNS = r"""regexp_extract_all(regexp_replace(full_word, '[一-鿿]', ' ', 'g'), '[\p{L}\p{M}\p{N}]+')"""
CHARS = "regexp_extract_all(full_word, '[一-鿿]')"

view("words", f"""
SELECT doc_id, rt, lower(w) AS word FROM search_pages, unnest({RUNS}) t(w)
UNION ALL
SELECT doc_id, rt, w FROM search_pages, unnest({CHARS}) t(w)""",
     ("search_pages",))


@register("split_words", V("SELECT doc_id, word FROM words", "words"))
def split_words_q(spark, sf):
    """X1 over whole document texts."""
    return split_words(FX.search_pages(spark, sf), "full_word", keep=("doc_id",))


@register("split_words_dict", V(f"""
WITH p AS (SELECT s_suppkey AS id, '公交公司' || s_name || translate((s_suppkey::BIGINT * 7919 * 7919)::VARCHAR, '0123456789', '零一二三四五六七八九')
           || CASE WHEN s_suppkey % 2 = 0 THEN '中华人民共和国 Für' ELSE '人民公交站' END AS full_word FROM supplier),
d AS (SELECT DISTINCT w FROM (
  SELECT unnest(['人民', '共和国', '公交公司', '中华人民共和国']) AS w
  UNION ALL SELECT translate(p_partkey::VARCHAR, '0123456789', '零一二三四五六七八九') FROM part) WHERE length(w) > 1),
place AS (SELECT id, full_word, unnest(range(1, length(full_word) + 1)) AS i FROM p),
n AS (SELECT DISTINCT length(w) AS n FROM d),
hit AS (SELECT id, i, w FROM (SELECT id, i, substr(full_word, i, n) AS w FROM place, n WHERE i + n <= length(full_word) + 1) SEMI JOIN d USING (w))
SELECT id, lower(w) AS word FROM p, unnest({RUNS}) t(w)
UNION ALL SELECT id, w FROM hit
UNION ALL SELECT id, substr(full_word, i, 1) FROM place WHERE regexp_matches(substr(full_word, i, 1), '[一-鿿]')
  AND NOT EXISTS (SELECT 1 FROM hit h WHERE h.id = place.id AND h.i <= place.i AND place.i < h.i + length(h.w))"""))
def split_words_dict(spark, sf):
    """X1, fine-grained, with a dictionary that grows with the parts."""
    return split_words(FX.phrases(spark, sf), "text", keep=("id",), dictionary=FX.dictionary(spark, sf))


@register("keyword_stats", V(f"""
SELECT word AS keyword, count(*) AS ct, 'search' AS source,
       strftime(time_bucket(INTERVAL '10 seconds', rt, TIMESTAMP '1970-01-01'), {TSF}) AS stt,
       strftime(time_bucket(INTERVAL '10 seconds', rt, TIMESTAMP '1970-01-01') + INTERVAL '10 seconds', {TSF}) AS edt
FROM words GROUP BY word, time_bucket(INTERVAL '10 seconds', rt, TIMESTAMP '1970-01-01')""", "words"))
def keyword_stats(spark, sf):
    """A4: words per 10-second window (search time = 2024-01-01 + doc_id s)."""
    words = split_words(FX.search_pages(spark, sf), "full_word", keep=("rt",))
    return A.keyword_stats(words, "10 seconds")


def _page_view(spark, sf):
    """The declared page-view table (map columns, rt, 1 s watermark)."""
    rt = F.to_timestamp(F.from_unixtime((F.col("ts") / 1000).cast("long")))
    return read_json_table(FX.raw_log_lines(spark, sf), PAGE_VIEW_MAPS, rt, "1 second")


SEARCH_SQL = "SELECT item AS full_word, ts FROM page_log WHERE k <> 0 AND last_page_id = 'search' AND item IS NOT NULL"


@register("search_filter", V(f"""
SELECT full_word, strftime(epoch_ms(ts - ts % 1000), {TSF}) AS rt FROM ({SEARCH_SQL})""", "page_log"))
def search_filter(spark, sf):
    """P11 + F9: map access, previous page = search, item present."""
    t = _page_view(spark, sf)
    s = t.where((t.page["last_page_id"] == "search") & t.page["item"].isNotNull())
    return s.select(t.page["item"].alias("full_word"), F.date_format("rt", "yyyy-MM-dd HH:mm:ss").alias("rt"))


@register("e2e_keyword", V(f"""
WITH lines AS (SELECT text AS full_word, 1704067200000 + doc_id * 100 AS ts FROM documents
               WHERE coalesce(n_chars, 200) >= 200 AND text IS NOT NULL),
split AS (SELECT lower(w) AS word, ts FROM lines, unnest({RUNS}) t(w)
          UNION ALL SELECT w, ts FROM lines, unnest({CHARS}) t(w))
SELECT 'search' AS source,
       strftime(epoch_ms(ws), {TSF}) AS stt, strftime(epoch_ms(ws + 10000), {TSF}) AS edt,
       word AS keyword, count(*) AS ct
FROM (SELECT word, ts - ts % 10000 AS ws FROM split) GROUP BY word, ws"""))
def e2e_keyword(spark, sf):
    """E4 in SQL: JSON lines -> declared table -> search filter -> LATERAL word
    split of whole texts -> 10-second tumbling count per word."""
    name = f"page_view_{uuid.uuid4().hex[:8]}"
    rt = F.to_timestamp(F.from_unixtime((F.col("ts") / 1000).cast("long")))
    read_json_table(FX.search_lines(spark, sf), PAGE_VIEW_MAPS, rt, "1 second").createOrReplaceTempView(name)
    return spark.sql(f"""
        WITH full_words AS (
          SELECT page['item'] AS full_word, rt FROM {name}
          WHERE page['last_page_id'] = 'search' AND page['item'] IS NOT NULL),
        words AS (
          SELECT word, rt FROM full_words LATERAL VIEW explode({split_words_sql('full_word')}) t AS word),
        counted AS (
          SELECT window(rt, '10 seconds') AS w, word, count(*) AS ct FROM words
          GROUP BY window(rt, '10 seconds'), word)
        SELECT 'search' AS source, date_format(w.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(w.end, 'yyyy-MM-dd HH:mm:ss') AS edt, word AS keyword, ct
        FROM counted""")


@register("fn_time", V(f"""
SELECT seq, strftime(epoch_ms(ts + 28800000), {TSF}) AS text_cst,
       (epoch_us(strptime(strftime(epoch_ms(ts + 28800000), {TSF}), {TSF})) // 1000) - 28800000 AS millis_back,
       CAST(CAST(ts AS VARCHAR) AS BIGINT) AS millis_num
FROM page_log""", "page_log"))
def fn_time(spark, sf):
    """F1 (millis -> text at UTC+8), F2 (text at UTC+8 -> millis), F3."""
    p = FX.page_log(spark, sf)
    txt = TF.millis_to_text("ts")
    return p.select("seq", txt.alias("text_cst"), TF.text_to_millis(txt).alias("millis_back"),
                    TF.numeric_text_to_millis(F.col("ts").cast("string")).alias("millis_num"))


@register("fn_sql_time", V(f"""
SELECT seq, strftime(epoch_ms(s * 1000), {TSF}) AS txt, s AS secs,
       strftime(epoch_ms(s * 1000 - (s * 1000) % 10000), {TSF}) AS stt,
       strftime(epoch_ms(s * 1000 - (s * 1000) % 10000 + 10000), {TSF}) AS edt
FROM (SELECT seq, ts // 1000 AS s FROM page_log)""", "page_log"))
def fn_sql_time(spark, sf):
    """FROM_UNIXTIME, TO_TIMESTAMP, UNIX_TIMESTAMP, DATE_FORMAT and
    TUMBLE_START / TUMBLE_END (window start / end) in Spark SQL."""
    name = f"page_log_{uuid.uuid4().hex[:8]}"
    FX.page_log(spark, sf).createOrReplaceTempView(name)
    return spark.sql(f"""
        SELECT seq, txt, UNIX_TIMESTAMP(txt) AS secs,
               DATE_FORMAT(window(TO_TIMESTAMP(txt), '10 seconds').start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               DATE_FORMAT(window(TO_TIMESTAMP(txt), '10 seconds').end, 'yyyy-MM-dd HH:mm:ss') AS edt
        FROM (SELECT seq, FROM_UNIXTIME(ts DIV 1000) AS txt FROM {name})""")
