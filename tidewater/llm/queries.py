"""The registered queries of this subpackage and, where SQL can say the same,
their DuckDB statements.  Each applies its operator with production
parameters to its whole table and derives the columns that are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bit_sliced, codeword_language, collocations, complement_packing, conversation_repair, line_frequency,
               mixture, parity_join, perspectives, substring_units, suffix_dedup, url_templates, warc_index)
from .common import attach, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql
        return fn
    return deco


def spans_text(col: str, start: str = "start", end: str = "end"):
    """``start-end`` of each span, comma separated."""
    return F.array_join(F.transform(col, lambda x: F.concat_ws(
        "-", x[start].cast("string"), x[end].cast("string"))), ",")


@register("op3_source_mixture")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


@register("op4_unit_dedup", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
cut AS (SELECT r, doc_id, text, string_split(regexp_replace(text, '([.!?][ \t]+|[。！？]|\n)', '\1' || chr(57344), 'g'), chr(57344)) AS p
        FROM d WHERE text IS NOT NULL),
units AS (SELECT r, doc_id, text, unnest(p) AS piece, unnest(range(len(p))) AS no, len(p) AS n FROM cut),
placed AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY r ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s,
    CASE WHEN no + 1 = n OR regexp_matches(piece, '[。！？]$') THEN piece WHEN ends_with(piece, chr(10)) THEN piece[:-2]
         ELSE rtrim(piece, ' ' || chr(9)) END AS body FROM units),
worded AS (SELECT *, array_to_string(regexp_extract_all(lower(body), '[^\x20\x09-\x0D]+'), ' ') AS norm FROM placed),
keyed AS (SELECT r, no, doc_id, text, CASE WHEN strlen(norm) >= 40 THEN norm
  ELSE coalesce(lag(norm) OVER (PARTITION BY r ORDER BY no), '') || chr(10) || norm END AS key FROM worded WHERE norm <> ''),
ranked AS (SELECT r, no, dense_rank() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, text, no) > 1 AS gone FROM keyed),
told AS (SELECT w.*, coalesce(gone, false) AS gone FROM worded w LEFT JOIN ranked k ON k.r = w.r AND k.no = w.no)
SELECT d.doc_id, coalesce(max(n), 0)::BIGINT AS n_units, count(*) FILTER (gone)::BIGINT AS n_removed,
  coalesce(string_agg(s || '-' || (s + length(body)), ',' ORDER BY no) FILTER (gone), '') AS removed_spans,
  CASE WHEN max(no) IS NOT NULL THEN coalesce(string_agg(piece, '' ORDER BY no) FILTER (NOT gone), '') END AS kept_text
FROM d LEFT JOIN told k ON d.r = k.r GROUP BY d.r, d.doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_units.drop_repeated_units(table(spark, sf_dir, "documents"), unit="sentence")
    return out.select("doc_id", "n_units", F.size("removed").cast("bigint").alias("n_removed"),
                      spans_text("removed").alias("removed_spans"), "kept_text")


@register("op6_perspectives", r"""
WITH t AS (
  SELECT conv_id, 0::BIGINT AS part, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS name,
         replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, name AS assistant FROM t WHERE name <> 'system'),
r AS (
  SELECT t.*, assistant, name = assistant AS own,
    CASE WHEN name = 'system' THEN '<|system|>' WHEN name = assistant THEN '<|assistant|>'
         ELSE '<|user name=' || name || '|>' END || chr(10) AS head, text || '<|end|>' || chr(10) AS body,
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, assistant, part
     ORDER BY turn NULLS LAST, name, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS z FROM r)
SELECT conv_id, assistant, part, count(*) AS n_turns,
  string_agg(head || body, '' ORDER BY z) AS rendered,
  coalesce(string_agg((z - length(body)) || '-' || (z - 1), ',' ORDER BY z) FILTER (own), '') AS mask_spans
FROM o GROUP BY conv_id, assistant, part""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = perspectives.rotate(table(spark, sf_dir, "conversations"))
    return out.withColumn("mask_spans", spans_text("mask_spans"))


@register("op10_line_frequency", r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i+1], w[i+2]) AS c FROM win) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
raw AS (SELECT r, host, t, unnest(string_split(t, chr(10))) AS l FROM d),
line AS (SELECT r, host, t, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS lw,
         array_to_string(regexp_extract_all(lower(l), '[^\x20\x09-\x0D]+'), ' ') AS norm FROM raw
         WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM line GROUP BY r),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
often AS (SELECT l.host, l.norm FROM line l JOIN hosts h ON l.host IS NOT DISTINCT FROM h.host
          GROUP BY l.host, l.norm, h.n HAVING count(DISTINCT t) >= 3 AND count(DISTINCT t) * 100 > h.n * 2),
gone AS (SELECT l.r, sum(len(lw))::BIGINT AS n FROM line l JOIN often o
         ON l.host IS NOT DISTINCT FROM o.host AND l.norm = o.norm GROUP BY l.r),
s AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_line_words
  FROM d LEFT JOIN covered USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_line_words <= 50 * n_words AS kept FROM s""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_frequency.line_frequency(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "n_line_words", "base_failed", "kept")


@register("op7_bit_sliced_topk", r"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
a AS (SELECT DISTINCT vec_id, q FROM v WHERE vec_id % 50 = 0),
s AS (
  SELECT a.vec_id AS query_id, a.q, b.vec_id, b.r,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i]::HUGEINT * b.q[i])) AS score
  FROM a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
t AS (SELECT *, row_number() OVER (PARTITION BY query_id, q ORDER BY score DESC, vec_id, r)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score::BIGINT AS score FROM t WHERE rank <= 5""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@register("op9_ecoc_language")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codeword_language.identify(table(spark, sf_dir, "documents"))


@register("op1_warc_index", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
o AS (SELECT h, min(page_id) AS owner FROM p GROUP BY h)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(p.h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM p JOIN o ON p.h = o.h""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = warc_index.archive(table(spark, sf_dir, "pages"), min_bytes=0)
    return warc_index.read(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op5_complement_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complement_packing.pack(table(spark, sf_dir, "documents"))


@register("op2_suffix_array_dedup", r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
owner AS (SELECT min(r) AS r, doc_id, text, h, length(h) // 2 AS n FROM d GROUP BY doc_id, text, h),
w AS (SELECT r, pos, hash(substr(h, 2 * pos + 1, 400)) AS k FROM (
  SELECT r, h, unnest(range(greatest(n - 199, 0))) AS pos FROM owner)),
again AS (SELECT r, pos FROM w SEMI JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) USING (k)),
near AS (SELECT *, pos > lag(pos) OVER (PARTITION BY r ORDER BY pos) + 200 IS NOT FALSE AS fresh FROM again),
runs AS (SELECT r, min(pos) AS s, max(pos) + 200 AS e FROM (
  SELECT r, pos, sum(fresh::INT) OVER (PARTITION BY r ORDER BY pos ROWS UNBOUNDED PRECEDING) AS g FROM near) GROUP BY r, g),
keep AS (
  SELECT o.r, coalesce(lag(e) OVER x, 0) AS a, s AS z FROM owner o JOIN runs ON runs.r = o.r WINDOW x AS (PARTITION BY o.r ORDER BY s)
  UNION ALL SELECT o.r, coalesce(max(e), 0), any_value(n) FROM owner o LEFT JOIN runs ON runs.r = o.r GROUP BY o.r),
kept AS (SELECT k.r, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS h FROM keep k JOIN owner o ON o.r = k.r GROUP BY k.r),
told AS (
  SELECT o.doc_id, o.text, n, (SELECT count(*) FROM runs WHERE runs.r = o.r) AS spans, k.h FROM owner o JOIN kept k ON k.r = o.r)
SELECT d.doc_id, n::BIGINT AS n_bytes, (n - length(t.h) // 2)::BIGINT AS n_removed, spans::BIGINT AS n_spans, sha256(unhex(t.h)) AS kept_sha256
FROM d JOIN told t ON d.doc_id IS NOT DISTINCT FROM t.doc_id AND d.text = t.text""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), suffix_dedup.LENGTH, keep="none")
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op8_parity_sketch_join", r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, text, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT r, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS k FROM sh GROUP BY r),
node AS (SELECT k, min(r) AS r, any_value(n) AS n FROM n GROUP BY k),
one AS MATERIALIZED (SELECT sh.r, s FROM sh JOIN node ON sh.r = node.r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM one a JOIN one b ON a.s = b.s AND a.r < b.r GROUP BY a.r, b.r),
links AS (SELECT x, y FROM pairs JOIN node a ON a.r = x JOIN node b ON b.r = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT r, r FROM node UNION SELECT reach.x, ways.y FROM reach JOIN ways ON reach.y = ways.x),
ids AS (SELECT n.r, node.r AS node, doc_id FROM n JOIN node ON n.k = node.k JOIN d ON d.r = n.r),
least AS (SELECT reach.x AS node, min(doc_id) AS c FROM reach JOIN ids ON ids.node = reach.y GROUP BY reach.x),
copies AS (
  SELECT node, count(*) AS c FROM (SELECT DISTINCT node, d.doc_id, text FROM ids JOIN d ON d.r = ids.r) GROUP BY node),
degree AS (
  SELECT c.node, any_value(c.c) - 1 + coalesce(sum(o.c), 0) AS n_links
  FROM copies c LEFT JOIN ways ON ways.x = c.node LEFT JOIN copies o ON o.node = ways.y GROUP BY c.node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, CASE WHEN n.n IS NULL THEN d.doc_id ELSE least.c END AS component_id,
  coalesce(degree.n_links, 0)::BIGINT AS n_links
FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN ids ON ids.r = d.r LEFT JOIN least ON least.node = ids.node
LEFT JOIN degree ON degree.node = ids.node""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = parity_join.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "n_links")


@register("op13_phrase_collocations", r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
longer AS (
  SELECT lang, phrase, max(a) AS over FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE size = 3) GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN longer o ON c.size = 2 AND c.lang = o.lang AND c.phrase = o.phrase
         WHERE o.over IS NULL OR 100 * o.over < 50 * c.a),
cut AS (SELECT *, unnest(range(1, size)) AS k FROM kept),
scored AS (
  SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, k,
    ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:k], ' ')
           JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[k + 1:cut.size], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults by the checksum of ``conv_id:turn``: a row is lost,
    emptied, loses its sentence ends, comes twice, or is said by the user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    case = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.coalesce("text", space)
    out = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), case.alias("case"))
    out = out.where("`case` <> 0").select(
        "conv_id", "turn", F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("case") == 3, 2).otherwise(1))).alias("copy"))
    return out.drop("copy")


@register("op12_conversation_repair", r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda x: ord(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k
  FROM conversations, crc),
dam AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM src WHERE k <> 0),
pos AS (
  SELECT *, coalesce(conv_id::VARCHAR, 'none') AS cid,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM dam),
r AS MATERIALIZED (
  SELECT *, body = '' AS blank, body <> '' AND nth > 1 AS dup,
    body <> '' AND nth = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS cut, left(role, 1) AS initial,
    CASE WHEN body = '' OR nth > 1 THEN 'x' WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS kind FROM pos),
states AS (SELECT unnest(['E', 'S', 'U', 'A']) AS st),
edge AS (
  SELECT st, kind, st AS nx, 3 AS c, 'D' AS l FROM states, (SELECT unnest(['s', 'u', 'a', 'o', 'x']) AS kind)
  UNION ALL SELECT 'E', 's', 'S', 0, 'K'
  UNION ALL SELECT st, 'u', 'U', 0, 'K' FROM states WHERE st <> 'U'
  UNION ALL SELECT 'U', 'u', 'U', 2, 'IK'
  UNION ALL SELECT 'U', 'a', 'A', 0, 'K'
  UNION ALL SELECT st, 'a', 'A', 2, 'IK' FROM states WHERE st <> 'U'
  UNION ALL SELECT st, kind, CASE WHEN (st = 'U') = (l = 'R') THEN 'A' ELSE 'U' END, 2 * len(l), l
    FROM states, (SELECT unnest(['s', 'u', 'a', 'o']) AS kind), (SELECT unnest(['R', 'IR']) AS l)),
v AS (
  SELECT DISTINCT cid, 0::BIGINT AS i, 'E' AS st, 0::BIGINT AS c, '' AS t FROM r
  UNION ALL
  SELECT cid, i, nx, c, t FROM (
    SELECT v.cid, r.i, e.nx, (v.c + e.c + CASE WHEN r.cut AND e.l <> 'D' THEN 1 ELSE 0 END)::BIGINT AS c, v.t || e.l AS t,
      row_number() OVER (PARTITION BY v.cid, e.nx ORDER BY v.c + e.c + CASE WHEN r.cut AND e.l <> 'D' THEN 1 ELSE 0 END, v.t || e.l) AS best
    FROM v JOIN r ON r.cid = v.cid AND r.i = v.i + 1 JOIN edge e ON e.st = v.st AND e.kind = r.kind) WHERE best = 1),
n AS (
  SELECT cid, max(i) AS n, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (bad) AS illegal
  FROM (SELECT *, i > 1 AND lag(initial) OVER (PARTITION BY cid ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS bad FROM r)
  GROUP BY cid),
done AS (
  SELECT v.cid, c + CASE st WHEN 'S' THEN 4 WHEN 'U' THEN 2 ELSE 0 END AS cost,
    t || CASE st WHEN 'S' THEN 'II' WHEN 'U' THEN 'I' ELSE '' END AS audit
  FROM v JOIN n ON v.cid = n.cid AND v.i = n.n
  QUALIFY row_number() OVER (PARTITION BY v.cid ORDER BY c + CASE st WHEN 'S' THEN 4 WHEN 'U' THEN 2 ELSE 0 END,
    t || CASE st WHEN 'S' THEN 'II' WHEN 'U' THEN 'I' ELSE '' END) = 1),
steps AS (SELECT cid, unnest(string_split(audit, '')) AS e, unnest(range(len(audit))) AS k FROM done WHERE audit <> ''),
told AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS o FROM steps
  WINDOW w AS (PARTITION BY cid ORDER BY k ROWS UNBOUNDED PRECEDING)),
kept AS (
  SELECT told.cid, e, k, o, role, text, bool_or(e = 'K' AND o = 1 AND initial = 's') OVER (PARTITION BY told.cid) AS sys
  FROM told LEFT JOIN r ON r.cid = told.cid AND r.i = told.i AND e <> 'I' WHERE e <> 'D'),
said AS (
  SELECT cid, sha256(string_agg(CASE WHEN e = 'K' THEN role
    WHEN (o - CASE WHEN sys THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS h FROM kept GROUP BY cid)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, 'none') AS cid FROM conversations) c
LEFT JOIN n ON c.cid = n.cid LEFT JOIN done ON c.cid = done.cid LEFT JOIN said ON c.cid = said.cid""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    placed, edits, totals = conversation_repair.repair(damaged(given))
    out = attach(given.select("conv_id").distinct(), totals, "conv_id")
    out = attach(out, conversation_repair.digests(placed, edits), "conv_id")
    zero = lambda n: F.coalesce(n, F.lit(0).cast("bigint")).alias(n)
    return out.select("conv_id", *[zero(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


URL_RULES = [url_templates.Rule(*r) for r in (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"))]


def _level_sql(k: int) -> str:
    """One level of the tree: from cells c{k} to c{k + 1}."""
    share = "(b + 4 * {}) / (n + 4)"
    return f"""
here{k} AS (
  SELECT host, node, segs[{k + 1}] AS segment, array_to_string(list_transform(segs[{k + 2}:], lambda x:
    CASE WHEN x = '$' THEN '$' WHEN contains(x, '#') THEN '#' ELSE 'a' END), '/') AS form,
    sum(urls) AS urls, sum(labelled) AS labelled, sum(blocked) AS blocked
  FROM c{k} WHERE len(segs) > {k} GROUP BY ALL),
segs{k} AS (SELECT *, sum(urls) OVER (PARTITION BY host, node) AS total FROM (
  SELECT host, node, segment, sum(urls) AS urls FROM here{k} GROUP BY ALL)),
known{k} AS (
  SELECT h.*, CASE WHEN h.segment = '$' THEN '$' WHEN s.urls >= 3 AND 100 * s.urls >= 2 * total THEN h.segment ELSE '*' END AS branch
  FROM here{k} h JOIN segs{k} s ON h.host = s.host AND h.node = s.node AND h.segment = s.segment),
forms{k} AS (SELECT host, node, branch, form, sum(urls) AS urls, sum(labelled) AS labelled, sum(blocked) AS blocked
  FROM known{k} GROUP BY ALL),
branch{k} AS (
  SELECT host, node, branch, arg_min(form, ROW(-urls, form)) AS form, sum(labelled)::DOUBLE AS n, sum(blocked)::DOUBLE AS b
  FROM forms{k} GROUP BY ALL),
near{k} AS (
  SELECT *, lag(branch) OVER w AS lbranch, lag(form) OVER w AS lform, lag(n) OVER w AS ln, lag(b) OVER w AS lb FROM (
    SELECT *, n = 0 AS unlabelled, {share.format("base")} AS share FROM branch{k}, base)
  WINDOW w AS (PARTITION BY host, node ORDER BY form, unlabelled, share, branch)),
first{k} AS (
  SELECT *, (lbranch IS NULL OR lform <> form OR (ln = 0) <> unlabelled OR branch = '$' OR lbranch = '$'
    OR (lb * n - b * ln) * (lb * n - b * ln) * (ln + n) > 3.841::DOUBLE * ln * n * (lb + b) * (ln + n - (lb + b)))::INT AS first FROM near{k}),
group{k} AS (SELECT host, node, branch, sum(first) OVER (PARTITION BY host, node ORDER BY form, unlabelled, share, branch
  ROWS UNBOUNDED PRECEDING) AS grp FROM first{k}),
name{k} AS (
  SELECT host, node, grp, CASE WHEN count(*) = 1 THEN min(branch) ELSE '{{' || string_agg(branch, '|' ORDER BY branch) || '}}' END AS label
  FROM group{k} GROUP BY ALL),
label{k} AS (
  SELECT DISTINCT x.host, x.node, x.segment, n.label FROM known{k} x
  JOIN group{k} g ON g.host = x.host AND g.node = x.node AND g.branch = x.branch
  JOIN name{k} n ON n.host = g.host AND n.node = g.node AND n.grp = g.grp),
told{k} AS (
  SELECT c.* EXCLUDE (node), CASE WHEN label IS NULL THEN c.node ELSE c.node || '/' || label END AS node, label IS NULL AS ended
  FROM c{k} c LEFT JOIN label{k} l ON l.host = c.host AND l.node = c.node AND l.segment = c.segs[{k + 1}]),
own{k} AS (SELECT host, node, share, pooled, sum(labelled) AS n, sum(blocked) AS b FROM told{k} WHERE NOT ended GROUP BY ALL),
pool{k} AS (SELECT node, {share.format("pooled")} AS p FROM (
  SELECT node, pooled, sum(n) AS n, sum(b) AS b FROM own{k} GROUP BY ALL)),
new{k} AS (SELECT o.host, o.node, {share.format("((share + p) / 2)")} AS s, p FROM own{k} o JOIN pool{k} q ON o.node = q.node),
c{k + 1} AS MATERIALIZED (
  SELECT t.* EXCLUDE (share, pooled, ended), CASE WHEN ended THEN share ELSE s END AS share, CASE WHEN ended THEN pooled ELSE p END AS pooled
  FROM told{k} t LEFT JOIN new{k} x ON x.host = t.host AND x.node = t.node)"""


URL_SQL = r"""
WITH u AS (
  SELECT page_id, row_number() OVER () AS row, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, row, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rhost, rpath, rverdict) AS (VALUES """ + ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES) + r"""),
x AS (
  SELECT *, rhost || rpath AS rule, list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda s: s <> '') || ['$'] AS every
  FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY len(rhost || rpath) DESC NULLS LAST) = 1),
cut AS MATERIALIZED (
  SELECT *, CASE WHEN len(every) <= 4 THEN every ELSE every[:3] || [array_to_string(every[4:], '/')] END AS segs FROM x),
cell AS (
  SELECT host, segs, count(*) AS urls, count(rverdict) AS labelled, count(*) FILTER (rverdict = 'block') AS blocked
  FROM (SELECT DISTINCT host, path, segs, rverdict FROM cut) GROUP BY host, segs),
base AS (SELECT coalesce(sum(blocked) / sum(labelled), 0)::DOUBLE AS base FROM cell),
c0 AS MATERIALIZED (
  SELECT cell.*, '' AS node, (b + 4 * base) / (n + 4) AS share, base AS pooled FROM cell, base,
    (SELECT host AS h, sum(labelled) AS n, sum(blocked) AS b FROM cell GROUP BY host) WHERE h = host),""" + ",".join(
    map(_level_sql, range(url_templates.LEVELS))) + r"""
SELECT page_id, cut.host, cut.path, rule, node AS template, coalesce(rverdict, CASE WHEN share >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM cut JOIN c4 ON c4.host = cut.host AND c4.segs = cut.segs"""


@register("op11_url_templates", URL_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_templates.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "template", "verdict")
