"""Quality rules by cross-document line frequency (native).

A line that many documents of one host carry is boilerplate.  Lines are
normalised and hashed, each (host, line) is counted once per document (of
documents with equal texts once: copies are not boilerplate), lines
above the limits are taken out, and a document that keeps too few of its words
is rejected.  The base statistics of a text are computed beside that.

Shape: the scan makes one narrow row per document (statistics plus the
distinct line digests), the count is a map-side combined aggregate over
(host, digest), and only digests above the limits come back to the documents.
Texts are never shuffled for the verdict.

Defined cases: a null or empty text has no words and fails the base rule; a
null host is a host of its own; a null id is an id; rows that repeat
(doc_id, text) get the same row each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, attach, let, materialize, text_key, words

SYMBOLS = "#*$%&|<>"

#: A line is boilerplate if at least this many documents of a host carry it ...
MIN_DOCS = 3
#: ... and these are more than this percentage of the host's documents.
HOST_PERCENT = 2
#: A document is depleted if more than this percentage of its words stand in such lines.
DEPLETED_PERCENT = 50
MIN_WORDS = 50
REPEAT_PERCENT = 50


def normal_line(line: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.regexp_replace(F.btrim(F.lower(line), F.lit(SPACES)), r"[\x20\x09-\x0D]+", " ")


def _lines(text: Column) -> Column:
    """The lines of ``text`` that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1),
                    lambda x: F.btrim(x, F.lit(SPACES)) != "")


def _windows(w: Column) -> Column:
    """A 64-bit digest of every 3-word window, in order."""
    return F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words that lie in a window found twice or more: flagged window starts
    in order, each adding the words up to the next start, 3 at most."""
    def repeated(s):
        near = lambda i: F.get(s, i)["h"]
        return F.array_sort(F.transform(F.filter(
            s, lambda x, i: ((i > 0) & (x["h"] == near(F.greatest(i - 1, F.lit(0)))))
            | (x["h"] == near(i + 1))), lambda x: x["i"]))

    order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(order, repeated), lambda at: F.aggregate(
        at, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"),
                                i.alias("last")), lambda acc: acc["n"]))


def base_statistics(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: the counts of the base rule, the digests of its
    distinct normalised lines with their words, and no text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", F.col(host).alias("host"), text.alias("text"),
                    text_key(F.col("text")).alias("th"), words(F.col("text")).alias("w"),
                    _lines(F.col("text")).alias("l"))
    d = d.select("doc_id", "host", "text", "th", "w", "l", _windows(F.col("w")).alias("g"))
    line = lambda x: F.struct(F.xxhash64(normal_line(x)).alias("line"),
                              F.size(words(x)).cast("bigint").alias("n"))
    return d.select(
        "doc_id", "host", "th",
        F.size("w").cast("bigint").alias("n_words"),
        F.char_length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("g")) == F.size("g"), F.lit(0).cast("bigint"))
        .otherwise(_covered(F.col("g"))).alias("n_repeat_words"),
        F.transform("l", line).alias("lines"),
    )


def frequent_lines(stats: DataFrame, min_docs: int = MIN_DOCS, host_percent: int = HOST_PERCENT) -> DataFrame:
    """(host, line): digests above both limits.  ``stats`` has a document of a
    host once per text: copies of a text say nothing about boilerplate."""
    lines = (stats.select("host", F.explode(F.array_distinct(
        F.transform("lines", lambda x: x["line"]))).alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs))
    hosts = stats.groupBy("host").agg(F.count("*").alias("host_docs"))
    return (attach(lines, hosts, "host", how="inner")
            .where(F.col("docs") * 100 > F.col("host_docs") * host_percent).select("host", "line"))


def line_frequency(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS,
                   host_percent: int = HOST_PERCENT, depleted_percent: int = DEPLETED_PERCENT) -> DataFrame:
    """Per row of ``docs``: the base counts, ``n_line_words`` (words in lines
    above the limits), ``removed_lines`` (their digests), ``base_failed``,
    ``depleted`` and ``kept``."""
    stats = materialize(base_statistics(docs, host), "line-stats")
    # every text of a host once: rows of one (host, text) have equal lines
    copies = stats.groupBy("host", "th").agg(F.count("*").alias("copies")).where("copies > 1")
    copies = materialize(copies, "copied-texts")
    own = ("host", "th")
    once = attach(stats, copies, *own, how="left_anti").select("host", "th", "lines").unionAll(
        attach(stats, copies, *own, how="left_semi").select("host", "th", "lines").dropDuplicates(["host", "th"]))
    once = materialize(once, "host-texts")
    hits = attach(once.select("host", "th", F.inline("lines")), frequent_lines(once, min_docs, host_percent),
                  "host", "line", how="left_semi")
    removed = (hits.groupBy("host", "th", "line").agg(F.sum("n").alias("n"))
               .groupBy("host", "th").agg(F.sum("n").alias("n_line_words"), F.collect_list("line").alias("removed_lines")))
    out = attach(stats.drop("lines"), materialize(removed, "removed-lines"), "host", "th")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    gone = F.coalesce("n_line_words", F.lit(0).cast("bigint"))
    return out.withColumns({
        "n_line_words": gone, "base_failed": failed,
        "depleted": 100 * gone > depleted_percent * F.col("n_words"),
    }).withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


def strip_lines(docs: DataFrame, verdict: DataFrame, host: str = "source") -> DataFrame:
    """The documents that ``verdict`` keeps, without the lines above the
    limits; all columns of ``docs`` stay."""
    side = verdict.where("kept").select("doc_id", "host", "th", "removed_lines").dropDuplicates(["doc_id", "host", "th"])
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("doc_id"),
                       docs[host].alias("host"), text_key(docs["text"]).alias("th"))
    left = attach(rows, side, "doc_id", "host", "th", how="inner")
    text = F.col("row.text")
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~F.array_contains(
        F.col("removed_lines"), F.xxhash64(normal_line(x)))), "\n")
    return left.select(*[F.when(F.col("removed_lines").isNull(), text).otherwise(kept).alias("text") if c == "text"
                         else F.col("row")[c].alias(c) for c in docs.columns])
