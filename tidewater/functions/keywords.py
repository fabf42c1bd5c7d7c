"""Keyword tokenizer (X1) as built-in expressions.

Rules (our own; the reference's segmenter dictionary is not part of it):
letters, combining marks and digits of any script but CJK ideographs form
lower-cased runs ("Für" is one word); every CJK ideograph is a word of its
own; with a dictionary table, all its words that occur are words, overlapping
ones too (fine-grained), and single ideographs only where none of them covers
the place.  Null or blank text gives no rows.  Without a dictionary everything
is JVM-side (``regexp_extract_all`` + ``explode``; the SQL form is ``LATERAL
VIEW explode(<split_words_sql(col)>)``); a dictionary within the broadcast limit
is a multi-pattern automaton in an Arrow UDF, a larger one is joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_limit, estimated_bytes

try:
    import ahocorasick
except ImportError:  # the joined form works without it
    ahocorasick = None

LETTER_RUN = r"[\p{L}\p{M}\p{N}&&[^一-鿿]]+"
CJK_CHAR = "[一-鿿]"
CJK_RUN = "[一-鿿]{2,}"
GRAMS_EACH = 200_000   # grams of texts that one task joins with a dictionary
WORD = f"{LETTER_RUN}|{CJK_CHAR}"   # one pass finds both kinds


def word_array(text: Column | str) -> Column:
    """Array of the letter runs and single CJK characters, lower-cased (a
    no-op on CJK), from one regex pass."""
    t = F.col(text) if isinstance(text, str) else text
    return F.transform(F.regexp_extract_all(t, F.lit(WORD), 0), lambda w: F.lower(w))


def split_words_sql(col: str) -> str:
    """The same array as a Spark SQL expression (for LATERAL VIEW explode)."""
    pattern = WORD.replace("\\", "\\\\")  # backslashes of a SQL string literal
    return f"transform(regexp_extract_all({col}, '{pattern}', 0), w -> lower(w))"


def split_words(df: DataFrame, text: str, out: str = "word", keep: tuple[str, ...] | None = None,
                dictionary: DataFrame | None = None, dict_col: str = "word") -> DataFrame:
    """One row per word of ``text``; other columns kept (``keep``)."""
    keep = tuple(c for c in df.columns if c != text) if keep is None else keep
    if dictionary is None:
        return df.select(*keep, F.explode(word_array(text)).alias(out))
    letters = df.select(*keep, F.explode(F.transform(F.regexp_extract_all(F.col(text), F.lit(LETTER_RUN), 0), F.lower)).alias(out))
    vocab = (dictionary.select(F.col(dict_col).alias("w")).where(F.col("w").rlike(f"^{CJK_RUN}$")))
    size = estimated_bytes(dictionary)
    if ahocorasick is not None and size is not None and size <= broadcast_limit(dictionary):
        known = [r.w for r in vocab.distinct().collect()]  # a dictionary within the broadcast limit
        return df.select(*keep, F.explode(_automaton_udf(df.sparkSession.sparkContext.broadcast(known))(F.col(text))).alias(out))
    return letters.unionByName(_joined_runs(df.select(*keep, F.col(text).alias("_text")), vocab, keep, out))


def _cover(text: str, hits: list[tuple[int, int]]) -> list[str]:
    """The words that ``hits`` (start, end) find in ``text`` and the ideographs that none of them covers."""
    free = bytearray(b"\1" * len(text))
    for i, j in hits:
        free[i:j] = bytes(j - i)
    return [text[i:j] for i, j in hits] + [c for c, f in zip(text, free) if f and "一" <= c <= "鿿"]


def _automaton_udf(words):
    """Letter runs, dictionary words and uncovered ideographs of a text, the
    words found by one pass of a multi-pattern automaton (built once a task)."""
    @F.pandas_udf("array<string>")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for w in words.value:
            automaton.add_word(w, len(w))
        if words.value:
            automaton.make_automaton()
        runs = regex.compile(LETTER_RUN.replace("&&", "--").replace("[^一-鿿]", "[一-鿿]"), regex.V1)
        for texts in batches:
            out = []
            for t in texts:
                if t is None:
                    out.append([])
                    continue
                hits = [(end + 1 - n, end + 1) for end, n in automaton.iter(t)] if words.value else []
                out.append([w.lower() for w in runs.findall(t)] + _cover(t, hits))
            yield pd.Series(out)
    return tokens


def _joined_runs(df: DataFrame, vocab: DataFrame, keep: tuple[str, ...], out: str) -> DataFrame:
    """The same words of ideograph runs for a dictionary beyond the broadcast
    limit: every different run is cut into the grams of the dictionary's word
    lengths, joined with it once, and joined back by its text.  Grams and words
    are dealt to as many tasks as the number of grams asks for."""
    runs = df.select(*keep, F.explode(F.regexp_extract_all(F.col("_text"), F.lit("[一-鿿]+"), 0)).alias("_run"))
    lengths = sorted(r[0] for r in vocab.select(F.length("w")).distinct().collect())  # one number per word length
    if not lengths:
        return runs.select(*keep, F.explode(F.split("_run", "")).alias(out))
    places = runs.agg(F.sum(F.length("_run"))).first()[0] or 0  # one number
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-places * len(lengths) // GRAMS_EACH))
    each = runs.select("_run").repartition(parts, "_run").distinct()
    gram = lambda n: F.when(F.length("_run") >= n, F.transform(
        F.sequence(F.lit(0), F.length("_run") - n), lambda i: F.struct(
            i.alias("i"), F.substring(F.col("_run"), i + 1, F.lit(n)).alias("w"))))
    grams = F.flatten(F.filter(F.array(*[gram(n) for n in lengths]), lambda x: x.isNotNull()))
    known = vocab.repartition(parts, "w").distinct()
    found = each.select("_run", F.inline(grams)).repartition(parts, "w").join(known, "w")
    hits = found.repartition(parts, "_run").groupBy("_run").agg(F.collect_list(F.struct("i", "w")).alias("hits"))
    place = F.sequence(F.lit(0), F.length("_run") - 1)
    free = F.filter(place, lambda p: ~F.exists("hits", lambda h: (h["i"] <= p) & (p < h["i"] + F.length(h["w"]))))
    words = F.when(F.col("hits").isNull(), F.split("_run", "")).otherwise(F.concat(
        F.transform("hits", lambda h: h["w"]), F.transform(free, lambda p: F.substring(F.col("_run"), p + 1, F.lit(1)))))
    cut = each.join(hits, "_run", "left").select("_run", words.alias("_words"))
    return runs.join(cut, "_run").select(*keep, F.explode("_words").alias(out))
