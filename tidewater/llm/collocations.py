"""Phrase collocation mining by weighted acyclic automata.

Every task turns its texts, shard by shard, into sorted n-grams and these into
a count transducer (``count_automata``).  The transducers are cut at common
prefix bounds, so that each prefix range can be united by itself: equal paths
are summed, and the count of a shorter phrase is the sum over its range of
paths.  A prefix that a bound cuts is summed from both ranges.  Phrases below
``min_count`` end there (a part of a phrase is never rarer than the phrase),
the rest is joined with the counts of its parts, scored and ranked.

Bounds come from a sample of documents; they decide how work is dealt out and
nothing else.  They are whole paths, so neither a frequent word nor a frequent
pair of words fills a range: a path comes once from every shard.

Cost: one scan, one shuffle of the automata (a path costs about the places of
its last two symbols), then small tables.  A shard holds ``SHARD_BYTES`` of
text and one text more, a range about ``RANGE_WORDS`` paths of each shard set.

Defined cases: a null or empty text has no words; a null language is ``und``;
rows count as often as they are given; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import count_automata as ca
from .common import materialize
from .rolling import text_buffer

MIN_COUNT, TOP, INSIDE_PERCENT = 10, 2000, 50
SCALE = 1_000_000
#: Bytes of text that a task turns into one set of automata.
SHARD_BYTES = 8 << 20
#: Paths of a prefix range, about; most ranges; documents that the bounds are taken from.
RANGE_WORDS, MAX_RANGES, SAMPLE_DOCS = 1_000_000, 1 << 16, 4096
#: Parts of a language that are ranked by themselves before the language is.
RANK_PARTS = 64
#: Of the sampled documents every so many words give a path.
SAMPLE_STEP = 16

BLOB = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("words", pa.list_(pa.binary())),
                  *[(f"{x}{k}", pa.list_(pa.int64() if (x, k) == ("next", ca.DEPTH - 1) else pa.int32()))
                    for k in range(ca.DEPTH) for x in ("first", "symbol", "next")]])
COUNTS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    names = {"int32": "int", "int64": "bigint", "string": "string"}
    kind = lambda t: (f"array<{'binary' if pa.types.is_binary(t.value_type) else names[str(t.value_type)]}>"
                      if pa.types.is_list(t) else names[str(t)])
    return ", ".join(f"`{f.name}` {kind(f.type)}" for f in schema)


def _shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[str, pa.Array]]:
    """(language, texts) of up to ``limit`` bytes and one row more."""
    held: dict[str, list[pa.Array]] = {}
    size = 0
    for b in batches:
        lang, text = b.column(0), b.column(1).cast(pa.large_string())
        n = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(np.cumsum(n[at:]), limit - size, side="right")) + at)
            part = lang.slice(at, to - at)
            for g in pc.unique(part).to_pylist():
                held.setdefault(g, []).append(text.slice(at, to - at).filter(pc.equal(part, g)))
            size += int(n[at:to].sum())
            at = to
            if size >= limit:
                yield from ((g, pa.concat_arrays(x)) for g, x in held.items())
                held, size = {}, 0
    yield from ((g, pa.concat_arrays(x)) for g, x in held.items())


def _counted(texts: pa.Array):
    """(words, sorted paths, counts) of some texts."""
    t = ca.tokens(*text_buffer(texts.fill_null("")))
    words, symbol = ca.symbols(t)
    path = ca.paths(symbol, t.piece, t.row)
    return words, *ca.summed(path, np.ones(len(path), dtype=np.int64), len(words))


def _blob(number: int, lang: str, a: ca.Automaton) -> dict:
    row = {"range": number, "lang": lang, "words": a.words}
    for k in range(ca.DEPTH):
        row |= {f"first{k}": a.first[k], f"symbol{k}": a.arcs[k][0], f"next{k}": a.arcs[k][1]}
    return row


def _batch(rows: list[dict]) -> pa.RecordBatch:
    """One record batch of automata, without a detour over Python numbers."""
    def column(f: pa.Field) -> pa.Array:
        if not pa.types.is_list(f.type):
            return pa.array([r[f.name] for r in rows], type=f.type)
        parts = [r[f.name] for r in rows]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        values = (pa.concat_arrays(parts) if f.name == "words"
                  else pa.array(np.concatenate(parts), type=f.type.value_type))
        return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), values)
    return pa.RecordBatch.from_arrays([column(f) for f in BLOB], schema=BLOB)


def _load(table: pa.Table, i: int) -> ca.Automaton:
    part = lambda name: table.column(name)[i].values
    ints = lambda name: part(name).to_numpy(zero_copy_only=False).astype(np.int64)
    return ca.Automaton(part("words").cast(pa.binary()), [ints(f"first{k}") for k in range(ca.DEPTH)],
                        [(ints(f"symbol{k}"), ints(f"next{k}")) for k in range(ca.DEPTH)])


def shard_automata(docs: DataFrame, bounds: list[tuple], shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Count transducers of every shard, cut at ``bounds`` ((lang, word, word, word) in order)."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _shards(batches, shard_bytes):
            words, path, weight = _counted(texts)
            known = words.to_pylist()
            number = sum(1 for b in bounds if b[0] < lang)
            cuts = [0, *[ca.cut(known, path, b[1:]) for b in bounds if b[0] == lang], len(path)]
            rows, size = [], 0
            for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                if lo == hi:
                    continue
                own, p = ca.used(words, path[lo:hi])
                rows.append(_blob(number + k, lang, ca.build(own, p, weight[lo:hi])))
                size += hi - lo
                if size > RANGE_WORDS // 4:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    return docs.mapInArrow(build, _ddl(BLOB))


def phrase_counts(automata: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, size, phrase, f) of every phrase of up to ``DEPTH`` words that occurs ``min_count`` times or more.
    ``size`` 0 is the language: its f counts all words."""
    def unite(table: pa.Table) -> pa.Table:
        out = []
        for lang in pc.unique(table.column("lang")).to_pylist():
            own = table.filter(pc.equal(table.column("lang"), lang))
            words, path, weight = ca.union([_load(own, i) for i in range(own.num_rows)])
            known = words.to_pylist()
            out.append({"lang": lang, "size": 0, "phrase": "", "f": int(weight.sum())})
            for k in range(1, ca.DEPTH + 1):
                at = ca.starts_of(path, k)
                f = np.add.reduceat(weight, at)
                keep = f >= min_count
                if k < ca.DEPTH:
                    keep[[0, -1]] = True  # the rest of these may lie in other ranges
                keep &= path[at, k - 1] > 0
                out += [{"lang": lang, "size": k, "phrase": b" ".join(known[s] for s in p[:k]).decode(), "f": n}
                        for p, n in zip(path[at[keep]].tolist(), f[keep].tolist())]
        return pa.Table.from_pylist(out, schema=COUNTS)

    parts = automata.groupBy("range").applyInArrow(unite, _ddl(COUNTS))
    return (parts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
            .where((F.col("f") >= min_count) | (F.col("size") == 0)))


def prefix_bounds(docs: DataFrame, range_words: int = RANGE_WORDS) -> list[tuple]:
    """Paths at even distances among those of some sampled documents; as many as the input's words ask for."""
    n = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(n, 1))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang in pc.unique(b.column(0)).to_pylist():
                words, path, weight = _counted(b.column(1).cast(pa.large_string()).filter(pc.equal(b.column(0), lang)))
                known = words.to_pylist()
                total = np.cumsum(weight)
                every = np.searchsorted(total, np.arange(SAMPLE_STEP // 2, int(total[-1]) if len(total) else 0, SAMPLE_STEP), side="right")
                yield pa.RecordBatch.from_pylist(
                    [{"lang": lang, "path": [known[s] for s in p]} for p in path[every].tolist()],
                    schema=pa.schema([("lang", pa.string()), ("path", pa.list_(pa.binary()))]))

    sampled = docs if share == 1.0 else docs.sample(share, seed=1)
    found = [(r.lang, *map(bytes, r.path)) for r in sampled.mapInArrow(pick, "lang string, path array<binary>").collect()]
    ranges = min(MAX_RANGES, int(len(found) * SAMPLE_STEP / share / range_words) + 1)
    found.sort()
    return sorted({found[len(found) * k // ranges] for k in range(1, ranges)})


def collocations(docs: DataFrame, lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP,
                 inside_percent: int = INSIDE_PERCENT, shard_bytes: int = SHARD_BYTES,
                 range_words: int = RANGE_WORDS) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``DEPTH`` words by the score of their weakest cut."""
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col("text").alias("text"))
    bounds = prefix_bounds(texts, range_words)
    counts = materialize(phrase_counts(shard_automata(texts, bounds, shard_bytes), min_count), "phrase-counts")
    n = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    f = counts.where("size > 0").select("lang", "phrase", "f")
    p = F.split("phrase", " ", -1)
    cand = counts.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"))

    # a phrase inside a longer candidate that is nearly as frequent goes
    longer = cand.where(F.col("size") == 3).select("lang", F.col("a").alias("over"), F.explode(F.array(
        F.array_join(F.slice(p, 1, 2), " "), F.array_join(F.slice(p, 2, 2), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    cand = (cand.join(longer, ["lang", "phrase"], "left")
            .where(F.col("over").isNull() | (100 * F.col("over") < inside_percent * F.col("a"))).drop("over"))

    # the parts of every cut, looked up in the counts
    cuts = cand.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.array_join(F.slice(p, F.lit(1), F.col("k")), " "),
                             "right": F.array_join(F.slice(p, F.col("k") + 1, F.col("size") - F.col("k")), " ")})
    part = lambda name, value: f.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    score = F.expr(f"(cast({SCALE} as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
                   " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("x"))
    # first within hashed parts of a language: what meets in one task is bounded, however many tasks bring rows
    best = best.select("lang", "phrase", "a", "x.l", "x.r", "x.score").withColumn(
        "part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    by_rank = [F.desc("score"), F.desc("a"), "phrase"]
    for keys in (("lang", "part"), ("lang",)):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by_rank))).where(F.col("rank") <= top)
    ranked = best.drop("part")
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
