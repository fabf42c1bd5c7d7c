"""Mixing sources to target weights by iterative proportional fitting.

Tokens are white-space words (any of the six separators, runs count once).
Token counts are summed per cell of (source, language, topic).  The cell table
is raked until its margins meet the target shares of every dimension, each
cell gets the rate by which its tokens must be thinned, and documents are
sampled by that calibrated probability.

Every value of a dimension has a margin of its own.  The cell table has a row
per combination that occurs; one of at most ``CELLS`` rows is raked on the
driver, a larger one by grouped sums per dimension, written per step.  Texts
are read once; only a cell table above ``CELLS`` rows makes ``sample`` shuffle
them, for the join with it.

Defined cases: a null value of a dimension is a value of its own; a null or
empty text has no tokens and probability 1 of its cell's rate rule (rate 0
cells aside); a target for a value that has no tokens is spread over the
others; rows that repeat id and text are drawn alike, rows with a null or shared
id and different texts are not: the draw depends on id, text and seed; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import SPACES, discard, materialize, text_key
from .rolling import text_buffer, word_counts

#: Largest cell table that is raked on the driver and broadcast.
CELLS = 1 << 16
#: Target share of a value: its share to this power, so that small ones gain and large ones lose.
TEMPER = 0.7
#: Tokens that the mixture shall keep, of all tokens.
BUDGET = 0.9
SEED = 17
ROUNDS, TOLERANCE = 500, 1e-9


def count_of(text: Column, mark: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(mark), F.lit("")))


def with_tokens(docs: DataFrame) -> DataFrame:
    """``docs`` with its words counted as ``n_tokens`` in place of ``text``."""
    keep = docs.drop("text")
    names = [*keep.columns, "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = pa.array(word_counts(*text_buffer(b.column("text"))), pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names[:-1]), counts], names=names)

    return (docs.withColumn("text", F.coalesce("text", F.lit("")))
            .mapInArrow(run, StructType([*keep.schema, StructField("n_tokens", LongType())])))


def topic(text: Column) -> Column:
    """The form of a text, which stands in for a topic: the tables have none."""
    t = F.coalesce(text, F.lit(""))
    n = F.char_length(t)
    marks = F.regexp_count(t, F.lit("[#*$%&|<>{}=]"))
    return (F.when(F.btrim(t, F.lit(SPACES)) == "", "empty").when(marks * 50 > n, "marked")
            .when(count_of(t, "\n") * 80 > n, "listed").when(n < 1000, "brief").otherwise("prose"))


def dimensions(source: str = "source", lang: str = "lang", text: str = "text") -> dict[str, Column]:
    return {"source": F.col(source), "lang": F.col(lang), "topic": topic(F.col(text))}


def _label(c: Column) -> Column:
    """``=value``, or (none) for null."""
    return F.when(c.isNull(), F.lit("(none)")).otherwise(F.concat(F.lit("="), c))


def rake_cells(weights: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS,
               tolerance: float = TOLERANCE) -> np.ndarray:
    """``weights`` of the cells scaled along the dimensions in turn until each margin meets its target
    (shares that sum to 1); ``codes`` has the place of each cell's value in the target of each dimension."""
    w = weights / weights.sum() if weights.sum() else weights.astype(float)
    for _ in range(rounds):
        worst = 0.0
        for code, target in zip(codes, targets):
            margin = np.bincount(code, weights=w, minlength=len(target))
            with np.errstate(divide="ignore", invalid="ignore"):
                factor = np.where(margin > 0, target / margin, 0.0)
            worst = max(worst, float(np.abs(margin - target).max()))
            w = w * factor[code]
        if worst < tolerance:
            break
    return w


def rake(seed: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS,
         tolerance: float = TOLERANCE) -> np.ndarray:
    """``rake_cells`` of a full array, whose axes are the dimensions."""
    codes = [c.ravel() for c in np.indices(seed.shape)]
    return rake_cells(seed.ravel(), codes, targets, rounds, tolerance).reshape(seed.shape)


def rates(tokens_of: np.ndarray, weights: np.ndarray, budget: float) -> np.ndarray:
    """Probability per cell, proportional to weight / tokens and at most 1,
    with the one scale at which the kept tokens meet the budget (or every cell is kept whole)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.where(tokens_of > 0, weights / tokens_of, 0.0)
    want, live = budget * tokens_of.sum(), r > 0
    if not live.any():
        return np.ones_like(r)
    low, high = 0.0, 1.0 / r[live].min()
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if (tokens_of * np.minimum(1, mid * r)).sum() < want else (low, mid)
    return np.where(live, np.minimum(1, high * r), 1.0)


def draw(doc_id: Column, th: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the id and the text's digest."""
    return F.pmod(F.xxhash64(doc_id, th, F.lit(seed)), F.lit(1 << 53)).cast("double") / float(1 << 53)


def _solve(cells: pa.Table, dims: list[str], targets: dict[str, dict[str, float]], temper: float,
           budget: float) -> pa.Table:
    """``cells`` (labels, n) with weight and probability."""
    size = cells.column("n").to_numpy().astype(float)
    weight, rate = np.zeros_like(size), np.ones_like(size)
    if size.sum():
        codes, aim = [], []
        for k in dims:
            values, code = np.unique(np.array(cells.column(k).to_pylist(), dtype=object), return_inverse=True)
            margin = np.bincount(code, weights=size)
            given = targets.get(k)
            t = (np.array([given.get(v[1:], 0.0) if v[0] == "=" else 0.0 for v in values]) * (margin > 0)
                 if given else np.where(margin > 0, (margin / margin.sum()) ** temper, 0.0))
            if not t.sum():
                raise ValueError(f"no target of {k} has tokens")
            codes.append(code)
            aim.append(t / t.sum())
        weight = rake_cells(size, codes, aim)
        rate = rates(size, weight, budget)
    return cells.drop_columns("n").append_column("weight", pa.array(weight)).append_column("probability", pa.array(rate))


def _solve_spread(cells: DataFrame, dims: list[str], targets: dict[str, dict[str, float]], temper: float,
                  budget: float) -> DataFrame:
    """``_solve`` of a written table of any size: each step is a grouped sum and a join, and is written."""
    spark = cells.sparkSession
    total = cells.agg(F.sum("n")).first()[0]
    if not total:
        return cells.drop("n").withColumns({"weight": F.lit(0.0), "probability": F.lit(1.0)})
    aims = {}
    for k in dims:
        margin = cells.groupBy(k).agg(F.sum("n").alias("n")).where("n > 0")
        if targets.get(k):
            given = spark.createDataFrame([(f"={v}", float(t)) for v, t in targets[k].items()], f"`{k}` string, t double")
            margin = margin.join(given, k)
        else:
            margin = margin.withColumn("t", F.pow(F.col("n") / float(total), F.lit(temper)))
        margin = materialize(margin.select(k, "t"), "targets")
        whole = margin.agg(F.sum("t")).first()[0]
        if not whole:
            raise ValueError(f"no target of {k} has tokens")
        aims[k] = margin.select(k, (F.col("t") / whole).alias("t"))
    w, at = materialize(cells.withColumn("weight", F.col("n") / float(total)), "cell-weights", path=True)
    for _ in range(ROUNDS):
        worst = 0.0
        for k in dims:
            margin = w.groupBy(k).agg(F.sum("weight").alias("m")).join(aims[k], k, "left")
            t = F.coalesce("t", F.lit(0.0))
            factor, margin_at = materialize(margin.select(
                k, F.when(F.col("m") > 0, t / F.col("m")).otherwise(0.0).alias("factor"), F.abs(F.col("m") - t).alias("off")),
                "factors", path=True)
            worst = max(worst, factor.agg(F.max("off")).first()[0])
            w, old = w.join(factor, k).select(*dims, "n", (F.col("weight") * F.col("factor")).alias("weight")), at
            w, at = materialize(w, "cell-weights", path=True)
            for folder in (old, margin_at):
                discard(spark, folder)
        if worst < TOLERANCE:
            break
    # the scale: cells found to be kept whole leave the budget, the others share what is left of it
    live = w.where("n > 0 and weight > 0")
    scale, whole = 0.0, -1
    while True:
        full = F.col("weight") * scale >= F.col("n")
        c, n, rest = live.agg(F.count_if(full), F.sum(F.when(full, F.col("n")).otherwise(0)),
                              F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if c == whole or not rest:
            break
        whole, scale = c, max(scale, (budget * total - n) / rest)
    chance = F.least(F.lit(1.0), F.col("weight") * scale / F.col("n"))
    return w.select(*dims, "weight", F.when((F.col("n") > 0) & (F.col("weight") > 0), chance).otherwise(1.0)
                    .alias("probability"))


def _plan(docs: DataFrame, dims: dict[str, Column], targets: dict[str, dict[str, float]], temper: float,
          budget: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, labels, n_tokens) per row, and (labels, weight, probability) of every cell."""
    d = materialize(with_tokens(docs.select(
        F.col("doc_id"), text_key(F.col("text")).alias("th"), F.col("text"),
        *[_label(c).alias(k) for k, c in dims.items()])), "token-counts")
    cells = materialize(d.groupBy(*dims).agg(F.sum("n_tokens").alias("n")), "cells")
    if cells.count() > CELLS:
        return d, _solve_spread(cells, list(dims), targets, temper, budget)
    solved = _solve(cells.toArrow(), list(dims), targets, temper, budget)
    return d, F.broadcast(docs.sparkSession.createDataFrame(solved))


def mix(docs: DataFrame, dims: dict[str, Column] | None = None, targets: dict[str, dict[str, float]] | None = None,
        temper: float = TEMPER, budget: float = BUDGET, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, its cell, tokens, calibrated ``weight``
    (share of its cell in the mixture), ``probability`` and ``kept``.

    ``targets`` gives target shares by dimension and value; a dimension
    without any gets its own shares to the power ``temper``.
    """
    dims = dims or dimensions()
    d, cells = _plan(docs, dims, targets or {}, temper, budget)
    return d.join(cells, list(dims)).withColumn(
        "kept", draw(F.col("doc_id"), F.col("th"), seed) < F.col("probability")).select(
        "doc_id", *dims, "n_tokens", "weight", "probability", "kept")


def sample(docs: DataFrame, dims: dict[str, Column] | None = None, targets: dict[str, dict[str, float]] | None = None,
           temper: float = TEMPER, budget: float = BUDGET, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that ``mix`` keeps, all columns as they are."""
    dims = dims or dimensions()
    _, cells = _plan(docs, dims, targets or {}, temper, budget)
    at = {k: f"dim{n}" for n, k in enumerate(dims)}
    side = cells.select(*[F.col(k).alias(c) for k, c in at.items()], "probability")
    marked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                         draw(F.col("doc_id"), text_key(F.col("text")), seed).alias("drawn"),
                         *[_label(c).alias(at[k]) for k, c in dims.items()])
    return (marked.join(side, list(at.values())).where(F.col("drawn") < F.col("probability"))
            .select(*[F.col("row")[c].alias(c) for c in docs.columns]))
