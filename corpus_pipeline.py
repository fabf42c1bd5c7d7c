"""The corpus pipeline: quality rules, near duplicates, repeated passages,
source mixture, packing.  Every stage reads what its predecessor kept; the
first four return the columns of ``documents``, the last the packed pieces.

Empty tables give empty results, null texts pass through (they fail the base
quality rule), further columns of the input are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import complement_packing, line_frequency, mixture, parity_join, suffix_dedup
from tidewater.llm.common import materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; kept ones lose the lines above the limits."""
    return recount(line_frequency.strip_lines(docs, line_frequency.line_frequency(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: the smallest id of each group stays, whatever ids other groups have."""
    return parity_join.keep_one(docs, parity_join.SHINGLE, parity_join.PERCENT, one_per_id=False)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a repeated 200-byte passage the first copy stays."""
    return recount(suffix_dedup.strip_repeats(docs, suffix_dedup.LENGTH, keep="first"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that source, language and topic meet their tempered shares."""
    return mixture.sample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens in their sequences."""
    return complement_packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality), ("near_duplicates", near_duplicates), ("repeated_passages", passages),
    ("source_mixture", mixing), ("packing", packing),
]

#: Tokenizing and rank-based packing cannot be said in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
