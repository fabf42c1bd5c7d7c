"""Chat formatting by multi-party perspective rotation (native).

Every participant of a conversation gets the whole dialogue once, rendered
with that speaker as the assistant and all others as named users, and with the
character spans that a loss may be taken on (the assistant's own words and the
end mark after them).

A dialogue is rendered whole, as one row per participant.  ``part_turns`` is an
option for dialogues that no row can hold: parts of so many turn numbers, each
with spans that are offsets into the part's text.

Defined cases: turns are ordered by turn number (null last), role and text;
repeated rows are repeated turns; a null text is an empty turn; a null role is
the speaker ``unknown``; rows with a null conversation id form one
conversation; system turns are rendered for everybody and are nobody's
perspective; a conversation without participants gives no row; control marks
inside texts or names are broken up so that they cannot pose as marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach

SYSTEM = "system"


def plain(text: Column) -> Column:
    """Text in which no control mark can be read."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", part_turns: int | None = None) -> DataFrame:
    """(conv_id, assistant, part, n_turns, rendered, mask_spans array of
    (start, end)) for every participant of every conversation."""
    name = F.coalesce(F.col(role), F.lit("unknown"))
    part = F.floor(F.col(turn) / part_turns) if part_turns else F.lit(0).cast("bigint")
    rows = turns.select(F.col(conv).alias("conv_id"), part.alias("part"),
                        F.col(turn).alias("turn"), plain(name).alias("name"), plain(F.col(text)).alias("text"))
    people = (rows.where(F.col("name") != SYSTEM).groupBy("conv_id")
              .agg(F.array_sort(F.collect_set("name")).alias("people")))
    nulls_last = F.struct(F.col("turn").isNull().alias("late"), "turn", "name", "text")
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(nulls_last)).alias("turns"))
    each = attach(parts, people, "conv_id", how="inner").select(
        "conv_id", "part", "turns", F.explode("people").alias("assistant"))
    head = lambda x: F.when(x["name"] == SYSTEM, F.lit("<|system|>\n")).when(
        x["name"] == F.col("assistant"), F.lit("<|assistant|>\n")).otherwise(
        F.concat(F.lit("<|user name="), x["name"], F.lit("|>\n")))
    body = lambda x: F.concat(x["text"], F.lit("<|end|>\n"))
    pieces = F.transform("turns", lambda x: F.struct(
        head(x).alias("head"), body(x).alias("body"),
        ((x["name"] == F.col("assistant")) & (x["name"] != SYSTEM)).alias("own")))
    each = each.select("conv_id", "assistant", "part", pieces.alias("pieces"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, x):
        begin = acc["at"] + F.char_length(x["head"])
        end = begin + F.char_length(x["body"])
        # the line feed after the end mark belongs to the format, not to the words
        span = F.struct(begin.alias("start"), (end - 1).alias("end"))
        return F.struct(end.alias("at"), F.when(x["own"], F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    return each.select(
        "conv_id", "assistant", "part", F.size("pieces").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"])), "").alias("rendered"),
        F.aggregate("pieces", start, step, lambda acc: acc["spans"]).alias("mask_spans"))
