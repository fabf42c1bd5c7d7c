"""Substring dedup by line or paragraph hashing.

Texts are cut into units (paragraphs between blank lines, lines, or lines cut
again at sentence ends, which finds passages that were wrapped anew), units are
normalised and digested, digests are grouped over the whole corpus, the
earliest ranked occurrence stays and every other one is removed.  What is kept
carries its offsets in the original text.

A unit of few bytes ("yes.") recurs by chance, more often the larger the corpus,
and says nothing about copying; its digest covers the unit before it as well.
So every unit that holds a word is digested, short ones go with the passage
they are copied in, and clean texts keep theirs.

Shape: the scan makes one row per unit with a 128-bit digest and no text; the
earliest rank is a map-side combined ``min`` per digest; only digests that
occur twice or more come back to their units, in a join that can be split when
a unit stands in a third of all documents.  Texts are joined once, at the end,
with the list of their removed units.

Defined cases: units without a word are never removed, nor are those of fewer
than ``min_words`` words where that is asked for; a short unit that begins a
text is compared with such beginnings; null texts have no units; rank is (doc_id, text digest, unit), null ids first;
rows that repeat (doc_id, text) are one document given twice, both keep or
lose the same units; within a text the first of equal units stays.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, materialize, text_key

MIN_WORDS = 1
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SEPARATOR = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n(?:[\x20\x09-\x0D]*\n)+"),
             "sentence": re.compile(r"(?<=[。！？])|(?<=[.!?])[ \t]+|\n")}
#: Normalised units of fewer bytes are digested with the one before them.
SHORT = 40

SPAN = "struct<unit_no:int,start:bigint,end:bigint,first_doc:bigint,first_unit:int>"
OUT = (f"doc_id bigint, n_units bigint, removed array<{SPAN}>, "
       "kept array<struct<at:bigint,start:bigint,end:bigint>>, kept_text string")


def cut(text: str, unit: str) -> list[tuple[int, int, int]]:
    """(start, end, end with separator) of every unit, in code points."""
    out, at = [], 0
    for m in SEPARATOR[unit].finditer(text):
        out.append((at, m.start(), m.end()))
        at = m.end()
    return [*out, (at, len(text), len(text))]


def normal(unit: str, min_words: int = MIN_WORDS) -> str:
    """Lower case, words joined by one space; empty for units that are never removed."""
    found = WORDS.findall(unit.lower())
    return " ".join(found) if len(found) >= max(min_words, 1) else ""


def digest(key: str) -> tuple[int, int]:
    """128 bits."""
    d = hashlib.blake2b(key.encode(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def keys(text: str, unit: str, min_words: int = MIN_WORDS, short: int = SHORT) -> Iterator[tuple[int, str]]:
    """(unit number, what is digested) of the units of a text."""
    before = ""
    for no, (s, e, _) in enumerate(cut(text, unit)):
        if key := normal(text[s:e], min_words):
            yield no, key if len(key.encode()) >= short else f"{before}\n{key}"
            before = key


def units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, short: int = SHORT) -> DataFrame:
    """(doc_id, th, unit_no, h1, h2) of every unit with a word."""
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("unit_no", pa.int32()),
                        ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for i, th, text in zip(*(c.to_pylist() for c in b.columns)):
                rows += [(i, th, no, *digest(key)) for no, key in keys(text, unit, min_words, short)]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return (docs.where(F.col("text").isNotNull()).select("doc_id", text_key(F.col("text")).alias("th"), "text")
            .mapInArrow(run, "doc_id bigint, th bigint, unit_no int, h1 bigint, h2 bigint"))


def later_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, short: int = SHORT) -> DataFrame:
    """(doc_id, th, unit_no, first_doc, first_unit): every unit that an equal
    unit of an earlier rank makes redundant."""
    u = materialize(units(docs, unit, min_words, short), "units")
    rank = F.struct("doc_id", "th", "unit_no")
    # written first: a join of two stored tables can be split where a unit is hot
    first = materialize(u.groupBy("h1", "h2").agg(F.min(rank).alias("a"), F.max(rank).alias("z"))
                        .where("a != z").select("h1", "h2", "a"), "first-units")
    return (u.join(first, ["h1", "h2"]).where(~rank.eqNullSafe(F.col("a")))
            .select("doc_id", "th", "unit_no", F.col("a.doc_id").alias("first_doc"),
                    F.col("a.unit_no").alias("first_unit")))


def drop_repeated_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, short: int = SHORT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_units, ``removed`` (unit_no, start, end,
    first_doc, first_unit), ``kept`` (place in the kept text, original start
    and end) and ``kept_text``."""
    gone = (later_units(docs, unit, min_words, short).groupBy("doc_id", "th")
            .agg(F.collect_set(F.struct("unit_no", "first_doc", "first_unit")).alias("gone")))
    d = docs.select("doc_id", "text", text_key(F.col("text")).alias("th"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {"doc_id": [], "n_units": [], "removed": [], "kept": [], "kept_text": []}
            for i, text, gone in zip(*(c.to_pylist() for c in b.columns)):
                at = {g["unit_no"]: g for g in gone or ()}
                spans = [] if text is None else cut(text, unit)
                kept, parts, n = [], [], 0
                for no, (s, e, z) in enumerate(spans):
                    if no not in at:
                        kept.append({"at": n, "start": s, "end": z})
                        parts.append(text[s:z])
                        n += z - s
                out["doc_id"].append(i)
                out["n_units"].append(len(spans))
                out["removed"].append([{"unit_no": no, "start": spans[no][0], "end": spans[no][1],
                                        "first_doc": at[no]["first_doc"], "first_unit": at[no]["first_unit"]}
                                       for no in sorted(at)])
                out["kept"].append(kept)
                out["kept_text"].append(None if text is None else "".join(parts))
            yield pa.RecordBatch.from_pydict(out, schema=ARROW)

    return attach(d, gone, "doc_id", "th").select("doc_id", "text", "gone").mapInArrow(run, OUT)


ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_units", pa.int64()),
    ("removed", pa.list_(pa.struct([("unit_no", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                                    ("first_doc", pa.int64()), ("first_unit", pa.int32())]))),
    ("kept", pa.list_(pa.struct([("at", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))),
    ("kept_text", pa.string()),
])
