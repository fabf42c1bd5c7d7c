"""Suffix-array dedup: longest previous (and next) factors of a whole corpus.

Removed is every byte that a string of ``length`` bytes covers which also
starts elsewhere: ``keep="first"`` asks for an earlier start (the longest
previous factor is long enough), so the first copy stays; ``keep="none"`` asks
for an earlier or a later one, so every copy goes.

For this threshold only suffixes that share a gram at the same place can
match, so the suffix array is built gram by gram: suffixes in the order of their
first ``length`` bytes, ties by position, with the common prefix of neighbours.
The longest previous factor of a suffix is what it shares with the previous or
the next smaller position in that order; the longest factor anywhere is what it
shares with a neighbour.

Sorting every suffix of a corpus would move each byte ``length`` times, so the
classes are found from anchors.  Each ``length``-byte window owns the anchor at
its smallest ``GRAM``-byte hash (leftmost on ties): equal windows own equal
anchors at equal places.  One row per anchor is about one per 70 bytes.

1. Anchors whose gram occurs once cannot lie in a repeat and go (count, then
   semi join).
2. Anchors that agree in their whole context, that is in all windows they own,
   are settled together; one of them stands for all in the next step.
3. Where a gram has several contexts, the representatives' suffixes are sorted
   by their bytes and factor lengths decide each window.  Grams with very many
   contexts are spread by window instead: of equal windows, that of min position
   has no earlier match and all others have one.

Contexts, and windows that are spread, are told apart by 128 bits of hash.  Texts
are shuffled twice, for the contexts of representatives and for the result.

Defined cases: null texts are empty, texts shorter than ``length`` keep
everything; matches never cross documents; positions are ordered by (doc_id,
text digest, offset), null ids last; rows that repeat (doc_id, text) are one
document given twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, discard, materialize, text_key
from .rolling import M1, M2, M3, U, grams8, mix, prefix, text_buffer

LENGTH = 200
GRAM = 64
SEGMENT = 1 << 18
#: Contexts of one gram that one task may sort (3 MB of text); grams with more are spread by window.
MANY = 8192

ANCHORS = "hk bigint, hf bigint, doc_id bigint, th bigint, a int, back int, n int, again boolean"
CONTEXT = "hk bigint, doc_id bigint, th bigint, a int, back int, n int, settled boolean, many boolean, context binary"
SPANS = "doc_id bigint, th bigint, start int, end int"


def range_hash(p: np.ndarray, down: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Hash of the bytes from i to j (8 at least), from the prefix sums of their grams8."""
    return mix((p[j - 7] - p[i]) * down[i] + (j - i).astype(U) * M2)


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> list[np.ndarray]:
    """(gram hash, context hash, row, place, first window, windows) of every
    anchor; windows are the starts that own it, inside one row of ``bounds``."""
    parts: list[list[np.ndarray]] = []
    ends, span = bounds[1:], length - gram + 1
    for s in range(0, max(len(data) - length + 1, 0), SEGMENT):
        seg = data[s:s + SEGMENT + length - 1]
        p, down = prefix(grams8(seg))
        at = np.arange(len(seg) - gram + 1)
        hk = range_hash(p, down, at, at + gram)
        low = U((1 << 20) - 1)
        least, step = (hk & ~low) | at.astype(U), 1
        while step * 2 <= span:
            least, step = np.minimum(least[:-step], least[step:]), step * 2
        if step < span:
            least = np.minimum(least[:len(least) - (span - step)], least[span - step:])
        owner = (least & low).astype(np.int64)
        row = np.searchsorted(ends, np.arange(s, s + len(owner)), side="right")
        owner[np.arange(s, s + len(owner)) + length > ends[row]] = -1
        # rows that end inside a run of one anchor cut it
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])]))
        last = np.concatenate([first[1:], [len(owner)]])
        there = owner[first] >= 0
        first, last = first[there], last[there]
        a = owner[first]
        whole = range_hash(p, down, first, last - 1 + length)
        hf = mix(whole + (a - first).astype(U) * M3 + (last - first).astype(U) * M1)
        parts.append([hk[a], hf, row[first], s + a, s + first, last - first])
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, dtype=np.int64)] * 6


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """ANCHORS; ``again``: the same text has the same context earlier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds = text_buffer(b.column(2))
            hk, hf, row, a, w, n = anchors(data, bounds, length, gram)
            again = np.zeros(len(hk), dtype=bool)
            order = np.lexsort((a, hf, hk, row))
            same = [x[order][1:] == x[order][:-1] for x in (hk, hf, row)]
            again[order[1:]] = same[0] & same[1] & same[2]
            pick = pa.array(row)
            yield pa.record_batch([
                pa.array(hk.astype(U).view(np.int64)), pa.array(hf.astype(U).view(np.int64)),
                b.column(0).take(pick), b.column(1).take(pick), pa.array((a - bounds[row]).astype(np.int32)),
                pa.array((a - w).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(again)],
                names=["hk", "hf", "doc_id", "th", "a", "back", "n", "again"])

    return docs.select("doc_id", "th", "text").mapInArrow(run, ANCHORS)


def contexts(docs: DataFrame, reps: DataFrame, length: int) -> DataFrame:
    """CONTEXT: the bytes of all windows of each representative anchor."""
    per_doc = reps.groupBy("doc_id", "th").agg(F.collect_list(
        F.struct("hk", "a", "back", "n", "settled", "many")).alias("anchors"))
    d = attach(docs.select("doc_id", "th", "text"), per_doc, "doc_id", "th", how="inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b.column("anchors")
            sizes = np.diff(found.offsets.to_numpy())
            row = np.repeat(np.arange(b.num_rows), sizes)
            flat = found.flatten()
            a, back, n = (flat.field(x).to_numpy(zero_copy_only=False) for x in ("a", "back", "n"))
            texts = b.column("text").cast(pa.large_binary())
            body, held = [], (-1, b"")
            for r, x, y, z in zip(row.tolist(), a.tolist(), back.tolist(), n.tolist()):
                if held[0] != r:
                    held = (r, texts[r].as_py())
                body.append(held[1][x - y:x - y + z + length - 1])
            pick = pa.array(row)
            yield pa.record_batch([flat.field("hk"), b.column("doc_id").take(pick), b.column("th").take(pick),
                                   flat.field("a"), flat.field("back"), flat.field("n"), flat.field("settled"),
                                   flat.field("many"), pa.array(body, pa.binary())],
                                  names=["hk", "doc_id", "th", "a", "back", "n", "settled", "many", "context"])

    return d.select("doc_id", "th", "text", "anchors").mapInArrow(run, CONTEXT)


def places(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """The bytes of the contexts in a batch and, of every window: row, place in these bytes, start in the text."""
    data, bounds = text_buffer(b.column("context"))
    n = b.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
    first = (b.column("a").to_numpy() - b.column("back").to_numpy()).astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return data, row, bounds[row] + k, first[row] + k


def windows(b: pa.RecordBatch, length: int) -> tuple[np.ndarray, ...]:
    """(row, name, start in the text) of every window of the contexts in a
    batch; equal names: equal windows."""
    data, row, at, start = places(b)
    p, down = prefix(grams8(data))
    return row, range_hash(p, down, at, at + length), start


def suffix_order(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``at`` by group and first ``length`` bytes, ties in the
    order given, and the common prefix of each with the one before it (at most
    ``length``, 0 at the head of a group).  Eight bytes a round, ties only."""
    word = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(U)
    for step in (1, 2, 4):
        word = (word[:-step] << U(8 * step)) | word[step:]
    order = np.argsort(group, kind="stable")
    head = np.ones(len(order), dtype=bool)
    head[1:] = group[order][1:] != group[order][:-1]
    common = np.where(head, 0, length)
    for k in range(0, length, 8):
        tied = ~head
        tied[:-1] |= ~head[1:]
        slot = np.flatnonzero(tied)
        if not len(slot):
            break
        take = min(8, length - k)
        key = word[at[order[slot]] + k] >> U(8 * (8 - take))
        run = np.cumsum(head[slot])
        by = np.lexsort((key, run))
        order[slot], key = order[slot][by], key[by]
        differ = np.flatnonzero((key[1:] != key[:-1]) & (run[1:] == run[:-1]))
        odd, to = key[differ + 1] ^ key[differ], slot[differ + 1]
        common[to] = k + take - sum((odd >> U(8 * j) > 0).astype(np.int64) for j in range(take))
        head[to] = True
    return order, common


def previous_factors(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest previous factor of each suffix, in suffix order: the larger of
    its common prefixes with the previous and the next smaller position."""
    out = np.zeros(len(position), dtype=np.int64)
    open_at: list[tuple[int, int, int]] = []  # (place, position, shared with the previous smaller position)
    for i, (p, shared) in enumerate(zip([*position.tolist(), -1], [*common.tolist(), 0])):
        while open_at and open_at[-1][1] > p:
            k, _, before = open_at.pop()
            out[k] = max(before, shared)
            shared = min(before, shared)
        open_at.append((i, p, shared))
    return out


def neighbours(b: pa.RecordBatch, length: int, first: bool) -> Iterator[tuple]:
    """(row, start, end) of the windows of unsettled anchors whose longest
    previous factor (``first``), or longest factor anywhere, has ``length``
    bytes.  ``b`` has whole grams."""
    data, row, at, start = places(b)
    ids = b.column("doc_id")
    null = ids.is_null().to_numpy(zero_copy_only=False)
    doc = ids.fill_null(0).to_numpy()
    hk, th = b.column("hk").to_numpy(), b.column("th").to_numpy()
    # from here on the place in these arrays is the order of positions; repeated rows give a position twice
    by = np.lexsort((start, th[row], doc[row], null[row]))
    row, at, start = row[by], at[by], start[by]
    same = [x[row][1:] == x[row][:-1] for x in (th, doc, null)]
    fresh = np.concatenate([[True], ~(same[0] & same[1] & same[2] & (start[1:] == start[:-1]))])
    row, at, start = row[fresh], at[fresh], start[fresh]
    order, common = suffix_order(data, at, hk[row], length)
    factor = previous_factors(order, common) if first else np.maximum(common, np.append(common[1:], 0))
    hit = (factor >= length) & ~b.column("settled").to_numpy(zero_copy_only=False)[row[order]]
    r, s = row[order][hit], start[order][hit]
    order = np.lexsort((s, r))
    r, s = r[order], s[order]
    cut = np.concatenate([[True], (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1)]) if len(r) else np.zeros(0, dtype=bool)
    head = np.flatnonzero(cut)
    tail = np.concatenate([head[1:], [len(r)]]) - 1 if len(r) else head
    yield r[head], s[head], s[tail] + length


def spans_batch(b: pa.RecordBatch, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    pick = pa.array(row)
    return pa.record_batch([b.column("doc_id").take(pick), b.column("th").take(pick),
                            pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
                           names=["doc_id", "th", "start", "end"])


def sorted_windows(rows: DataFrame, length: int, first: bool) -> DataFrame:
    """SPANS decided in suffix order, gram by gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(t: pa.Table) -> Iterator[pa.RecordBatch]:
            b = t.combine_chunks().to_batches()[0]
            for found in neighbours(b, length, first):
                yield spans_batch(b, *found)

        held: pa.Table | None = None
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                t = pa.Table.from_batches([b.slice(at, 2048)])
                held = t if held is None else pa.concat_tables([held, t])
                hk = held.column("hk").to_numpy()
                cut = int(np.searchsorted(hk, hk[-1]))  # the last gram may go on
                if cut:
                    yield from settle(held.slice(0, cut))
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from settle(held)

    return rows.repartition("hk").sortWithinPartitions("hk").mapInArrow(run, SPANS)


def spread_windows(rows: DataFrame, length: int, first: bool) -> DataFrame:
    """SPANS of grams with many contexts: min and max position per window class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                row, name, start = windows(b, length)
                pick = pa.array(row)
                yield pa.record_batch([b.column("hk").take(pick), pa.array(name.view(np.int64)),
                                       b.column("doc_id").take(pick), b.column("th").take(pick),
                                       pa.array(start.astype(np.int32)), b.column("settled").take(pick)],
                                      names=["hk", "name", "doc_id", "th", "start", "settled"])

    each = materialize(rows.mapInArrow(
        run, "hk bigint, name bigint, doc_id bigint, th bigint, start int, settled boolean"), "windows")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "th", "start")
    cls = materialize(each.groupBy("hk", "name").agg(F.min(place).alias("low"), F.max(place).alias("high"))
                      .where("low != high").select("hk", "name", "low"), "window-classes")
    hit = each.where(~F.col("settled")).join(cls, ["hk", "name"])
    if first:
        hit = hit.where(~place.eqNullSafe(F.col("low")))
    return hit.select("doc_id", "th", "start", (F.col("start") + length).cast("int").alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep: str = "none", gram: int = GRAM) -> DataFrame:
    """SPANS (overlapping) that ``keep`` removes, from (doc_id, th, text)."""
    first = keep == "first"
    found = anchor_rows(docs.where(F.octet_length("text") >= length), length, gram)
    ids = docs.groupBy("doc_id", "th").agg(F.count("*").alias("c")).groupBy("doc_id").agg(
        F.max("c").alias("twins"), F.count("*").alias("texts"))
    ids = ids.agg(F.max("twins").alias("twins"), F.max("texts").alias("texts"),
                  F.max(F.col("doc_id").isNull()).alias("null")).collect()[0]
    twins, plain = (ids["twins"] or 0) > 1, (ids["texts"] or 0) <= 1 and not ids["null"]
    every, anchors_at = materialize(found.distinct() if twins else found, "anchors", path=True)
    # small sides are written first: a join of two stored tables can be split where a gram is hot
    often = materialize(every.groupBy("hk").agg(F.count("*").alias("c")).where("c > 1").select("hk"), "often")
    multi, multi_at = materialize(every.join(often, "hk", "left_semi"), "repeated-anchors", path=True)
    discard(docs.sparkSession, anchors_at)
    # the id alone orders texts where it names one text each (a cheaper aggregate)
    place = F.col("doc_id") if plain else F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "th")
    classes = materialize(multi.groupBy("hk", "hf").agg(
        F.count("*").alias("copies"), F.min(place).alias("first_doc")), "context-classes")
    grams = materialize(classes.groupBy("hk").agg(F.count("*").alias("contexts")), "gram-sizes")
    each = multi.join(materialize(classes.join(grams, "hk"), "classes"), ["hk", "hf"])
    is_first = place.eqNullSafe(F.col("first_doc")) & ~F.col("again")
    each = materialize(each.select(
        "hk", "doc_id", "th", "a", "back", "n", is_first.alias("rep"),
        (~is_first if first else F.col("copies") > 1).alias("settled"), "contexts"), "settled-anchors")
    discard(docs.sparkSession, multi_at)
    begin = F.col("a") - F.col("back")
    done = each.where("settled").select(
        "doc_id", "th", begin.cast("int").alias("start"), (begin + F.col("n") + length - 1).cast("int").alias("end"))
    reps = each.where("rep and contexts > 1").withColumn("many", F.col("contexts") > MANY)
    rows = materialize(contexts(docs, reps, length), "contexts")
    return done.unionAll(sorted_windows(rows.where("not many"), length, first)).unionAll(
        spread_windows(rows.where("many"), length, first))


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("th"),
                       F.coalesce("text", F.lit("")).alias("text"))


def _span_lists(docs: DataFrame, length: int, keep: str, gram: int) -> DataFrame:
    """(doc_id, th, spans): the removed spans of every text that has some."""
    return (repeated_spans(_named(docs), length, keep, gram).groupBy("doc_id", "th")
            .agg(F.collect_list(F.struct("start", "end")).alias("spans")))


def _merged(spans: pa.Scalar) -> list[tuple[int, int]]:
    """Maximal runs of a list of overlapping spans."""
    if not spans.is_valid:
        return []
    start, end = (spans.values.field(x).to_numpy() for x in ("start", "end"))
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    head = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return list(zip(start[head].tolist(), end[np.concatenate([head[1:], [len(start)]]) - 1].tolist()))


def _without(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    bounds = [0, *(x for span in spans for x in span), len(body)]
    return b"".join(body[s:e] for s, e in zip(bounds[::2], bounds[1::2]))


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none", gram: int = GRAM) -> DataFrame:
    """Per row of ``docs``: doc_id, th, n_bytes, ``spans`` (maximal removed
    runs, start and end in bytes) and ``kept`` (the other bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, merged, kept = [], [], []
            for text, found in zip(b.column("text").cast(pa.large_binary()), b.column("spans")):
                body, spans = text.as_py(), _merged(found)
                sizes.append(len(body))
                merged.append([{"start": s, "end": e} for s, e in spans])
                kept.append(_without(body, spans))
            yield pa.record_batch([b.column("doc_id"), b.column("th"), pa.array(sizes, pa.int64()),
                                   pa.array(merged, SPAN_LIST), pa.array(kept, pa.binary())],
                                  names=["doc_id", "th", "n_bytes", "spans", "kept"])

    return attach(_named(docs), _span_lists(docs, length, keep, gram), "doc_id", "th").mapInArrow(
        run, "doc_id bigint, th bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")


def strip_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first", gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeats cut from ``text``, all other columns as they
    are; a character that a cut splits goes, a null text stays null."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("doc_id"),
                       text_key(docs["text"]).alias("th"))
    d = attach(rows, _span_lists(docs, length, keep, gram), "doc_id", "th").select("row", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = b.column("row")
            names = [f.name for f in row.type]
            at = names.index("text")
            columns = row.flatten()
            texts = [text.as_py() if not found.is_valid else
                     _without(text.as_py().encode(), _merged(found)).decode("utf-8", "ignore")
                     for text, found in zip(columns[at], b.column("spans"))]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return d.mapInArrow(run, docs.schema)


SPAN_LIST = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
