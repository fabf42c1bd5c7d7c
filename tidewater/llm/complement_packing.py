"""Best-fit packing by exact-complement hashing.

Documents are tokenized and, where longer than a sequence, cut.  The plan is
made on the histogram of piece lengths: for a length, its gap to the sequence
is looked up among single lengths, sums of two and sums of three; a
combination that fills the gap exactly is consumed as often as the counts of
its lengths allow; what is left is packed best-fit, always the longest piece
that still fits.  Pieces then find their places by rank within their length.

Shape: only the histogram, at most ``capacity`` numbers, reaches the driver;
the plan, whose steps each use up a length, goes back as a small table.  Ranks
are counted within (length, bucket), buckets hold some hundred pieces (a
length has at most ``MAX_BUCKETS``), and the offsets of buckets are a running
sum over their counts, so a length that a third of all pieces share is never
in one task.  Token ids leave the tasks as checksums; texts are not shuffled.

Defined cases: a null or empty text is the end token alone; a longer document
is cut so that only its first piece may be short; repeated rows are packed as
often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

CAPACITY = 1024
END = 2
BUCKET, MAX_BUCKETS = 256, 1 << 16
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def vocabulary() -> str:
    """Path of the byte-level BPE ranks, which give the ids of byte_bpe_50k.json."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=1)
def encoder(path: str):
    """The ids of the vocabulary's ``tokenizers`` file, from the same ranks
    several times faster; the one special token is recognised in texts, as there."""
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                            special_tokens={"<|endoftext|>": len(ranks)})
    return lambda text: enc.encode(text, allowed_special="all")


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    at, first = 0, n % capacity or min(n, capacity)
    while at < n:
        size = first if at == 0 else capacity
        yield at, size
        at += size


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end], dtype="<u4")
                rows += [(i, k, s, n, zlib.crc32(ids[s:s + n].tobytes()))
                         for k, (s, n) in enumerate(cut(len(ids), capacity))]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def complement(have: np.ndarray, gap: int, used: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that sum to ``gap``, the longest
    first, while ``used`` takes one of its own length."""
    left = have.copy()
    left[used] -= 1
    if gap < 1:
        return ()
    if left[gap] > 0:
        return (gap,)

    def pair(total: int) -> tuple[int, int] | None:
        a = np.arange(total - 1, (total - 1) // 2, -1)
        ok = np.flatnonzero((left[a] > 0) & (left[total - a] > 0) & ((a * 2 != total) | (left[a] > 1)))
        return (int(a[ok[0]]), int(total - a[ok[0]])) if len(ok) else None

    if found := pair(gap):
        return found
    for a in np.flatnonzero(left[:gap - 1] > 0)[::-1]:
        left[a] -= 1
        found = pair(gap - int(a))
        left[a] += 1
        if found:
            return (int(a), *found)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that use up all counts."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for n, c in counts.items():
        have[n] = c
    steps: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...]) -> None:
        need = Counter(lengths)
        times = int(min(have[n] // k for n, k in need.items()))
        for n, k in need.items():
            have[n] -= k * times
        steps.append((lengths, times))

    for n in range(capacity, 0, -1):
        while have[n] > 0 and (found := complement(have, capacity - n, n)) is not None:
            take((n, *found))
    for n in range(capacity, 0, -1):
        while have[n] > 0:
            have[n] -= 1
            lengths, gap = [n], capacity - n
            while gap > 0 and len(fits := np.flatnonzero(have[:gap + 1] > 0)):
                # as many of the longest that fits as the gap and the counts allow
                m = int(fits[-1])
                times = min(gap // m, int(have[m]))
                have[m] -= times
                lengths += [m] * times
                gap -= m * times
            for m in lengths:
                have[m] += 1
            take(tuple(lengths))
    return steps


def places(steps: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, rank from, rank to, sequence of the first, its slots a sequence,
    offset): ranks ``from + j * slots + s`` of a length stand in sequence ``first + j``
    at ``offset + s * length``."""
    rank: Counter[int] = Counter()
    out, sequence = [], 0
    for lengths, times in steps:
        offset = 0
        for n, k in Counter(lengths).items():
            out.append((n, rank[n], rank[n] + k * times, sequence, k, offset))
            rank[n] += k * times
            offset += n * k
        sequence += times
    return out


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """PIECES plus sequence_id and offset: every piece of every document in its place."""
    spark = docs.sparkSession
    p = materialize(pieces(docs, path or vocabulary(), capacity, end), "pieces")
    counts = {r["length"]: r["count"] for r in p.groupBy("length").count().collect()}
    table = spark.createDataFrame(places(plan(counts, capacity)), "length bigint, low bigint, high bigint, "
                                  "first bigint, slots bigint, place bigint")
    sizes = spark.createDataFrame([(n, min(MAX_BUCKETS, -(-c // BUCKET))) for n, c in counts.items()],
                                  "length bigint, buckets bigint")
    p = p.join(F.broadcast(sizes), "length").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "buckets")).drop("buckets")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = (p.groupBy("length", "bucket").agg(F.count("*").alias("n"))
              .withColumn("before", before).drop("n"))
    nth = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = p.withColumn("nth", nth).join(starts, ["length", "bucket"]).withColumn(
        "rank", F.col("before") + F.col("nth") - 1)
    placed = ranked.join(F.broadcast(table), "length").where(
        (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    k = F.col("rank") - F.col("low")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(k / F.col("slots"))).cast("bigint").alias("sequence_id"),
        (F.col("place") + F.pmod(k, "slots") * F.col("length")).cast("bigint").alias("offset"))
