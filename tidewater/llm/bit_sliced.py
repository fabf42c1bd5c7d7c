"""Exact top-k search on a bit-sliced index.

Vectors are quantised to integers.  The index holds, per block of rows and per
component, one bitmap for every bit of the component (a bit slice).  A query's
scores are added up as bitmaps: each set bit of a query component adds the
component's slices, shifted, and full adders reduce the bitmaps of equal
weight until one slice per bit of the score is left.  The top rows are then
picked from the most significant score slice downward; rows that tie at the
boundary are resolved exactly, to smaller ids.

Shape: index blocks are built in the scan (no shuffle) and written as a table;
queries, a stated set, become a table of chunks of at most ``CHUNK`` vectors.
Blocks and chunks meet in a grid: a block goes to the chunk groups of its row,
a chunk to the blocks of its column, and a task holds one block slot and one
chunk slot at a time.  Nothing goes through the driver; k rows per query and
cell of the grid are shuffled.

Defined cases: rows with a null id, a null vector, or a null or non-finite
component take no part; components of 2**53 and more and scores that no long
holds raise; vectors of another length than the query's are no candidates for
it; equal vectors tie and go to smaller ids; a candidate row given twice counts
twice, a query row given twice once; queries without a candidate give no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BLOCK = 4096
CHUNK = 1024
SCALE = 256.0
#: Components from here on have no exact integer below them in a double.
LARGEST = float(1 << 53)

INDEX = "dim int, n int, low bigint, bits int, ids binary, planes binary"
CHUNKS = "dim int, ids binary, marks binary, parts binary"
HITS = "mark bigint, query_id bigint, vec_id bigint, score bigint"


def usable(vec: Column) -> Column:
    return vec.isNotNull() & F.coalesce(F.forall(vec, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def quantise(rows: np.ndarray) -> np.ndarray:
    if rows.size and np.abs(rows).max() >= LARGEST:
        raise ValueError("a component of 2**53 or more")
    return np.floor(SCALE * rows.astype(np.float64)).astype(np.int64)


def slice_block(ids: np.ndarray, rows: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(smallest value, bits, planes [component, bit, word]) of rows in id order."""
    n, d = rows.shape
    low = int(rows.min()) if rows.size else 0
    bits = int(rows.max() - low).bit_length() if rows.size else 0
    u = (rows - low).astype(np.uint64)
    words = -(-n // 64)
    planes = np.zeros((d, bits, words * 8), dtype=np.uint8)
    for b in range(bits):
        planes[:, b, :-(-n // 8)] = np.packbits(((u >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T,
                                                axis=1, bitorder="little")
    return low, bits, planes.view(np.uint64)


def add_slices(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Bitmaps by weight (a stack [count, word] each) to one bitmap per weight, by full adders."""
    out: list[np.ndarray] = []
    carries: list[np.ndarray] = []
    width = columns[0].shape[1] if columns else 0
    at = 0
    while at < len(columns) or carries:
        stack = np.concatenate([*([columns[at]] if at < len(columns) else []), *carries])
        carries = []
        while len(stack) >= 3:
            m = len(stack) // 3
            a, b, c = stack[:m], stack[m:2 * m], stack[2 * m:3 * m]
            ab = a ^ b
            carries.append((a & b) | (ab & c))
            stack = np.concatenate([ab ^ c, stack[3 * m:]])
        if len(stack) == 2:
            carries.append((stack[:1] & stack[1:]))
            stack = stack[:1] ^ stack[1:]
        out.append(stack[0] if len(stack) else np.zeros(width, dtype=np.uint64))
        at += 1
    return out


def score_slices(query: np.ndarray, low: int, bits: int, both: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Score slices of a block and the number to add to each row's score.
    ``both`` has the planes and their complements, for negative components."""
    size, sign = np.abs(query), (query < 0).astype(np.int64)
    top = int(size.max()).bit_length() if size.size else 0
    by_bit = [np.flatnonzero((size >> j) & 1) for j in range(top)]
    columns = []
    for weight in range(bits + top - 1 if bits and top else 0):
        stack = [both[sign[by_bit[weight - b]], by_bit[weight - b], b]
                 for b in range(bits) if 0 <= weight - b < top and len(by_bit[weight - b])]
        columns.append(np.concatenate(stack) if stack else np.zeros((0, both.shape[3]), dtype=np.uint64))
    base = low * sum(query.tolist()) - ((1 << bits) - 1) * sum(size[query < 0].tolist())  # exact, beyond 64 bits too
    return add_slices(columns), base


def first_rows(bitmap: np.ndarray, most: int) -> np.ndarray:
    """The lowest ``most`` row numbers of a bitmap."""
    words = np.flatnonzero(bitmap)[:most]
    bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, bit = np.nonzero(bits)
    return (words[word] * 64 + bit)[:most]


def select_top(slices: list[np.ndarray], alive: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k highest scores among ``alive``, ties to lower rows."""
    sure, rest = np.zeros_like(alive), alive
    for s in reversed(slices):
        both = sure | (rest & s)
        n = int(np.bitwise_count(both).sum())
        if n > k:
            rest = rest & s
        elif n < k:
            sure, rest = both, rest & ~s
        else:
            return first_rows(both, k)
    found = first_rows(sure, k)
    return np.concatenate([found, first_rows(rest, k - len(found))]) if len(found) < k else found


def build_index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                block: int = BLOCK) -> DataFrame:
    """The index as a table: one row per block of at most ``block`` vectors of one length."""
    d = vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(dim: int, least: int) -> Iterator[pa.RecordBatch]:
            parts = held.pop(dim)
            ids = np.concatenate([p[0] for p in parts])
            rows = np.concatenate([p[1] for p in parts])
            at = 0
            while len(ids) - at >= max(least, 1):
                i, r = ids[at:at + block], rows[at:at + block]
                order = np.argsort(i, kind="stable")
                low, bits, planes = slice_block(i, q := quantise(r[order]))
                yield pa.record_batch([pa.array([x], t) for x, t in (
                    (dim, pa.int32()), (len(q), pa.int32()), (low, pa.int64()), (bits, pa.int32()),
                    (i[order].tobytes(), pa.binary()), (planes.tobytes(), pa.binary()))],
                    names=["dim", "n", "low", "bits", "ids", "planes"])
                at += len(i)
            if at < len(ids):
                held[dim] = [(ids[at:], rows[at:])]

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            lists = b.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                rows = flat[(ends[at] - dim)[:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0))
                held.setdefault(dim, []).append((ids[at], rows))
                if sum(len(x[0]) for x in held[dim]) >= block:
                    yield from flush(dim, block)
        for dim in list(held):
            yield from flush(dim, 1)

    return d.mapInArrow(run, INDEX)


def build_queries(asked: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Queries (vec_id, v, mark) as a table: one row per chunk of at most ``chunk`` vectors of one length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, marks = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            vectors = [np.asarray(v, dtype=np.float64) for v in b.column(1).to_pylist()]
            sizes = np.array([len(v) for v in vectors])
            for dim in np.unique(sizes).tolist():
                every = np.flatnonzero(sizes == dim)
                for s in range(0, len(every), chunk):
                    at = every[s:s + chunk]
                    rows = quantise(np.stack([vectors[k] for k in at.tolist()]))
                    yield pa.record_batch([pa.array([x], t) for x, t in (
                        (dim, pa.int32()), (ids[at].tobytes(), pa.binary()), (marks[at].tobytes(), pa.binary()),
                        (rows.tobytes(), pa.binary()))], names=["dim", "ids", "marks", "parts"])

    return asked.select("vec_id", "v", "mark").mapInArrow(run, CHUNKS)


def top_of_block(row: dict, queries: list[tuple[int, int, np.ndarray]], k: int) -> Iterator[tuple[int, int, int, int]]:
    """(mark, query_id, vec_id, score) of the k best rows of one block for each query."""
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    words = -(-row["n"] // 64)
    planes = np.frombuffer(row["planes"], dtype=np.uint64).reshape(row["dim"], row["bits"], words)
    both = np.stack([planes, ~planes])
    alive = np.full(words * 64, 0, dtype=np.uint8)
    alive[:row["n"]] = 1
    alive = np.packbits(alive, bitorder="little").view(np.uint64)
    for mark, own, query in queries:
        slices, base = score_slices(query, row["low"], row["bits"], both)
        left, right = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        live = alive
        if left < right:
            live = alive.copy()
            for at in range(left, right):
                live[at // 64] &= ~np.uint64(1 << (at % 64))
        for r in select_top(slices, live, k).tolist():
            score = base + sum(1 << bit for bit, s in enumerate(slices) if (int(s[r // 64]) >> (r % 64)) & 1)
            if not -(1 << 63) <= score < 1 << 63:
                raise OverflowError("a score that no long holds")
            yield mark, own, int(ids[r]), score


def search(index: DataFrame, chunks: DataFrame, k: int, blocks: int, slots: int) -> DataFrame:
    """(mark, query_id, vec_id, score): the top k of every cell of the grid of
    ``blocks`` block slots and ``slots`` chunk slots; a query's own id is no candidate."""
    place = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.withColumn("row", place("ids", blocks)).withColumn("col", each(slots))
    right = chunks.withColumn("col", place("marks", slots)).withColumn("row", each(blocks))

    def cell(block: pa.Table, chunk: pa.Table) -> pa.Table:
        queries = []
        for c in chunk.select(["dim", "ids", "marks", "parts"]).to_pylist():
            parts = np.frombuffer(c["parts"], dtype=np.int64).reshape(-1, c["dim"]) if c["dim"] else None
            ids, marks = np.frombuffer(c["ids"], dtype=np.int64), np.frombuffer(c["marks"], dtype=np.int64)
            empty = np.zeros(0, dtype=np.int64)
            queries += [(int(m), int(i), empty if parts is None else parts[n]) for n, (m, i) in enumerate(zip(marks, ids))]
        best: dict[int, list[tuple[int, int, int]]] = {}
        if queries:
            for row in block.to_pylist():
                found: dict[int, list[tuple[int, int, int]]] = {}
                for mark, own, i, score in top_of_block(row, queries, k):
                    found.setdefault(mark, []).append((-score, i, own))
                for mark, hits in found.items():
                    best[mark] = sorted(best.get(mark, []) + hits)[:k]
        out = [(mark, own, i, -s) for mark, hits in best.items() for s, i, own in hits]
        cols = list(zip(*out)) or [()] * 4
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["mark", "query_id", "vec_id", "score"])

    keys = ("dim", "row", "col")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, HITS)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every row that ``is_query`` holds for."""
    index = materialize(build_index(vectors, vec_id, vector), "bit-slices")
    asked = vectors.where(is_query & F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).distinct()
    chunks = materialize(build_queries(asked.withColumn("mark", F.xxhash64("vec_id", "v"))), "query-chunks")
    # one block and about one full chunk a cell
    total = chunks.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    found = search(index, chunks, k, max(1, index.count()), max(1, -(-total // 8 // CHUNK)))
    rank = F.row_number().over(Window.partitionBy("mark", "query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
