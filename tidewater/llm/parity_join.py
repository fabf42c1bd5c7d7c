"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles.  Two documents link when
``100 * |A & B| >= percent * |A | B|``, which is the same as a symmetric
difference of at most ``(100 - percent) (|A| + |B|) / (100 + percent)``.

Sketches.  Tokens are dealt to the parts of a sketch and each toggles bits
there (XOR), so tokens that two sets share cancel out: parts that differ, and
bits that differ, number at most the symmetric difference.  Sizes form bands;
a band that allows ``d`` differences has ``d + 1 + spare`` parts, so linked
sets agree in ``spare + 1`` parts.  Parts are joined on the XOR of their token
hashes (pigeonhole); empty parts, which agree without saying anything, are
joined on only by sets with more than ``spare`` of them.  A set joins in its
own band and, if a linked set can be smaller by a band, in the one below.

Links.  Equal sets are one node (the set's digest), so copies never multiply.
Each node is first checked against the pivot it shares most parts with, where
their sketches allow a link;
components of these links settle dense groups without pairs.  Every pair of
nodes that share a part and are still in different components is then tried:
parity sketches (Hamming distance at most the allowed difference) drop most,
exact sets decide the rest.  Parts that very many nodes share are
compared in blocks, so no task holds more than two blocks.  No link is lost;
none is taken on hashes of sets alone.

Number of links.  All links of a node lie in its component, so they are counted
there: nodes of linkable sizes meet in blocks, each task multiplies the
incidence matrices of two blocks (node by shingle) and adds up, per node, the
documents of the nodes it links with.  Counts leave a task, never pairs.

Defined cases: null and empty texts have the empty set, which links with
nothing; fewer words than a shingle are one shingle; ids may be null or
repeat: rows that repeat (doc_id, text) get equal rows; a component's id is
the smallest non-null doc_id in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, discard, materialize, text_key
from .components import components
from .rolling import M1, M2, M3, U, mix, shingles, text_buffer, word_hashes

SHINGLE, PERCENT = 5, 80
#: Fewest bits of a parity sketch, and its bits per allowed difference.
SKETCH, ROOM = 1024, 3
#: Nodes of one part that are compared as one block.
BLOCK = 1024
#: Nodes, and tokens of their sets, of one block in which links are counted, and shingles multiplied at once.
LINK_BLOCK, LINK_TOKENS, COLUMNS = 2048, 1 << 20, 2048
#: A part value is spread at once if 1 in SAMPLE nodes brings it this often.
SAMPLE, HOT = 1024, 64


@lru_cache(maxsize=8)
def bands(percent: int, largest: int = 1 << 40) -> list[tuple[int, int, int]]:
    """(smallest size, parts, spare) of the bands; parts 0: only equal sets can link."""
    out, low = [], 1
    while low < largest:
        high = max(low, ceil(low * 1.5) - 1)
        differ = (100 - percent) * (high + high * 100 // percent) // (100 + percent)
        spare = 1 + ceil(2 * (differ + 1) * exp(-low / (differ + 1)))
        out.append((low, differ + 1 + spare if differ else 0, spare))
        low = high + 1
    return out


def allowed(a, b, percent: int):
    """Largest symmetric difference of linked sets of these sizes."""
    return (100 - percent) * (a + b) // (100 + percent)


def part_values(tokens: np.ndarray, band: int, parts: int, spare: int) -> np.ndarray:
    """The join values of a set in a band: one per part, without empty parts unless they are many."""
    part = (((tokens >> U(32)) * U(parts)) >> U(32)).astype(np.int64)
    value = np.zeros(parts, dtype=U)
    # sets are sorted, so tokens of a part are neighbours
    head = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    value[part[head]] = np.bitwise_xor.reduceat(mix(tokens * M1 + M2), head)
    at = part[head] if parts - len(head) <= spare else np.arange(parts)
    return mix(value[at] + at.astype(U) * M3 + np.full(1, band + 1, dtype=U) * M2)


def parity(tokens: np.ndarray, percent: int) -> bytes:
    """One bit toggled by every token, in as many bits as tell apart sets of this size."""
    bits = max(SKETCH, 1 << (ROOM * allowed(len(tokens), len(tokens), percent)).bit_length())
    odd = np.bincount((tokens & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches of different widths, XOR-folded to the narrowest: [set, word]."""
    least = min(map(len, sketches))
    out = np.empty((len(sketches), least // 8), dtype=U)
    for width in {len(s) for s in sketches}:
        at = [k for k, s in enumerate(sketches) if len(s) == width]
        wide = np.frombuffer(b"".join(sketches[k] for k in at), dtype=U).reshape(len(at), width // least, -1)
        out[at] = np.bitwise_xor.reduce(wide, axis=1)
    return out


def join_values(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Part values of the set's own band and of the band below where needed."""
    table, n = bands(percent), len(tokens)
    own = next(k for k in range(len(table) - 1) if table[k + 1][0] > n)
    found = [part_values(tokens, own, *table[own][1:])] if table[own][1] else []
    if own and 100 * (table[own][0] - 1) >= percent * n and table[own - 1][1]:
        found.append(part_values(tokens, own - 1, *table[own - 1][1:]))
    return np.concatenate(found) if found else tokens[:0]


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that the sets of few texts are held at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    data, bounds = text_buffer(column)
    return shingles(*word_hashes(data, bounds), n)


def digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    if not len(tokens):
        return 0, 0
    both = np.array([mix(tokens * M3).sum(dtype=U), np.bitwise_xor.reduce(mix(tokens + M1))], dtype=U)
    a, b = mix(both + U(len(tokens))).view(np.int64).tolist()
    return a, b


#: Most 64-bit digests that may belong to several sets: N sets have about N * N / 2**65 such digests.
CLASHES = 1 << 16
START_CLASHES: frozenset[int] = frozenset()


def node_of(both: tuple[int, int], clashes: frozenset[int]) -> int:
    """The node of a set: 64 bits of its digest, where these tell sets apart, else both halves mixed."""
    a, b = both
    if a not in clashes:
        return a
    return int(mix(np.array([a ^ 0x5BF03635, b], dtype=np.int64).view(U) * M1).sum(dtype=U).view(np.int64))


def profiles(docs: DataFrame, n: int, percent: int, clashes: frozenset[int] = frozenset()) -> DataFrame:
    """(doc_id, th, size, node, check, sketch) per row; ``node`` and ``check`` tell the 128-bit digest of its set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            sizes, ids, sketches = [], [], []
            for s in _sets(b.column(2), n):
                sizes.append(len(s))
                ids.append((node_of(d := digest(s), clashes), d[1]))
                sketches.append(parity(s, percent))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(sizes, pa.int64()),
                                   pa.array([i for i, _ in ids], pa.int64()), pa.array([c for _, c in ids], pa.int64()),
                                   pa.array(sketches, pa.binary())],
                                  names=["doc_id", "th", "size", "node", "check", "sketch"])

    return docs.mapInArrow(run, "doc_id bigint, th bigint, size bigint, node bigint, check bigint, sketch binary")


def values(docs: DataFrame, n: int, percent: int, clashes: frozenset[int] = frozenset()) -> DataFrame:
    """(value, node): the join values of every set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            found, nodes, counts = [], [], []
            for s in _sets(b.column(2), n):
                v = join_values(s, percent) if len(s) else s
                found.append(v)
                counts.append(len(v))
                nodes.append(node_of(digest(s), clashes))
            k = np.repeat(np.arange(len(nodes)), counts)
            pick = pa.array(k)
            yield pa.record_batch([pa.array(np.concatenate([*found, np.zeros(0, dtype=U)]).view(np.int64)),
                                   pa.array(nodes, pa.int64()).take(pick)], names=["value", "node"])

    return docs.mapInArrow(run, "value bigint, node bigint")


def shared_values(docs: DataFrame, n: int, percent: int, clashes: frozenset[int] = frozenset()) -> DataFrame:
    """(value, node) of the values that several nodes share.  One
    shuffle by value; runs are read in order and single ones dropped.  Values
    that a sample shows to be very frequent skip that task and stay spread."""
    few = values(docs.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SAMPLE)) == 0), n, percent, clashes)
    # at most (rows of the sample) / HOT values
    hot = materialize(few.groupBy("value").agg(F.count("*").alias("c")).where(F.col("c") >= HOT).select("value"), "hot")
    every = values(docs, n, percent, clashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None  # the row before this batch
        sent = False                        # and whether it has gone out already
        for b in batches:
            if not b.num_rows:
                continue
            t = b if last is None else pa.concat_batches([last, b])
            v, node = t.column(0).to_numpy(), t.column(1).to_numpy()
            starts = np.concatenate([[True], v[1:] != v[:-1]])
            fresh = starts | np.concatenate([[True], node[1:] != node[:-1]])  # the first row of a node in a run
            run_of = np.cumsum(starts) - 1
            shared = (np.bincount(run_of, weights=fresh) > 1)[run_of]
            send = shared & fresh
            send[0] &= not sent
            # a run of one node so far stays open: its row goes out once another node joins it
            last, sent = t.slice(t.num_rows - 1), bool(shared[-1] or (sent and run_of[-1] == 0))
            yield t.filter(pa.array(send))

    runs = every
    if hot.limit(1).count():
        runs = every.join(hot, "value", "left_anti")
    found = (runs.repartition("value").sortWithinPartitions("value", "node")
             .mapInArrow(run, "value bigint, node bigint"))
    if runs is not every:
        found = found.unionAll(every.join(hot, "value", "left_semi").distinct())
    return found


def token_sets(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, tokens) of the nodes, each from one of its texts, given as (node, doc_id, th)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            yield pa.record_batch([b.column(0), pa.array([s.view(np.int64) for s in _sets(b.column(1), n)],
                                                         pa.list_(pa.int64()))], names=["node", "tokens"])

    return (attach(docs, nodes, "doc_id", "th", how="inner").select("node", "text")
            .mapInArrow(run, "node bigint, tokens array<bigint>"))


def plausible(pairs: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose sizes and sketches allow a link, which few do; exact sets are fetched for these only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, other = b.column("m").to_numpy(), b.column("n").to_numpy()
            ok = 100 * np.minimum(size, other) >= percent * np.maximum(size, other)
            for k in np.flatnonzero(ok).tolist():
                s, t = folded([b.column("s")[k].as_py(), b.column("t")[k].as_py()])
                ok[k] = int(np.bitwise_count(s ^ t).sum()) <= allowed(int(size[k]), int(other[k]), percent)
            yield b.select(["x", "y"]).filter(pa.array(ok))

    a = info.select(F.col("node").alias("x"), F.col("size").alias("m"), F.col("sketch").alias("s"))
    c = info.select(F.col("node").alias("y"), F.col("size").alias("n"), F.col("sketch").alias("t"))
    return (pairs.join(a, "x").join(c, "y").select("x", "y", "m", "n", "s", "t")
            .mapInArrow(run, "x bigint, y bigint"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose exact sets link."""
    a = sets.select(F.col("node").alias("x"), F.col("tokens").alias("s"))
    c = sets.select(F.col("node").alias("y"), F.col("tokens").alias("t"))
    both = F.size(F.array_intersect("s", "t"))
    return pairs.join(a, "x").join(c, "y").where(
        both * 100 >= (F.size("s") + F.size("t") - both) * percent).select("x", "y")


def pivot_pairs(shared: DataFrame) -> DataFrame:
    """(x, y): every node with the pivot that it shares most parts with.  The
    pivot of a part is its most central node, the one whose parts hold most
    nodes: in a group of edited copies, the least edited ones."""
    size = materialize(shared.groupBy("value").agg(F.count("*").alias("c")), "value-sizes")
    central = materialize(shared.join(size, "value").groupBy("node").agg(F.sum("c").alias("c")), "centrality")
    pivot = materialize(shared.join(central, "node").groupBy("value").agg(F.max_by("node", "c").alias("pivot")), "pivots")
    count = (shared.join(pivot, "value").where("node <> pivot").groupBy("node", "pivot")
             .agg(F.count("*").alias("c")))
    return count.groupBy("node").agg(F.max_by("pivot", "c").alias("y")).select(F.col("node").alias("x"), "y")


def cross_pairs(shared: DataFrame, info: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(x, y): nodes of different components that share a part and whose sketches allow a link."""
    rows = materialize(shared.join(labels.select("node", "label"), "node", "left").select(
        "value", "node", F.coalesce("label", "node").alias("label")), "labelled-values")
    mixed = materialize(rows.groupBy("value").agg(
        F.min("label").alias("a"), F.max("label").alias("z"), F.count("*").alias("c"))
        .where("a <> z").select("value", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")), "mixed-values")
    rows = rows.join(mixed, "value").join(info.select("node", "size", "sketch"), "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       "own", "node", "label", "size", "sketch")

    def compare(t: pa.Table) -> pa.RecordBatch:
        node, label, size = (t.column(x).to_numpy() for x in ("node", "label", "size"))
        own, i, j = t.column("own").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
        bits = folded(t.column("sketch").to_pylist())
        xs, ys = [], []
        left = np.flatnonzero(own == i)
        right = np.flatnonzero(own == j)
        for k, a in enumerate(left.tolist()):
            c = right[k + 1:] if i == j else right
            c = c[label[c] != label[a]]
            small, large = np.minimum(size[c], size[a]), np.maximum(size[c], size[a])
            c = c[100 * small >= percent * large]
            if len(c):
                far = np.bitwise_count(bits[c] ^ bits[a]).sum(axis=1)
                c = c[far <= allowed(size[c], size[a], percent)]
                xs.append(np.minimum(node[c], node[a]))
                ys.append(np.maximum(node[c], node[a]))
        return pa.record_batch([pa.array(np.concatenate([*z, np.zeros(0, dtype=np.int64)])) for z in (xs, ys)],
                               names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            v, i, j = (held.column(x).to_numpy() for x in ("value", "i", "j"))
            heads = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
            for s, e in zip(heads[:-1].tolist(), heads[1:].tolist()):
                yield compare(held.slice(s, e - s))
            held = held.slice(int(heads[-1]))
        if held is not None and held.num_rows:
            yield compare(held)

    return (rows.repartition("value", "i", "j").sortWithinPartitions("value", "i", "j", "node")
            .mapInArrow(run, "x bigint, y bigint").distinct())


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the left sets (rows) with the right ones."""
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    column, row = number[column[keep]], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((len(left), len(right)))
    for c in range(0, int(shared.sum()), COLUMNS):
        s, e = np.searchsorted(column, [c, c + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[row[s:e], column[s:e] - c] = 1
        out += part[left] @ part[right].T
    return out


def link_counts(labels: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, links): the documents of the other nodes that each node of a
    component links with, from ``nodes`` (node, size, copies)."""
    # sets that link lie in one band of sizes or in adjacent ones
    band = F.floor(F.log("size") / (np.log(100 / percent) + 0.001 if percent < 100 else 1.0)).cast("int")
    rows = labels.select("node", "label").join(nodes, "node").withColumn("band", band)
    load = F.greatest(F.ceil(F.col("c") / LINK_BLOCK), F.ceil(F.col("t") / LINK_TOKENS)).cast("int")
    cells = materialize(rows.groupBy("label", "band").agg(F.count("*").alias("c"), F.sum("size").alias("t"))
                        .select("label", "band", "c", "t", load.alias("blocks")), "link-cells")
    small = cells.groupBy("label").agg(F.sum("c").alias("c"), F.sum("t").alias("t")).where(load == 1).select(
        "label", F.lit(True).alias("small"))
    # bands of one component number at most the logarithm of its largest set
    above = cells.select("label", (F.col("band") - 1).alias("band"), F.col("blocks").alias("up"))
    below = cells.select("label", (F.col("band") + 1).alias("band"), F.col("blocks").alias("down"))
    plan = materialize(cells.join(small, "label", "left").join(above, ["label", "band"], "left")
                       .join(below, ["label", "band"], "left").drop("c", "t"), "link-plan")
    rows = rows.join(plan, ["label", "band"])
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")

    def cell(low, i, j, two, side):
        return F.struct(low.alias("low"), i.alias("i"), j.alias("j"), F.lit(two).alias("two"), F.lit(side).alias("side"))

    def upto(count):
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    b = F.col("band")
    within = F.transform(upto(F.col("blocks")), lambda k: F.struct(
        b.alias("low"), F.least("own", k).alias("i"), F.greatest("own", k).alias("j"), F.lit(False).alias("two"),
        (F.col("own") > k).alias("side")))
    upper = F.transform(upto(F.col("up")), lambda k: cell(b, F.col("own"), k, True, False))
    lower = F.transform(upto(F.col("down")), lambda k: cell(b - 1, k, F.col("own"), True, True))
    alone = F.array(cell(F.lit(0), F.lit(0), F.lit(0), False, False))
    rows = rows.withColumn("own", own).select(
        "label", "node", "size", "copies", F.explode(F.when(F.col("small"), alone).otherwise(
            F.concat(within, upper, lower))).alias("at")).select("label", "at.*", "node", "size", "copies")
    keys = ["label", "low", "i", "j", "two"]

    def count(t: pa.Table) -> pa.RecordBatch:
        node, size, copies = (t.column(x).to_numpy() for x in ("node", "size", "copies"))
        far = t.column("side").to_numpy(zero_copy_only=False)
        same = not t.column("two")[0].as_py() and t.column("i")[0].as_py() == t.column("j")[0].as_py()
        left = np.arange(len(node)) if same else np.flatnonzero(~far)
        right = left if same else np.flatnonzero(far)
        tokens = [x.values.to_numpy() for x in t.column("tokens")]
        both = intersections(tokens, left, right)
        link = 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)
        if same:
            np.fill_diagonal(link, False)
        found = np.zeros(len(node), dtype=np.int64)
        found[left] += link @ copies[right]
        if not same:
            found[right] += link.T @ copies[left]
        return pa.record_batch([pa.array(node), pa.array(found)], names=["node", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            columns = [batch.column(x).to_numpy(zero_copy_only=False) for x in keys]
            heads = np.flatnonzero(np.logical_or.reduce([np.concatenate([[True], c[1:] != c[:-1]]) for c in columns]))
            for s, e in zip(heads.tolist(), [*heads[1:].tolist(), batch.num_rows]):
                key = tuple(c[s] for c in columns)
                if key != last and held:
                    yield count(pa.concat_tables(held).combine_chunks())
                    held = []
                last = key
                held.append(pa.Table.from_batches([batch.slice(s, e - s)]))
        if held:
            yield count(pa.concat_tables(held).combine_chunks())

    parts = (rows.join(sets, "node").repartition(*keys).sortWithinPartitions(*keys)
             .select(*keys, "side", "node", "size", "copies", "tokens").mapInArrow(run, "node bigint, links bigint"))
    return parts.groupBy("node").agg(F.sum("links").alias("links"))


def labelled(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, links: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, th, n_shingles and the ``label`` of its component (empty sets: none of
    their own); with ``links`` also n_links, the number of other documents it links with."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("th"),
                    F.coalesce("text", F.lit("")).alias("text"))
    clashes = START_CLASHES
    while True:
        info = materialize(profiles(d, n, percent, clashes), "profiles")
        rep = info.where("size > 0").groupBy("node").agg(
            F.min("doc_id").alias("first"), F.min("check").alias("a"), F.max("check").alias("z"), F.max("size").alias("size"),
            F.min_by("doc_id", "th").alias("doc_id"), F.min("th").alias("th"), F.first("sketch").alias("sketch"))
        rep = materialize(rep, "nodes")
        # different sets of one 64-bit node: these few get nodes from all 128 bits
        same = [r.node for r in rep.where("a <> z").select("node").limit(CLASHES + 1).collect()]
        if not same:
            break
        if len(same) > CLASHES or clashes & set(same):
            raise RuntimeError("digests of different sets are equal")
        clashes |= frozenset(same)
    shared, shared_at = materialize(shared_values(d.select("doc_id", "th", "text"), n, percent, clashes), "shared-values", path=True)
    nodes = attach(rep.select("node", "doc_id", "th"), shared.select("node").distinct(), "node", how="left_semi")
    twins = info.groupBy("doc_id", "th").agg(F.count("*").alias("c")).where("c > 1").limit(1).count()
    sets, sets_at = materialize(token_sets(d.dropDuplicates(["doc_id", "th"]) if twins else d, nodes, n),
                                "token-sets", path=True)
    likely = materialize(plausible(pivot_pairs(shared), rep, percent), "pivot-pairs")
    found = materialize(verified(likely, sets, percent), "pivot-links")
    labels = components(found)
    more = materialize(verified(cross_pairs(shared, rep, labels, percent), sets, percent), "cross-links")
    discard(docs.sparkSession, shared_at)
    if more.limit(1).count():
        labels = components(found.unionAll(more))
    told = info.join(labels, "node", "left")
    if links:
        texts = info.where("size > 0").select("node", "size", "doc_id", "th")
        copies = materialize((texts.distinct() if twins else texts).groupBy("node").agg(
            F.first("size").alias("size"), F.count("*").alias("copies")), "copies")
        counts = materialize(link_counts(labels, copies, sets, percent), "link-counts")
        told = told.join(copies.drop("size"), "node", "left").join(counts, "node", "left").withColumn(
            "n_links", F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0)))
    discard(docs.sparkSession, sets_at)
    return told.select("doc_id", "th", F.col("size").alias("n_shingles"), F.coalesce("label", "node").alias("label"),
                       *(["n_links"] if links else []))


def near_duplicates(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, th, n_shingles, component_id, n_links (other documents it links with)."""
    label = labelled(docs, n, percent, links=True)
    least = materialize(label.where("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("least")), "least-ids")
    out = label.join(least, "label", "left")
    return out.select("doc_id", "th", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least"))
                      .otherwise(F.col("doc_id")).alias("component_id"), "n_links")


def keep_one(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, one_per_id: bool = True) -> DataFrame:
    """``docs`` with one document of every component, all columns kept: the
    one of smallest (doc_id, text digest), null ids last; a row that repeats
    it goes.  Empty sets always stay.  With ``one_per_id``, of rows that share
    a non-null id one stays, even if their texts differ."""
    found = labelled(docs, n, percent)
    times = found.where("n_shingles > 0").groupBy("label", "doc_id", "th").agg(F.count("*").alias("times"))
    best = times.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "times")).alias("b"))
    keep = materialize(best.select("b.doc_id", "b.th", "b.times").unionAll(
        # below zero: rows that repeat an empty set all stay
        found.where("n_shingles = 0").groupBy("doc_id", "th").agg(-F.count("*"))), "kept-ids")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       docs["doc_id"].cast("bigint").alias("doc_id"), text_key(docs["text"]).alias("th"))
    out = attach(rows, keep, "doc_id", "th", how="inner")
    if keep.where("times > 1").limit(1).count():
        out = out.where("times <= 1").unionAll(out.where("times > 1").dropDuplicates(["doc_id", "th"]))
    ids = keep.where("doc_id is not null").groupBy("doc_id").agg(F.sum(F.abs("times")).alias("c"))
    if one_per_id and ids.where("c > 1").limit(1).count():
        out = out.where("doc_id is null").unionAll(out.where("doc_id is not null").dropDuplicates(["doc_id"]))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])
