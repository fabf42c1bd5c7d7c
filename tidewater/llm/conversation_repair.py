"""Conversation structure repair by survivor-coalescence Viterbi.

Rows of a conversation are kept, given another role, deleted, or preceded by
inserted empty turns, so that the initials of the roles read ``(s?(ua)+)?`` at
the least cost; of equally cheap repairs the one whose edit initials (D I K R)
are ASCII-least.

The search is a shortest path over four states (nothing yet, system said, user
said, assistant said).  A conversation may hold any share of all rows, so it
is not one task's work: rows are put in order over all conversations and cut
into chunks; every chunk is searched from each of the four states at once; the
16 best passages of a chunk are the edges of one more search over the chunks
of a conversation.  Both searches are ``survivor_viterbi``: edits are given
out as soon as all survivors agree, memory follows what is undecided.

An insert stands directly before a kept or re-roled row or at the end: before
a deleted row it costs the same and sorts later.  So every row's label ends in
its only non-insert and no survivor is a prefix of another.

Defined cases: null role and text read as one space, a null conversation id is
a conversation, null turns come first; rows of one turn are ordered by role
and text; equal rows are all given (all but the first are duplicates); a
conversation without rows is not in the result; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import SPACES, attach, materialize
from .survivor_viterbi import Edge, Survivors

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: What ends a conversation in each state: inserted turns.
CLOSING = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: What it costs more at most to go on from the second state as a path goes on from the first: a
#: later system turn must be deleted, a user's turn made up or answered, a lone system turn closed.
DETOUR = {
    EMPTY: {SYSTEM: 2 * INSERT, USER: INSERT + DELETE, ASSISTANT: DELETE},
    SYSTEM: {EMPTY: 0, USER: INSERT, ASSISTANT: 0},
    USER: {EMPTY: INSERT, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {EMPTY: 0, SYSTEM: 2 * INSERT, USER: INSERT},
}
#: Rows of a chunk: the lower bits of a row's place.
CHUNK_BITS = 12
#: The chunk behind all others: inserts that close a conversation.
CLOSE = (1 << 63) - 1

FINE, BLANK, DUPLICATE, CUT_OFF = range(4)


def _said(state: int, initial: str) -> int | None:
    """The state after a turn with this initial, if it may follow ``state``."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def _turn(state: int) -> int:
    """The state after the turn that ``state`` asks for: a user's, or the answer to it."""
    return ASSISTANT if state == USER else USER


def row_edges(initial: str, fault: int) -> list[Edge]:
    """The cheapest edit of a row for each pair of states, before closing."""
    best: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(i: int, j: int | None, cost: int, label: str) -> None:
        if j is not None and (cost, label) < best.get((i, j), (1 << 60, "")):
            best[i, j] = cost, label

    more = TRUNCATED if fault == CUT_OFF else 0
    for state in range(4):
        offer(state, state, DELETE, "D")
        if fault in (BLANK, DUPLICATE):
            continue
        at, cost, inserts = state, more, ""
        for _ in range(2):
            offer(state, _said(at, initial), cost + KEEP, inserts + "K")
            offer(state, _turn(at), cost + REROLE, inserts + "R")
            at, cost, inserts = _turn(at), cost + INSERT, inserts + "I"
    return [(i, j, c, x) for (i, j), (c, x) in best.items()]


EDGES = {(x, f): row_edges(x, f) for x in ("s", "u", "a", "") for f in (FINE, BLANK, DUPLICATE, CUT_OFF)}
LEGAL = {"su", "ua", "au"}


# -- faults and order ----------------------------------------------------------

def mark_faults(turns: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, text) with the number of its
    copies and the first fault of the first of them: blank, duplicate (role and text
    stand in an earlier turn), truncated.  Further copies are blank or duplicates."""
    space = F.lit(" ")
    t = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    same = t.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    same = same.withColumn("said", F.unhex(F.md5("text")))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = (t.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("said"))
             .groupBy("conv_id", "role", "said").agg(F.min(when).alias("first")))
    same = attach(same, first, "conv_id", "role", "said").withColumn(
        "again", ~F.col("first.turn").eqNullSafe(F.col("turn")))
    end = F.substring(F.btrim("text", F.lit(SPACES)), -1, 1)
    fault = (F.when(end == "", BLANK).when(F.col("again"), DUPLICATE)
             .when(~end.isin(".", "!", "?"), CUT_OFF).otherwise(FINE))
    return same.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


def place(turns: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """``mark_faults`` in order over all conversations: ``place`` rises with
    (conv_id, turn, role, text), ``chunk`` cuts it into bounded pieces."""
    marked = materialize(mark_faults(turns), "turns")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    out = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    out = out.withColumn("place", F.monotonically_increasing_id())
    return materialize(out.withColumn("chunk", F.shiftright("place", chunk_bits)), "placed")


# -- the two searches ------------------------------------------------------------

PASSAGE = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("label", pa.string())])
PASSAGE_DDL = "array<struct<`from`: int, `to`: int, cost: bigint, label: string>>"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for at in range(0, b.num_rows, 512):
            yield from b.slice(at, 512).to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``size`` characters."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += 64 + sum(len(v) for v in r.values() if isinstance(v, (str, list)))
        if n > size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _groups(rows: Iterator[dict], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Runs of rows with equal keys, streamed."""
    row = next(rows, None)
    while row is not None:
        key = tuple(row[k] for k in keys)

        def run() -> Iterator[dict]:
            nonlocal row
            while row is not None and tuple(row[k] for k in keys) == key:
                yield row
                row = next(rows, None)

        r = run()
        yield key, r
        for _ in r:
            pass


def passages(placed: DataFrame) -> DataFrame:
    """Per (conv_id, chunk): counts of faults, what its ends look like, and the
    cheapest way from each state to each state."""
    conv = placed.schema["conv_id"].dataType
    fields = [("chunk", "bigint"), ("blank", "bigint"), ("duplicate", "bigint"), ("truncated", "bigint"),
              ("illegal", "bigint"), ("first_initial", "string"), ("last_initial", "string"),
              ("n_turns", "bigint"), ("first_turn", "bigint"), ("last_turn", "bigint")]
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([("conv_id", to_arrow_type(conv)), *[(n, kinds[k]) for n, k in fields], ("ways", pa.list_(PASSAGE))])

    def one(key: tuple, rows: Iterator[dict]) -> dict:
        out = dict.fromkeys((n for n, _ in fields), 0) | {"conv_id": key[0], "chunk": key[1]}
        out |= {"first_initial": None, "last_initial": None, "first_turn": None, "last_turn": None}
        search = {s: Survivors(s, DETOUR) for s in range(4)}
        sure: dict[int, list[str]] = {s: [] for s in range(4)}
        for r in rows:
            initial = r["initial"]
            for copy in range(r["copies"]):
                fault = r["fault"] if copy == 0 or r["fault"] == BLANK else DUPLICATE
                out["blank"] += fault == BLANK
                out["duplicate"] += fault == DUPLICATE
                out["truncated"] += fault == CUT_OFF
                if out["last_initial"] is None:
                    out["first_initial"] = initial
                else:
                    out["illegal"] += out["last_initial"] + initial not in LEGAL
                out["last_initial"] = initial
                edges = EDGES[initial if initial in ("s", "u", "a") else "", fault]
                for s, x in search.items():
                    sure[s].extend(x.step(edges))
            if r["turn"] is not None:
                out["n_turns"] += r["turn"] != out["last_turn"]
                out["last_turn"] = r["turn"]
                if out["first_turn"] is None:
                    out["first_turn"] = r["turn"]
        out["ways"] = []
        for s, x in search.items():
            head = "".join(sure[s])
            out["ways"] += [{"from": s, "to": j, "cost": cost, "label": head + "".join(tail)}
                            for j, (cost, _, tail) in x.tails().items()]
        return out

    def work(batches):
        yield from _batches((one(k, r) for k, r in _groups(_rows(batches), "conv_id", "chunk")), schema)

    narrow = placed.select("conv_id", "chunk", "place", F.col("turn").cast("bigint").alias("turn"), "copies", "fault",
                           F.substring("role", 1, 1).alias("initial"))
    ddl = f"conv_id {conv.simpleString()}, " + ", ".join(f"{n} {k}" for n, k in fields) + f", ways {PASSAGE_DDL}"
    return (narrow.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "place")
            .mapInArrow(work, ddl))


def settle(ways: DataFrame) -> DataFrame:
    """The search over the chunks of each conversation.  Per chunk a row with its
    ``edits`` and the state it is ``entered`` in; beside them one row per
    conversation with a null chunk and its totals."""
    conv = ways.schema["conv_id"].dataType
    totals = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", to_arrow_type(conv)), ("chunk", pa.int64()), ("entered", pa.int32()),
                        ("edits", pa.string()), *[(n, pa.int64()) for n in totals]])

    def one(key: tuple, rows: Iterator[dict]) -> Iterator[dict]:
        total = dict.fromkeys(totals, 0)
        search, chunks = Survivors(EMPTY, DETOUR), []
        turns, low, high, last = 0, None, None, None

        def given(label: tuple[str, int]) -> dict:
            return {"conv_id": key[0], "chunk": chunks.pop(0), "entered": label[1], "edits": label[0]}

        for r in rows:
            for n in ("blank", "duplicate", "truncated", "illegal"):
                total[n] += r[n]
            if last is not None:
                total["illegal"] += last + r["first_initial"] not in LEGAL
            last = r["last_initial"]
            if r["first_turn"] is not None:
                turns += r["n_turns"] - (r["first_turn"] == high)
                low, high = r["first_turn"] if low is None else low, r["last_turn"]
            chunks.append(r["chunk"])
            for label in search.step((w["from"], w["to"], w["cost"], (w["label"], w["from"])) for w in r["ways"]):
                yield given(label)
        cost, _, end, tail = min((c + INSERT * len(CLOSING[s]), p, s, t) for s, (c, p, t) in search.tails().items())
        for label in tail:
            yield given(label)
        if CLOSING[end]:
            yield {"conv_id": key[0], "chunk": CLOSE, "entered": end, "edits": CLOSING[end]}
        total |= {"cost": cost, "gaps": 0 if low is None else high - low + 1 - turns}
        yield {"conv_id": key[0], "chunk": None, "entered": None, "edits": None} | total

    def work(batches):
        yield from _batches((x for k, r in _groups(_rows(batches), "conv_id") for x in one(k, r)), schema)

    ddl = f"conv_id {conv.simpleString()}, chunk bigint, entered int, edits string, " + ", ".join(
        f"{n} bigint" for n in totals)
    return ways.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(work, ddl)


def repair(turns: DataFrame, chunk_bits: int = CHUNK_BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(placed, edits, totals): the rows in order, the edits of every chunk, and per
    conversation its gaps, faults and the cost of its repair."""
    placed = place(turns, chunk_bits)
    settled = materialize(settle(passages(placed)), "settled")
    edits = settled.where(F.col("chunk").isNotNull()).select("conv_id", "chunk", "entered", "edits")
    return placed, edits, settled.where(F.col("chunk").isNull()).drop("chunk", "entered", "edits")


# -- applying the edits ------------------------------------------------------------

def _applied(rows: Iterator[dict]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every edit of some chunks in order; deleted rows keep their role and text."""
    edits, at, state = "", 0, EMPTY

    def inserted() -> Iterator[tuple[str, str, str]]:
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            at, state = at + 1, _turn(state)
            yield "I", ("assistant" if state == ASSISTANT else "user"), ""

    for r in rows:
        if r["edits"] is not None:
            yield from inserted()
            edits, at, state = r["edits"], 0, r["entered"]
            continue
        for _ in range(r["copies"]):
            yield from inserted()
            edit, role = edits[at], r["role"]
            at += 1
            if edit == "R":
                state = _turn(state)
                role = "assistant" if state == ASSISTANT else "user"
            elif edit == "K":
                state = _said(state, role[:1])
            yield edit, role, r["text"]
    yield from inserted()


def _with_edits(placed: DataFrame, edits: DataFrame, *keys: str) -> DataFrame:
    """Rows and, before those of a chunk, its edits; dealt by ``keys`` and in order."""
    none = lambda kind: F.lit(None).cast(kind)
    rows = placed.select("conv_id", "chunk", "place", "role", "text", "copies",
                         none("string").alias("edits"), none("int").alias("entered"))
    heads = edits.select("conv_id", "chunk", F.lit(-1).cast("bigint").alias("place"), none("string").alias("role"),
                         none("string").alias("text"), none("bigint").alias("copies"), "edits", "entered")
    return rows.unionByName(heads).repartition(*keys).sortWithinPartitions("conv_id", "chunk", "place")


def repaired(placed: DataFrame, edits: DataFrame) -> DataFrame:
    """The edits as rows: conv_id, chunk, step (order within the chunk), edit, role, text."""
    conv = placed.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(conv)), ("chunk", pa.int64()), ("step", pa.int64()),
                        ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def work(batches):
        yield from _batches(({"conv_id": k[0], "chunk": k[1], "step": i, "edit": e, "role": role, "text": text}
                             for k, rows in _groups(_rows(batches), "conv_id", "chunk")
                             for i, (e, role, text) in enumerate(_applied(rows))), schema)

    ddl = f"conv_id {conv.simpleString()}, chunk bigint, step bigint, edit string, role string, text string"
    return _with_edits(placed, edits, "conv_id", "chunk").mapInArrow(work, ddl)


def digests(placed: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256).  A digest is sequential, so the rows of a
    conversation pass through one task here, streamed; nothing of them is held but the audit."""
    conv = placed.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(conv)), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def one(key: tuple, rows: Iterator[dict]) -> dict:
        audit, sha, some = [], hashlib.sha256(), False
        for edit, role, text in _applied(rows):
            audit.append(edit)
            if edit != "D":
                sha.update((("\n" if some else "") + f"{role}:{text}").encode())
                some = True
        return {"conv_id": key[0], "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}

    def work(batches):
        yield from _batches((one(k, r) for k, r in _groups(_rows(batches), "conv_id")), schema)

    return _with_edits(placed, edits, "conv_id").mapInArrow(
        work, f"conv_id {conv.simpleString()}, audit string, repaired_sha256 string")
