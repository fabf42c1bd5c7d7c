"""Conversation repair against plain versions: the search, chunks, edits, digests, edge rows."""
import hashlib
import random
import re
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import conversation_repair as cr
from tidewater.llm import queries
from tidewater.llm.survivor_viterbi import Survivors

SHAPE = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"


def faulty(rows):
    """(initial, fault) of rows in order."""
    out, seen = [], set()
    for role, text in rows:
        body = text.strip(SPACES)
        out.append((role[:1], cr.BLANK if not body else cr.DUPLICATE if (role, text) in seen
                    else cr.CUT_OFF if body[-1] not in ".!?" else cr.FINE))
        seen.add((role, text))
    return out


def plain_search(rows):
    """Every state with its cheapest, least complete audit, as whole strings."""
    best = {"": (0, "")}  # the shape told so far, cut to what matters: "", "s", "u", "a"
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    for initial, fault in rows:
        new = {}
        for state, (cost, audit) in best.items():
            ways = [(state, cost + 3, audit + "D")]
            if fault not in (cr.BLANK, cr.DUPLICATE):
                at, c, t = state, cost + (fault == cr.CUT_OFF), audit
                for _ in range(4):
                    if initial == after[at] or initial == "s" and at == "":
                        ways.append((initial, c, t + "K"))
                    ways.append((after[at], c + 2, t + "R"))
                    at, c, t = after[at], c + 2, t + "I"
            for s, c, t in ways:
                new[s] = min(new.get(s, (1 << 60, "")), (c, t))
        best = new
    close = {"": (0, ""), "s": (4, "II"), "u": (2, "I"), "a": (0, "")}
    return min((c + close[s][0], t + close[s][1]) for s, (c, t) in best.items())


def apply(rows, audit):
    out, at, shape = [], 0, ""
    for e in audit:
        want = "assistant" if shape[-1:] == "u" else "user"
        if e == "D":
            at += 1
            continue
        role, text = (want, "") if e == "I" else (want, rows[at][1]) if e == "R" else rows[at]
        at += e != "I"
        out.append(f"{role}:{text}")
        shape += role[:1]
    return shape, out


def exhaustive(rows, marks):
    """The least (cost, audit) of all audits with up to two inserts in each place."""
    best = (1 << 60, "")
    for gaps in product(("", "I", "II"), repeat=len(rows) + 1):
        for edits in product("DKR", repeat=len(rows)):
            if any(e != "D" and f in (cr.BLANK, cr.DUPLICATE) for e, (_, f) in zip(edits, marks)):
                continue
            audit = "".join(g + e for g, e in zip(gaps, edits)) + gaps[-1]
            if SHAPE.fullmatch(apply(rows, audit)[0]):
                cost = sum({"D": 3, "K": 0, "R": 2, "I": 2}[e] for e in audit)
                cost += sum(e != "D" and f == cr.CUT_OFF for e, (_, f) in zip(edits, marks))
                best = min(best, (cost, audit))
    return best


def searched(marks):
    """The operator's search over one chunk."""
    s, sure = Survivors(cr.EMPTY, cr.DETOUR), []
    for initial, fault in marks:
        sure += s.step(cr.EDGES[initial if initial in "sua" else "", fault])
    return min((c + 2 * len(cr.CLOSING[j]), "".join(sure) + "".join(t) + cr.CLOSING[j]) for j, (c, _, t) in s.tails().items())


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_search_against_all_audits(n):
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("a.", "b")] + [("user", " ")]
    rng = random.Random(n)
    for _ in range(40):
        rows = [rng.choice(kinds) for _ in range(n)]
        marks = faulty(rows)
        assert plain_search(marks) == searched(marks) == exhaustive(rows, marks)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.integers(0, 3)), max_size=60))
def test_search(marks):
    assert searched(marks) == plain_search(marks)


def test_memory_follows_the_undecided_part():
    """A long well-formed conversation is given out on the way; alternatives that never meet are held whole."""
    s, held = Survivors(cr.EMPTY, cr.DETOUR), 0
    for k in range(20_000):
        list(s.step(cr.EDGES["ua"[k % 2], cr.FINE]))
        held = max(held, s.nodes)
    assert held < 60
    s = Survivors(cr.EMPTY, cr.DETOUR)
    given_out = sum(len(list(s.step(cr.EDGES["", cr.FINE]))) for _ in range(500))
    assert given_out < 500 and s.nodes > 500


def conversations(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    texts = ["Well.", "yes?", "no", " ", "", None, "Ok!\n", "x　", "…"]
    rows = [(c if c else None, rng.choice([None, 0, 1, 1, 2, 3, 5, 9, k]), rng.choice(roles), rng.choice(texts))
            for c in range(25) for k in range(rng.randint(1, n))]
    rows += [(50, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}.") for k in range(300)]
    rows += [(51, 1, "user", "Same.")] * 40 + [(52, k, "tool", f"{k}") for k in range(60)]
    return rows


def test_repair(spark):
    rows = conversations(random.Random(4), 14)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn int, role string, text string, "
                               "chunk string, edits string").repartition(5)
    groups = {}
    for c, turn, role, text in rows:
        groups.setdefault(c, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    want = {}
    for c, g in groups.items():
        said = [x[2:] for x in sorted(g)]
        marks = faulty(said)
        cost, audit = plain_search(marks)
        shape, out = apply(said, audit)
        assert SHAPE.fullmatch(shape)
        turns = {x[1] for x in g if x[0]}
        want[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                   *(sum(f == k for _, f in marks) for k in (cr.BLANK, cr.DUPLICATE, cr.CUT_OFF)),
                   sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(marks, marks[1:])), cost,
                   audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    for bits in (2, 12):  # chunks of four rows, and one chunk
        placed, edits, totals = cr.repair(df, bits)
        got = {r.conv_id: tuple(r)[1:] for r in totals.collect()}
        dig = {r.conv_id: tuple(r)[1:] for r in cr.digests(placed, edits).collect()}
        assert {c: (*got[c], *dig[c]) for c in want} == want and len(got) == len(want)
        if bits == 2:
            assert edits.where("conv_id = 50").count() >= 75
        steps = sorted((str(r.conv_id), r.chunk, r.step, r.edit, r.role, r.text) for r in cr.repaired(placed, edits).collect())
        for c in want:
            own = [r for r in steps if r[0] == str(c)]
            assert "".join(r[3] for r in own) == want[c][6]
            assert hashlib.sha256("\n".join(f"{r[4]}:{r[5]}" for r in own if r[3] != "D").encode()).hexdigest() == want[c][7]
    placed, edits, totals = cr.repair(df.limit(0))
    assert totals.count() == cr.digests(placed, edits).count() == 0


def test_damage(spark):
    """The query's faults; a conversation that loses all its rows stays with zeros."""
    import zlib
    lost = next(i for i in range(10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    ids = {k: next(i for i in range(10_000) if zlib.crc32(f"{i}:1".encode()) % 20 == k) for k in range(5)}
    rows = [(lost, 0, "user", "Gone.")] + [(i, 1, "system", "A.b") for i in ids.values()] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted((str(r.conv_id), r.role, r.text) for r in queries.damaged(df).collect())
    assert got == sorted([(str(ids[1]), "system", ""), (str(ids[2]), "system", "Ab"), (str(ids[3]), "system", "A.b"),
                          (str(ids[3]), "system", "A.b"), (str(ids[4]), "user", "A.b"),
                          *([("None", " ", " ")] * [1, 1, 1, 2, 1][min(zlib.crc32(b" : ") % 20, 4)]
                            if zlib.crc32(b" : ") % 20 else [])])
