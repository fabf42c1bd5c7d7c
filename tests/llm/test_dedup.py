"""Suffix-array dedup, parity-sketch join and unit dedup against plain versions."""
import random
import re
import string
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tidewater.llm import parity_join, substring_units, suffix_dedup
from tidewater.llm.components import components

from .conftest import prose

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# -- repeated byte strings -------------------------------------------------

def plain_repeats(rows, length, keep):
    """{(id, text): removed byte flags}; rows that repeat (id, text) are one document."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is None, x[0] or 0))
    starts = Counter()
    for _, t in docs:
        b = t.encode()
        starts.update(b[p:p + length] for p in range(len(b) - length + 1))
    seen, out = set(), {}
    for i, t in docs:
        b = t.encode()
        flags = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if (starts[w] > 1) if keep == "none" else (w in seen):
                flags[p:p + length] = b"\1" * length
            seen.add(w)
        out[i, t] = flags
    return out


def check_repeats(spark, rows, length, keep, gram):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = suffix_dedup.remove_repeats(df, length, keep, gram).collect()
    assert len(got) == len(rows)
    want = plain_repeats(rows, length, keep)
    kept = Counter((r.doc_id, r.n_bytes, bytes(r.kept), tuple((s.start, s.end) for s in r.spans)) for r in got)
    exp = Counter()
    for i, t in rows:
        flags = want[i, t or ""]
        b = (t or "").encode()
        runs = tuple((m.start(), m.end()) for m in re.finditer(b"\1+", bytes(flags)))
        exp[i, len(b), bytes(x for x, f in zip(b, flags) if not f), runs] += 1
    assert kept == exp


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("many", [0, 8192])
def test_repeats_of_short_strings(spark, monkeypatch, keep, many):
    """Small alphabet, periodic texts, segments that cut anchors; with many = 0 every gram is spread by window."""
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 97)
    rng = random.Random(5)
    common = "".join(rng.choice("abcd") for _ in range(80))
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(40)))
             + common[rng.randrange(40):rng.randrange(40, 80)] + "".join(rng.choice("abcdefgh") for _ in range(30)))
            for i in range(60)]
    rows += [(70, "ab" * 60), (71, "a" * 100), (72, "é" * 30), (73, None), (74, ""), (75, "abcdefghijk"),
             (76, common), (77, common), (77, common), (None, common + "z")]
    check_repeats(spark, rows, 12, keep, 8)


@pytest.mark.parametrize("keep", ["none", "first"])
def test_repeats_of_edge_rows(spark, edge_rows, keep):
    check_repeats(spark, [(i, t) for i, t, *_ in edge_rows], 200, keep, 64)


@pytest.mark.parametrize("length", [5, 8, 19])
def test_factor_lengths(length):
    """Suffix order, common prefixes and longest previous factors against all pairs, zero and high bytes included."""
    rng = np.random.default_rng(length)
    data = rng.choice(np.array([0, 1, 255], dtype=np.uint8), 300)
    data[200:240] = data[20:60]
    at = np.flatnonzero(rng.random(len(data) - length + 1) < .8)
    group = rng.integers(-1, 2, len(at))
    order, common = suffix_order = suffix_dedup.suffix_order(data, at, group, length)
    text = [data[p:p + length].tobytes() for p in at.tolist()]
    assert order.tolist() == sorted(range(len(at)), key=lambda k: (group[k], text[k], k))

    def shared(x, y):
        if group[x] != group[y]:
            return 0
        return next((i for i in range(length) if text[x][i] != text[y][i]), length)

    assert common.tolist() == [0] + [shared(x, y) for x, y in zip(order[:-1].tolist(), order[1:].tolist())]
    factors = suffix_dedup.previous_factors(*suffix_order)
    assert factors.tolist() == [max((shared(k, j) for j in range(k)), default=0) for k in order.tolist()]
    none = np.zeros(0, dtype=np.int64)
    assert [len(x) for x in suffix_dedup.suffix_order(data, none, none, length)] == [0, 0]
    assert len(suffix_dedup.previous_factors(none, none)) == 0


def test_strip_repeats_keeps_columns(spark, edge_docs, no_docs):
    out = suffix_dedup.strip_repeats(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    text = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    assert text[4] is None and text[5] == "" and text[2] == "" and len(text[1]) > 400
    assert suffix_dedup.strip_repeats(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


# -- near duplicates ---------------------------------------------------------

def plain_sets(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[i:i + n]) for i in range(len(w) - n + 1)])


def plain_components(rows, n, percent):
    sets = [(i, plain_sets(t, n)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    partners = [set() for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            s, t = sets[a][1], sets[b][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                parent[find(a)] = find(b)
                if rows[a] != rows[b]:  # else one document given twice
                    partners[a].add(rows[b])
                    partners[b].add(rows[a])
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(rows)) if find(j) == find(k) and sets[j][0] is not None]
        out.append((i, len(s), min(ids, default=None) if s else i, len(partners[k])))
    return Counter(out)


def near_copies(rng, n_base):
    rows = []
    for k in range(n_base):
        words = prose(rng, rng.choice([3, 5, 8, 12, 20, 45, 150, 400])).split(" ")
        for _ in range(rng.choice([1, 1, 3, 12])):
            w = list(words)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = rng.choice(["neu", "ALT", "mid"])
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("n,percent,block", [(4, 85, 1024), (5, 80, 3)])
def test_near_duplicates(spark, monkeypatch, edge_rows, n, percent, block):
    monkeypatch.setattr(parity_join, "BLOCK", block)
    if block == 3:  # every value counts as hot, links are counted in bands of blocks
        monkeypatch.setattr(parity_join, "LINK_BLOCK", 3)
        monkeypatch.setattr(parity_join, "COLUMNS", 7)
        monkeypatch.setattr(parity_join, "SAMPLE", 1)
        monkeypatch.setattr(parity_join, "HOT", 3)
    rows = near_copies(random.Random(n), 60)
    rows += [(1000 + (i or 0) if i is not None else None, t) for i, t, *_ in edge_rows]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links)
                  for r in parity_join.near_duplicates(df, n, percent).collect())
    assert got == plain_components(rows, n, percent)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(7, 3000))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        m = a.copy()
        drop = rng.random(len(m)) < rng.random() * .3
        m[drop] = rng.integers(0, 2**63, drop.sum()).astype(np.uint64)
        b = np.unique(m)
        both = len(np.intersect1d(a, b))
        differ = len(a) + len(b) - 2 * both
        x, y = parity_join.folded([parity_join.parity(s, 80) for s in (a, b)])
        assert np.bitwise_count(x ^ y).sum() <= differ
        for percent in (80, 85):
            if 100 * both >= percent * (len(a) + len(b) - both):
                assert differ <= parity_join.allowed(len(a), len(b), percent)
                va, vb = (parity_join.join_values(s, percent) for s in (a, b))
                assert differ == 0 or np.intersect1d(va, vb).size


def test_intersections(monkeypatch):
    monkeypatch.setattr(parity_join, "COLUMNS", 16)
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(-50, 50, int(rng.integers(1, 60)))) for _ in range(25)]
    left, right = np.arange(25)[::2], np.arange(25)[1::2]
    got = parity_join.intersections(sets, left, right)
    assert got.tolist() == [[len(np.intersect1d(sets[a], sets[b])) for b in right] for a in left]
    apart = [np.array([k]) for k in range(4)]
    assert not parity_join.intersections(apart, np.arange(2), np.arange(2, 4)).any()


def test_links_of_a_dense_group(spark, monkeypatch):
    """A third of the rows in one group of edited copies, counted in blocks of sizes; copies count as documents."""
    monkeypatch.setattr(parity_join, "LINK_BLOCK", 16)
    rng = random.Random(17)
    words = prose(rng, 60).split(" ")
    rows = []
    for k in range(120):
        w = list(words)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = rng.choice(["neu", "ALT"])
        rows.append((k, " ".join(w + ["end"] * rng.randrange(12))))
    rows += [(200 + k, prose(rng, 40)) for k in range(240)] + rows[:5]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links)
                  for r in parity_join.near_duplicates(df, 4, 85).collect())
    assert got == plain_components(rows, 4, 85)


def test_keep_one(spark, edge_docs, no_docs):
    out = parity_join.keep_one(edge_docs)
    ids = [r.doc_id for r in out.collect()]
    assert out.columns == edge_docs.columns
    assert 1 in ids and 2 not in ids and 3 not in ids and 4 in ids and ids.count(10) == 1 and 7 in ids and 8 not in ids
    assert parity_join.keep_one(no_docs).count() == 0


def test_one_per_component(spark):
    """Unrelated texts with equal or null ids all stay; copies without ids leave one."""
    rng = random.Random(12)
    a, b, c, d, e, f, g = (prose(rng, 60) for _ in range(7))
    rows = [(1, a), (1, a), (2, a), (3, b), (3, c), (None, d), (None, e), (None, f), (None, f), (None, f + " end"),
            (4, g), (None, g), (5, ""), (5, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = Counter(map(tuple, corpus_pipeline.near_duplicates(spark, df, "").collect()))
    last = [x for x in got if x in ((None, f), (None, f + " end"))]
    assert len(last) == 1
    assert got == Counter([(1, a), (3, b), (3, c), (None, d), (None, e), last[0], (4, g), (5, ""), (5, ""), (None, None)])
    by_id = Counter(i for i, _ in parity_join.keep_one(df).collect())
    assert by_id == {1: 1, 3: 1, None: 4, 4: 1, 5: 1}


def test_sets_of_one_64_bit_digest(spark, monkeypatch):
    """Different sets whose first 64 bits agree get nodes from all 128; equal sets stay one node."""
    rng = random.Random(30)
    texts = [prose(rng, 30) for _ in range(6)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(10 + k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    clashes = frozenset([7])
    tokens = [np.array([1, 2], dtype=np.uint64), np.array([3], dtype=np.uint64)]
    both = [(7, parity_join.digest(t)[1]) for t in tokens]
    assert parity_join.node_of(both[0], clashes) != parity_join.node_of(both[1], clashes)
    assert parity_join.node_of(both[0], frozenset()) == 7 and parity_join.node_of((8, 1), clashes) == 8
    want = {r.doc_id: r.component_id for r in parity_join.near_duplicates(df).collect()}
    assert want == {i: i % 10 for i, _ in rows}
    # as if every digest of a text's set had clashed: remapped nodes give the same components
    some = frozenset(r.node for r in parity_join.profiles(
        df.selectExpr("doc_id", "xxhash64(text) th", "text"), 5, 80).collect())
    monkeypatch.setattr(parity_join, "START_CLASHES", some)
    assert {r.doc_id: r.component_id for r in parity_join.near_duplicates(df).collect()} == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (202, 200), (300, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "x bigint, y bigint")).collect()}
    assert len({got[i] for i in [*range(41), 100]}) == 1
    assert got[200] == got[201] == got[202] != got[0]
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


# -- units -------------------------------------------------------------------

@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence"])
def test_units(spark, edge_docs, edge_rows, no_docs, unit):
    sep = {"line": r"\n", "paragraph": r"\n(?:[ \t-\r]*\n)+", "sentence": r"(?<=[。！？])|(?<=[.!?])[ \t]+|\n"}[unit]
    split = lambda t: re.split(sep, t)
    rows = sorted({(i, t) for i, t, *_ in edge_rows if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0))
    extra = "first passage of eight words or some more\n\n\nsecond part of it that has many words too"
    docs = edge_docs.select("doc_id", "text").unionAll(spark.createDataFrame(
        [(500, extra), (501, extra.upper())], "doc_id bigint, text string"))
    seen, gone = set(), {}
    for i, t in [*rows, (500, extra), (501, extra.upper())]:
        gone[i, t], before = [], ""
        for no, u in enumerate(split(t)):
            w = " ".join(re.findall(r"[^\x20\x09-\x0D]+", u.lower()))
            if w:
                key = w if len(w.encode()) >= 40 else (before, w)
                if key in seen:
                    gone[i, t].append(no)
                seen.add(key)
                before = w
    for r in substring_units.drop_repeated_units(docs, unit).collect():
        if r.kept_text is None:
            assert r.n_units == 0
            continue
        source = next(t for (i, t), g in gone.items() if i == r.doc_id and g == [x.unit_no for x in r.removed]
                      and len(split(t)) == r.n_units
                      and "".join(t[k.start:k.end] for k in r.kept) == r.kept_text)
        for x in r.removed:
            text = source[x.start:x.end]
            assert text.split()
    assert substring_units.drop_repeated_units(no_docs, unit).count() == 0


def test_wrapped_passages_and_scripts_without_spaces(spark):
    """A passage wrapped anew goes whole, its short sentences too; so does a copied paragraph without spaces.
    A short sentence or line that another text has elsewhere stays, unless asked for otherwise."""
    rng = random.Random(21)
    sentences = [prose(rng, n) + "." for n in (12, 2, 12, 12, 1, 12, 12)]
    chinese = "天地玄黄宇宙洪荒。日月盈昃辰宿列张！寒来暑往秋收冬藏闰余成岁律吕调阳云腾致雨露结为霜"
    rows = [(1, prose(rng, 20) + ". " + " ".join(sentences)), (2, "\n".join(sentences) + "\n" + prose(rng, 9)),
            (3, prose(rng, 9) + "\n" + chinese), (4, "剑号巨阙。" + chinese),
            (5, prose(rng, 12) + ". Yes. " + prose(rng, 12) + "."), (6, prose(rng, 12) + ".\nYES.\n" + prose(rng, 12))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in substring_units.drop_repeated_units(df, "sentence").collect()}
    assert len(got[2].removed) == 7 and len(got[2].kept_text.split()) == 9 and got[1].kept_text == rows[0][1]
    assert got[4].kept_text == "剑号巨阙。天地玄黄宇宙洪荒。" and got[3].kept_text == rows[2][1]
    assert got[5].kept_text == rows[4][1] and got[6].kept_text == rows[5][1]
    alone = {r.doc_id: r for r in substring_units.drop_repeated_units(df, "sentence", short=0).collect()}
    assert len(alone[6].removed) == 1 and alone[4].kept_text == "剑号巨阙。"
