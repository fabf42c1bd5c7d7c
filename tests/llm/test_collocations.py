"""Phrase collocations against plain counting; the automata against sorted n-grams."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import collocations, count_automata as ca


def plain(rows, min_count, top, inside):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        g = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[g] += len(w)
            for k in (1, 2, 3):
                f[g].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for g, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in cand.items():
            if any(100 * b >= inside * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(2))
                   for q, b in cand.items() if len(q) == 3) and len(p) == 2:
                continue
            score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]):
            out.append((g, i + 1, p.decode(), -a, l, r, n[g], -s))
    return Counter(out)


COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_collocations(spark, edge_docs, edge_rows, no_docs):
    rng = random.Random(5)
    vocab = [a + b for a in ("ba", "Ke", "lo", "é", "日本") for b in ("", "mi", "nu")]
    rows = [(rng.choice(["en", "de", None]), "".join(
        rng.choice(vocab) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r", " and the ", " hot pair "]) for _ in range(300)))
        for _ in range(60)]
    rows += [("und", "hot pair and more"), ("xx", None), ("xx", ""), ("xx", " .!\x0b "), ("en", "a" * 4000)]
    df = spark.createDataFrame([(t, g, "x") for g, t in rows], "text string, lang string, phrase string").repartition(5)
    want = plain(rows, 10, 40, 50)
    assert len(want) > 60
    for shard, words in ((1 << 24, 2_000_000), (2000, 3000)):  # one range; many shards and ranges
        got = collocations.collocations(df, top=40, shard_bytes=shard, range_words=words)
        assert got.columns == COLS
        assert Counter(tuple(r) for r in got.collect()) == want
    texts = df.selectExpr("coalesce(lang, 'und') lang", "text")
    assert len(collocations.prefix_bounds(texts, 3000)) > 3
    got = collocations.collocations(edge_docs, min_count=2, top=10 ** 6)
    assert Counter(tuple(r) for r in got.collect()) == plain([(g, t) for _, t, g, _ in edge_rows], 2, 10 ** 6, 50)
    assert collocations.collocations(no_docs).count() == 0


def test_equal_hashes_are_told_apart(monkeypatch):
    texts = pa.array(["b a", "a b c a", ""])
    want = collocations._counted(texts)
    monkeypatch.setattr(ca, "_hashes", lambda t: np.zeros(len(t.starts), dtype=np.uint64))
    got = collocations._counted(texts)
    assert got[0].equals(want[0]) and (got[1] == want[1]).all() and (got[2] == want[2]).all()


def test_wide_word_lists(monkeypatch):
    """Beyond the packed keys the same sums."""
    rng = np.random.default_rng(1)
    path, weight = rng.integers(0, 5, (500, 3)), rng.integers(1, 9, 500)
    want = ca.summed(path, weight, 5)
    monkeypatch.setattr(ca, "PACKED", 1)
    got = ca.summed(path, weight, 5)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["", "a", "b", "ab", "é"]), min_size=3, max_size=3), min_size=1, max_size=40),
       st.lists(st.lists(st.sampled_from(["", "b", "c", "ab"]), min_size=3, max_size=3), min_size=1, max_size=40),
       st.tuples(*[st.sampled_from([b"", b"a", b"aa", b"b", b"z"])] * 3))
def test_automaton(left, right, bound):
    """Building and reading gives the paths back; a union sums; a cut is the count of smaller paths."""
    def made(rows):
        c = Counter(tuple(x.encode() for x in r) for r in rows)
        words = sorted({b"", *(w for p in c for w in p)})
        path = np.array([[words.index(w) for w in p] for p in sorted(c)])
        return c, words, path, ca.build(pa.array(words, type=pa.binary()), path, np.array([c[p] for p in sorted(c)]))

    (c, words, path, a), (d, *_, b) = made(left), made(right)
    back, weight = a.paths()
    assert (back == path).all() and weight.tolist() == [c[p] for p in sorted(c)]
    assert ca.cut(words, path, bound) == sum(p < bound for p in c)
    known, both, sums = ca.union([a, b])
    assert {tuple(known[s].as_py() for s in p): n for p, n in zip(both.tolist(), sums.tolist())} == c + d
    states = {tuple(zip(a.arcs[2][0][i:j].tolist(), a.arcs[2][1][i:j].tolist())) for i, j in zip(a.first[2], a.first[2][1:])}
    assert len(states) == len(a.first[2]) - 1  # no two states have the same arcs
