"""Line rules, perspectives, mixture, packing, top-k, language, archives against plain versions."""
import hashlib
import random
import re
import zlib
from base64 import b32encode
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import (bit_sliced, codeword_language, complement_packing, line_frequency, mixture, perspectives,
                           warc_index)
from tidewater.llm.common import scratch_path

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- line frequency -----------------------------------------------------------

def plain_counts(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again))


def plain_frequent(rows, min_docs, host_percent):
    """(host, normal line) above the limits, from (text, host): every text of a host once."""
    norm = lambda x: " ".join(WORD.findall(x.lower()))
    lines, hosts = defaultdict(set), defaultdict(set)
    for t, s in rows:
        hosts[s].add(t)
        for x in (t or "").split("\n"):
            if WORD.search(x):
                lines[s, norm(x)].add(t)
    return {k for k, d in lines.items() if len(d) >= min_docs and 100 * len(d) > host_percent * len(hosts[k[0]])}, norm


def plain_quality(rows, min_docs=line_frequency.MIN_DOCS, host_percent=line_frequency.HOST_PERCENT):
    """Per (id, text, host): the verdict and, of kept documents, the text without frequent lines."""
    often, norm = plain_frequent([(t, s) for _, t, s in rows], min_docs, host_percent)
    out = []
    for i, t, s in rows:
        counts = plain_counts(t)
        is_gone = lambda x: bool(WORD.search(x)) and (s, norm(x)) in often
        gone = sum(len(WORD.findall(x)) for x in (t or "").split("\n") if is_gone(x))
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        kept = not failed and 100 * gone <= 50 * counts[0]
        out.append(((i, *counts, gone, failed, kept), "\n".join(x for x in t.split("\n") if not is_gone(x)) if kept else None))
    return out


def test_line_frequency(spark, edge_docs, edge_rows, no_docs):
    rows = [(i, t, s) for i, t, _, s in edge_rows]
    menu = "menu item " + "x" * 30
    rows += [(200 + i, f"Menu  ITEM {'x' * 30}\nmenu item {'X' * 30}\n{prose(random.Random(i), 60)}", "m") for i in range(12)]
    rows += [(300, menu + "\n" + prose(random.Random(300), 3), "m"), (301, (menu + "\n") * 30 + prose(random.Random(301), 20), "m")]
    # one clean document sixty times, under one id and under many: not boilerplate of itself
    clean = "\n".join(prose(random.Random(k), 16) for k in range(4))
    rows += [(400, clean, "c")] * 60 + [(410 + k, clean, "c") for k in range(40)] + [(None, clean, "c")] * 3
    # a document of shared lines only is depleted
    lines = [prose(random.Random(500 + k), 12) for k in range(8)]
    rows += [(500 + k, "\n".join([*random.Random(k).sample(lines, 6), prose(random.Random(600 + k), 20)]), "d") for k in range(9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    for limits in ((3, 2), (10, 10)):
        plain = plain_quality(rows, *limits)
        got = line_frequency.line_frequency(df, min_docs=limits[0], host_percent=limits[1])
        assert Counter(tuple(r) for r in got.select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_line_words",
            "base_failed", "kept").collect()) == Counter(x for x, _ in plain)
        assert Counter((r.doc_id, r.text) for r in line_frequency.strip_lines(df, got).collect()) == Counter(
            (x[0], t) for x, t in plain if t is not None)
    kept = {r.doc_id: r.text for r in line_frequency.strip_lines(df, line_frequency.line_frequency(df)).collect()}
    assert 301 not in kept and 500 not in kept and len(kept[205].split()) == 60 and kept[400] == kept[410] == clean
    out = line_frequency.strip_lines(edge_docs, line_frequency.line_frequency(edge_docs))
    assert out.columns == edge_docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(
        (x[0], t) for x, t in plain_quality([(i, t, s) for i, t, _, s in edge_rows]) if t is not None)
    assert line_frequency.line_frequency(no_docs).count() == 0


def test_shared_ids_and_repeated_rows_in_sql(spark):
    """The statements of op4, op7 and op10 on tables with repeated rows, shared and null ids, large components."""
    import duckdb
    import pandas as pd

    from tidewater.llm import queries, substring_units
    from tidewater.plans.verify import rows_of
    rng = random.Random(6)
    lines = [prose(rng, 14) + "." for _ in range(6)]
    docs = [(k % 5 if k % 7 else None, "\n".join([*rng.sample(lines, 4), prose(rng, 30) + f". Seen {k % 3}! 是的。" + prose(rng, 3)]),
             "ab"[k % 2]) for k in range(40)]
    docs = [(None if i is None else 100 * i + n, t, s) for n, (i, t, s) in enumerate(docs)] + docs[:1] * 0
    docs += [docs[1]] * 3 + [(9000, None, "a"), (9001, "", "b"), (9002, "one", "b")]
    vectors = [(50, [3e5, 1.]), (1, [3e5, -2.]), (2, [-1e8, 4.]), (2, [-1e8, 4.]), (100, [.5, .25]), (100, [.5, .25]),
               (3, [None, 1.]), (4, [float("inf"), 1.]), (5, None), (150, [1., float("nan")]), (6, [1e6, 1e6])]
    con = duckdb.connect()
    con.register("d", pd.DataFrame({"doc_id": pd.array([r[0] for r in docs], dtype="Int64"), "text": [r[1] for r in docs], "source": [r[2] for r in docs]}))
    con.execute("CREATE VIEW documents AS SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE text::VARCHAR END AS text, source FROM d")
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", vectors)
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(3)
    vec = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(2)

    def same(key, out):
        cur = con.execute(queries.ORACLE[key])
        cols = [x[0] for x in cur.description]
        assert rows_of(out.columns, [tuple(r) for r in out.collect()]) == rows_of(cols, cur.fetchall())
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_line_words", "base_failed", "kept"]
    same("op10_line_frequency", line_frequency.line_frequency(df).select(*cols))
    same("op7_bit_sliced_topk", bit_sliced.top_k(vec, F.col("vec_id") % 50 == 0, 5))
    # among null ids the rank goes by a digest that SQL does not have
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM d WHERE doc_id IS NOT NULL")
    units = substring_units.drop_repeated_units(df.where("doc_id is not null"), unit="sentence")
    same("op4_unit_dedup", units.select("doc_id", "n_units", F.size("removed").cast("bigint").alias("n_removed"),
                                        queries.spans_text("removed").alias("removed_spans"), "kept_text"))


# -- perspectives --------------------------------------------------------------

def test_perspectives(spark):
    rows = [(1, 0, "system", "be <|kind|>"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", "bye"),
            (2, None, None, "who"), (2, 5, "cy", "é" * 3), (3, 0, "system", "alone"), (None, 0, "dan", ""),
            (1, 70, "eve", "late"), (1, 70, "eve", "late")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "conv_id bigint, turn int, role string, text string, part string, name string")
    whole = {(r.conv_id, r.assistant): r for r in perspectives.rotate(df).collect()}
    assert set(whole) == {(1, "ann"), (1, "bob"), (1, "eve"), (2, "unknown"), (2, "cy"), (None, "dan")}
    r = whole[1, "eve"]
    assert (r.part, r.n_turns) == (0, 6) and [r.rendered[s.start:s.end] for s in r.mask_spans] == ["late<|end|>"] * 2
    got = {(r.conv_id, r.assistant, r.part): r for r in perspectives.rotate(df, part_turns=64).collect()}
    assert {k[:2] for k in got} == {(1, "ann"), (1, "bob"), (1, "eve"), (2, "unknown"), (2, "cy"), (None, "dan")}
    r = got[1, "ann", 0]
    assert r.rendered == ("<|system|>\nbe < |kind|><|end|>\n<|assistant|>\nhi<|end|>\n<|user name=bob|>\n<|end|>\n"
                          "<|assistant|>\nbye<|end|>\n")
    assert [r.rendered[s.start:s.end] for s in r.mask_spans] == ["hi<|end|>", "bye<|end|>"]
    late = got[1, "eve", 1]
    assert late.n_turns == 2 and [late.rendered[s.start:s.end] for s in late.mask_spans] == ["late<|end|>"] * 2
    assert got[1, "bob", 1].mask_spans == [] and got[2, "unknown", None].n_turns == 1
    assert perspectives.rotate(df.limit(0)).count() == 0


# -- mixture -----------------------------------------------------------------------

def test_rake_meets_margins():
    rng = np.random.default_rng(0)
    seed = rng.random((4, 3, 2)) * 100
    aim = [np.array([.1, .2, .3, .4]), np.array([.5, .25, .25]), np.array([.7, .3])]
    w = mixture.rake(seed, aim)
    for axis, t in enumerate(aim):
        assert np.allclose(w.sum(axis=tuple(k for k in range(3) if k != axis)), t, atol=1e-6)
    # odds ratios of the seed stay
    odds = lambda x: x[0, 0, 0] * x[1, 1, 0] / (x[0, 1, 0] * x[1, 0, 0])
    assert np.isclose(odds(w), odds(seed))
    rate = mixture.rates(seed, w, .4)
    assert rate.max() <= 1 and np.isclose((seed * rate).sum(), .4 * seed.sum())


def test_mix(spark, edge_docs, edge_rows, no_docs):
    rng = random.Random(1)
    rows = [(i, prose(rng, 40), "en" if i % 10 else "de", "big" if i % 5 else "small") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    out = mixture.mix(df, targets={"source": {"big": .5, "small": .5}, "lang": {"en": .6, "de": .4}}, budget=.2)
    size = {tuple(r)[:2]: r.n for r in out.groupBy("source", "lang").agg(F.sum("n_tokens").alias("n")).collect()}
    share = Counter()
    for r in out.select("source", "lang", "n_tokens", "probability", "weight").collect():
        share[r.source] += r.n_tokens * r.probability
        share[r.lang] += r.n_tokens * r.probability
    total = .2 * sum(size.values())
    assert abs(share["=big"] / total - .5) < 1e-3 and abs(share["=de"] / total - .4) < 1e-3
    kept = out.where("kept").agg(F.sum("n_tokens")).first()[0]
    assert abs(kept / total - 1) < .15
    again = mixture.sample(df, targets={"source": {"big": .5, "small": .5}, "lang": {"en": .6, "de": .4}}, budget=.2)
    assert {r.doc_id for r in again.collect()} == {r.doc_id for r in out.where("kept").collect()}
    edge = mixture.mix(edge_docs)
    assert edge.count() == len(edge_rows) and edge.where("probability is null").count() == 0
    assert mixture.sample(edge_docs).columns == edge_docs.columns
    assert mixture.mix(no_docs).count() == 0 and mixture.sample(no_docs).count() == 0
    # null and shared ids: different texts are drawn each for itself, equal rows alike
    many = [(None if k % 2 else 7, prose(rng, 30), "en", "a") for k in range(400)]
    kept = Counter(r.text for r in mixture.sample(spark.createDataFrame(many * 2, df.schema), budget=.5).collect())
    assert 120 < len(kept) < 280 and set(kept.values()) == {2}
    # the probabilities and draws of a plain version, cell by cell
    plain = mixture.mix(df, budget=.3)
    cells, told = Counter(), plain.collect()
    for r in told:
        cells[r.source, r.lang, r.topic] += r.n_tokens
    marks = [sorted({c[k] for c in cells}) for k in range(3)]
    w = {c: n / sum(cells.values()) for c, n in cells.items()}
    share = [Counter() for _ in range(3)]
    for c, n in w.items():
        for k in range(3):
            share[k][c[k]] += n
    aims = [{v: share[k][v] ** mixture.TEMPER / sum(share[k][x] ** mixture.TEMPER for x in marks[k]) for v in marks[k]} for k in range(3)]
    for _ in range(300):
        for k in range(3):
            margin = Counter()
            for c, n in w.items():
                margin[c[k]] += n
            w = {c: n * aims[k][c[k]] / margin[c[k]] for c, n in w.items()}
    lo, hi = 0.0, 1e9
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(n, mid * w[c]) for c, n in cells.items()) < .3 * sum(cells.values()) else (lo, mid)
    for r in told:
        c = r.source, r.lang, r.topic
        assert abs(r.probability - min(1, hi * w[c] / cells[c])) < 1e-6
    drawn = {r.doc_id: r.u for r in df.select("doc_id", mixture.draw(F.col("doc_id"), F.xxhash64("text")).alias("u")).collect()}
    assert all(r.kept == (drawn[r.doc_id] < r.probability) for r in told)


def test_tokens_are_words(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t ", "a", "a\tb\tc", "\n\n a  b\r\n\r\n\r\nc ", "    if x:\n        y = 1\n\n\n", "\x0b\x0cé\x0bü\x0c",
             "no\u00a0break\u3000here\x1cat\x85all", "cell\t" * 5000]
    texts += ["".join(rng.choice("ab é \t\n\r\x0b\x0c") for _ in range(rng.randrange(60))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)],
                               "doc_id bigint, text string, lang string, source string").repartition(3)
    got = {r.doc_id: r.n_tokens for r in mixture.mix(df).collect()}
    assert got == {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}


def test_every_value_has_its_margin(spark, monkeypatch):
    """More sources and languages than were listed once, on the driver and in Spark."""
    rng = random.Random(9)
    rows = [(i, "w " * (1 + i % 7), f"l{i % 40}", f"s{min(i, 3 * rng.randrange(900)) % 300}") for i in range(2400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    dims = {"source": F.col("source"), "lang": F.col("lang")}
    size = Counter()
    for _, t, _, s in rows:
        size["=" + s] += len(t.split())
    want = {s: n ** .7 / sum(m ** .7 for m in size.values()) for s, n in size.items()}
    assert len(want) > 256
    aim = {"source": {f"s{i}": 1.0 for i in range(300)}}
    found = {}
    for most in (mixture.CELLS, 0):
        monkeypatch.setattr(mixture, "CELLS", most)
        out = mixture.mix(df, dims, budget=.5).collect()
        found[most] = {(r.source, r.lang): (r.weight, r.probability) for r in out}
        share = Counter()
        for (s, _), (w, _) in found[most].items():
            share[s] += w
        assert set(share) == set(want) and all(abs(share[s] - x) < 1e-6 for s, x in want.items())
        total = sum(r.n_tokens for r in out)
        assert abs(sum(r.n_tokens * r.probability for r in out) / total - .5) < 1e-6
    a, b = found.values()
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], rtol=1e-6) for k in a)
    monkeypatch.undo()
    assert mixture.mix(df, dims, targets=aim).count() == len(rows)


# -- packing ----------------------------------------------------------------------

@given(st.lists(st.integers(1, 64), max_size=300))
@settings(max_examples=60, deadline=None)
def test_plan_uses_every_piece(lengths):
    steps = complement_packing.plan(Counter(lengths), 64)
    used = Counter()
    for seq, times in steps:
        assert times > 0 and sum(seq) <= 64
        for n in seq:
            used[n] += times
    assert used == Counter(lengths)
    n = sum(t for _, t in steps)
    assert n <= max(-(-sum(lengths) // 64) * 1.3 + 1, sum(x > 32 for x in lengths) + 1 + sum(x <= 32 for x in lengths) / 2)


def test_same_ids_as_the_tokenizers_file(edge_rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = complement_packing.encoder(complement_packing.vocabulary())
    rng = random.Random(2)
    odd = ["".join(rng.choice("ab Z9\n\t'.,é中😀  <|>x") for _ in range(rng.randrange(80))) for _ in range(400)]
    for text in [x for _, x, *_ in edge_rows if x] + odd + ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "it's  we'll\r\n"]:
        assert encode(text) == t.encode(text, add_special_tokens=False).ids


def test_pack(spark, edge_docs, edge_rows, no_docs):
    encode = complement_packing.encoder(complement_packing.vocabulary())
    want = Counter()
    for i, t, *_ in edge_rows:
        ids = np.array([*encode(t or ""), 2], dtype="<u4")
        first = len(ids) % 1024 or min(1024, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, s, e - s, zlib.crc32(ids[s:e].tobytes())] += 1
    rows = complement_packing.pack(edge_docs).collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert len(seqs) <= -(-total // 1024) + 1
    assert complement_packing.pack(no_docs).count() == 0


# -- top-k -------------------------------------------------------------------------

@given(st.integers(0, 2**32), st.integers(1, 200), st.integers(0, 5), st.integers(1, 7), st.sampled_from([1, 3, 300, 60000]))
@settings(max_examples=80, deadline=None)
def test_slices_add_up(seed, n, dim, k, size):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-size, size + 1, (n, dim))
    query = rng.integers(-size, size + 1, dim)
    low, bits, planes = bit_sliced.slice_block(np.arange(n), rows)
    slices, base = bit_sliced.score_slices(query, low, bits, np.stack([planes, ~planes]))
    scores = rows @ query
    alive = rng.random(n) < .8
    bitmap = np.packbits(np.pad(alive, (0, -n % 64)).astype(np.uint8), bitorder="little").view(np.uint64)
    got = bit_sliced.select_top(slices, bitmap, k)
    want = sorted(np.flatnonzero(alive).tolist(), key=lambda i: (-scores[i], i))[:k]
    assert sorted(got.tolist()) == sorted(want)
    for i in got:
        assert base + sum(int(s[i // 64] >> np.uint64(i % 64) & np.uint64(1)) << b for b, s in enumerate(slices)) == scores[i]


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(bit_sliced, "CHUNK", 4)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, .2, 8).astype(np.float32).tolist()) for i in range(120)]
    rows += [(i, rows[0][1]) for i in range(200, 230)]
    rows += [(300, None), (301, [float("nan")] * 8), (302, [None, *[.1] * 7]), (303, [float("inf")] * 8), (304, []),
             (350, []), (None, rows[1][1]), (400, [1., 2.]), (401, [.5, -3.]), (10, rows[10][1])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<float>, score int, dim int")
    ok = [(i, np.floor(256 * np.asarray(v, dtype=np.float32).astype(float)).astype(int)) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for i, q in {i: q for i, q in ok if i % 50 == 0}.items():
        best = sorted((-int(v @ q), j) for j, v in ok if j != i and len(v) == len(q))[:5]
        want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    got = [tuple(r) for r in bit_sliced.top_k(df.repartition(3), F.col("vec_id") % 50 == 0, 5).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert bit_sliced.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# -- language ----------------------------------------------------------------------

def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = (codeword_language.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
         .agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*"), F.min("score"), F.max("score")).first())
    assert r[0] >= .98 and r[1] > 200 and 0 <= r[2] <= r[3] <= 1


def test_language_edges(spark, edge_docs, edge_rows, no_docs):
    got = codeword_language.identify(edge_docs).collect()
    assert len(got) == len(edge_rows)
    by = {r.doc_id: r for r in got}
    for i in (4, 5, 6):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[14].lang_pred == "und" and by[7].lang_pred in ("en", "de", "fr", "es")
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert codeword_language.identify(no_docs).count() == 0
    one = edge_docs.withColumn("lang", F.lit("xx"))
    assert {r.lang_pred for r in codeword_language.identify(one).collect()} == {"xx", "und"}
    none = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in codeword_language.identify(none).collect()} == {"und"}


def test_every_language_is_learned_and_decoded_as_by_a_plain_version(spark):
    """Eighty labels, each with a vocabulary of its own; margins and decoding text by text; texts over one segment."""
    rng = random.Random(2)
    vocab = {f"l{k}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(12)] for k in range(80)}
    rows = [(100 * k + n, " ".join(rng.choice(v) for _ in range(40)), g) for k, (g, v) in enumerate(vocab.items()) for n in range(8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    model = codeword_language.fit(df)
    assert model.langs == sorted(vocab) and len(model.codes.T) < 120
    long = " ".join(vocab["l3"]) * 12_000
    test = [*[r[:2] for r in rows[:200]], (10 ** 6, long), (10 ** 6 + 1, "123")]
    got = {r.doc_id: r for r in codeword_language.predict(spark.createDataFrame(test, "doc_id bigint, text string"), model).collect()}
    assert sum(got[i].lang_pred == g for i, _, g in rows[:200]) >= 198 and got[10 ** 6].lang_pred == "l3"
    assert len(long) > codeword_language.SEGMENT and got[10 ** 6 + 1].lang_pred == "und"
    for i, t in test[:30]:
        data = np.frombuffer(f" {t.lower()} ".encode(), dtype=np.uint8)
        found = np.concatenate([f for _, f in codeword_language.features(data, np.array([len(data)]))])
        z = np.clip((model.weights[:, found].astype(float).mean(axis=1) - model.middle) / model.reach, -4, 4)
        loss = [(np.exp(-z * code) * model.trust).sum() for code in model.codes]
        p = np.exp(-codeword_language.SHARP * (np.array(loss) - min(loss)))
        assert got[i].lang_pred == model.langs[int(np.argmin(loss))] and abs(got[i].score - p.max() / p.sum()) < 1e-4


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 20])
def test_codewords_differ(n):
    c = codeword_language.codewords(n)
    apart = min((c[a] != c[b]).sum() for a in range(n) for b in range(a))
    assert apart >= (1 if n == 2 else c.shape[1] * .4) and not (np.abs(c.sum(axis=0)) == n).any()


# -- archives ----------------------------------------------------------------------

def test_archive_round_trip(spark):
    rng = random.Random(6)
    rows = [(i, f"http://h/{i}", f"<p>{prose(rng, 50)}</p>") for i in range(40)]
    rows += [(50, None, rows[3][2]), (51, "http://x/\r\n%", rows[3][2]), (52, "u", ""), (53, "u", None), (54, "u", "é\r\n\r\nz"),
             (55, "big", "y" * 300000), (None, "n1", rows[3][2]), (None, "n2", "only here"), (None, "n3", "only here"),
             (3, "http://h/3b", rows[3][2])]
    pages = spark.createDataFrame([(*r, "k", "o") for r in rows],
                                  "page_id bigint, url string, html string, key string, owner string").repartition(3)
    folder, index = warc_index.archive(pages, min_bytes=0)
    got = warc_index.read(index, folder).collect()
    owner = {}
    for i, _, h in rows:
        if i is not None:
            owner[h or ""] = min(owner.get(h or "", i), i)
    assert Counter((r.page_id, r.url, r.payload_bytes, r.payload_digest) for r in got) == Counter(
        (i, u, len((h or "").encode()), b32encode(hashlib.sha1((h or "").encode()).digest()).decode()) for i, u, h in rows)
    bodies = {i: h or "" for i, _, h in rows}
    responses = Counter()
    for r in got:
        if r.record_type == "response":
            responses[bytes(r.payload)] += 1
            assert r.refers_to is None
        else:
            assert r.payload is None and r.refers_to == owner[bodies[r.page_id] if r.page_id is not None else rows[3][2]]
    assert responses[rows[3][2].encode()] == 1 and responses[b""] == 1 and responses[b"only here"] == 2
    # any selection of records reads alone
    some = warc_index.read(index.where("page_id in (7, 55)"), folder).collect()
    assert sorted(r.page_id for r in some) == [7, 55]
    small = warc_index.read(warc_index.write(pages, f := scratch_path(spark, "w"), min_bytes=1 << 20).cache(), f)
    assert small.where("record_type = 'revisit'").count() == 0
    folder, index = warc_index.archive(pages.limit(0))
    assert warc_index.read(index, folder).count() == 0


def test_runs_join_near_ranges():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 5), ("b", 0, 5), ("b", 5, 90)]
    assert [len(g) for g in warc_index.runs(iter(rows), gap=5, most=50)] == [3, 1, 1, 1]


def test_records_are_independent_gzip_members():
    a = warc_index.record(1, "u", b"one", warc_index.base32(hashlib.sha1(b"one").digest()), None, False)
    assert warc_index.parse(a)["payload"] == b"one"
    broken = warc_index.record(1, "u", b"two", warc_index.base32(hashlib.sha1(b"one").digest()), None, False)
    with pytest.raises(ValueError):
        warc_index.parse(broken)
