"""Language identification by error-correcting output codes.

Every language has a codeword.  One binary classifier per bit, a linear one
over hashed byte n-grams, predicts that bit; loss-weighted decoding then takes
the language whose codeword costs least, and a text whose two best codewords
cost nearly the same is flagged as ambiguous.

Fitting: n-gram counts per language over a bounded sample of labelled texts
(``PER_LANG`` texts of a language in expectation, of every language).  Only
the (language, feature) counts reach the driver, ``FEATURES`` numbers a language
at most; codewords grow with the number of languages, with its logarithm above
``HADAMARD`` of them.  Prediction runs over whole texts in a scan,
without a shuffle.

Defined cases: a null text, and one without a letter, is ``und`` with score 0;
so is every text if no language can be learned; with one language learned it
is the answer for every other text; texts of any length are read whole, in
segments; a null id counts as not held out; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_LANG = 4000
HADAMARD = 64
FEATURES = 1 << 16
GRAMS = (2, 3, 4)
SEGMENT = 1 << 19
#: Sharpness of the score, and the score below which a text is ambiguous.
SHARP, SURE = 8.0, 0.6

#: ASCII letters lower-cased, other ASCII as spaces, bytes of other characters as they are.
FOLD = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in bytes(range(128)).lower()] +
                list(range(128, 256)), dtype=np.uint8)


@dataclass
class Model:
    langs: list[str]
    codes: np.ndarray      # [language, bit] of -1 and 1
    weights: np.ndarray    # [bit, feature]
    middle: np.ndarray     # [bit] margin halfway between the two sides
    reach: np.ndarray      # [bit] half the distance of the sides
    trust: np.ndarray      # [bit] weight of the bit's loss


def prepared(text: Column) -> Column:
    """What n-grams are read from: lower case, a space at both ends (null: empty)."""
    return F.coalesce(F.concat(F.lit(" "), F.lower(text), F.lit(" ")), F.lit(""))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def features(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature) of every n-gram with a letter, in segments of bounded size.  ``ends``: of the rows in ``data``."""
    for s in range(0, len(data), SEGMENT):
        seg = FOLD[data[s:s + SEGMENT + max(GRAMS) - 1]].astype(np.uint32)
        n = min(SEGMENT, len(data) - s)
        at = np.arange(s, s + n)
        row = np.searchsorted(ends, at, side="right")
        room = ends[row] - at
        packed, letters = np.zeros(n, dtype=np.uint32), np.zeros(n, dtype=bool)
        pad = np.concatenate([seg, np.full(max(GRAMS), 32, dtype=np.uint32)])
        for k in range(max(GRAMS)):
            packed |= pad[k:k + n] << np.uint32(8 * k)
            letters |= pad[k:k + n] != 32
            if k + 1 in GRAMS:
                ok = (room > k) & letters
                h = (packed[ok] ^ np.uint32(0x9E3779B1 * (k + 1) & 0xFFFFFFFF)) * np.uint32(2654435761)
                h ^= h >> np.uint32(15)
                h *= np.uint32(2246822519)
                yield row[ok], (h >> np.uint32(16)).astype(np.int64)


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the end of each row in them."""
    c = column.cast(pa.large_binary())
    off = np.frombuffer(c.buffers()[1], dtype=np.int64)[c.offset:c.offset + len(c) + 1]
    data = np.frombuffer(c.buffers()[2] or b"", dtype=np.uint8)[off[0]:off[-1]]
    return data, (off[1:] - off[0])


def count_features(labelled: DataFrame) -> DataFrame:
    """(lang, feature, n) from (lang, prepared text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            langs, (data, ends) = np.array(b.column(0).to_pylist(), dtype=object), _buffer(b.column(1))
            for row, f in features(data, ends):
                for lang in set(langs[np.unique(row)].tolist()):
                    c = counts.setdefault(lang, np.zeros(FEATURES, dtype=np.int64))
                    c += np.bincount(f[langs[row] == lang], minlength=FEATURES)
        for lang, c in counts.items():
            f = np.flatnonzero(c)
            yield pa.record_batch([pa.array([lang] * len(f), pa.string()), pa.array(f), pa.array(c[f])],
                                  names=["lang", "feature", "n"])

    return (labelled.mapInArrow(run, "lang string, feature bigint, n bigint")
            .groupBy("lang", "feature").agg(F.sum("n").alias("n")))


def codewords(n: int) -> np.ndarray:
    """[language, bit]: every split of the languages for up to 6 of them, then
    the useful columns of a Hadamard matrix, whose rows differ in half the bits;
    for more than ``HADAMARD`` languages random words of 16 bits a doubling, drawn
    until any two differ in a quarter of the bits at least."""
    if n <= 6:
        cols = [[1 if (m >> i) & 1 else -1 for i in range(n)] for m in range(1, 1 << max(n - 1, 0))]
        return np.array(cols, dtype=np.int64).T.reshape(n, len(cols))
    if n > HADAMARD:
        bits = 16 * int(np.ceil(np.log2(n)))
        rng = np.random.default_rng(n)
        rows: list[np.ndarray] = []
        while len(rows) < n:
            w = rng.choice([-1, 1], size=bits)
            if not rows or ((np.array(rows) != w).sum(axis=1) >= bits // 4).all():
                rows.append(w)
        return np.array(rows)
    h = np.array([[1]])
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    h = h[:n]
    return h[:, np.abs(h.sum(axis=0)) < n]


def fit(labelled: DataFrame, per_lang: int = PER_LANG) -> Model:
    """From (doc_id, lang, text); rows without text, letters or label are left out."""
    d = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    sizes = d.groupBy("lang").count().collect()  # one row per language
    if not sizes:
        return Model([], np.zeros((0, 0)), np.zeros((0, FEATURES)), np.zeros(0), np.zeros(0), np.zeros(0))
    share = F.broadcast(d.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, per_lang / r["count"])) for r in sizes], "lang string, share double"))
    u = F.pmod(F.xxhash64("doc_id", "text", F.lit(9)), F.lit(1 << 53)).cast("double") / float(1 << 53)
    sample = d.join(share, "lang").where(u < F.col("share")).select("lang", prepared(F.col("text")).alias("t"))
    rows = count_features(sample).toPandas()
    langs = sorted(rows["lang"].unique().tolist())
    counts = np.zeros((len(langs), FEATURES))
    counts[rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=int),
           rows["feature"].to_numpy(dtype=int)] = rows["n"].to_numpy()
    return solve(langs, counts)


def solve(langs: list[str], counts: np.ndarray) -> Model:
    """The bit classifiers: log odds of an n-gram between the two sides of a bit."""
    p = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    codes = codewords(len(langs))
    bits = codes.shape[1]
    w, middle, reach = np.zeros((bits, FEATURES)), np.zeros(bits), np.ones(bits)
    for b in range(bits):
        on = codes[:, b] > 0
        w[b] = np.log(p[on].mean(axis=0)) - np.log(p[~on].mean(axis=0))
        mean = p @ w[b]
        high, low = mean[on].min(), mean[~on].max()
        middle[b], reach[b] = (high + low) / 2, max((high - low) / 2, 1e-6)
    trust = reach / reach.sum() if bits else reach[:0]
    return Model(langs, codes, w.astype(np.float32), middle, reach, trust)


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language and its score, from mean margins [text, bit]."""
    z = np.clip((margins - model.middle) / model.reach, -4, 4)
    loss = (np.exp(-z[:, None, :] * model.codes[None]) * model.trust).sum(axis=2)
    e = np.exp(-SHARP * (loss - loss.min(axis=1, keepdims=True)))
    p = e / e.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    return best, p[np.arange(len(p)), best]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) per row of (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select("doc_id", F.when(has_letter(F.col("text")), prepared(F.col("text"))).otherwise("").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            n, (data, ends) = b.num_rows, _buffer(b.column(1))
            sums, count = np.zeros((n, len(m.weights))), np.zeros(n)
            for row, f in features(data, ends):
                count += np.bincount(row, minlength=n)
                for bit, w in enumerate(m.weights):
                    sums[:, bit] += np.bincount(row, weights=w[f], minlength=n)
            lang, score = np.full(n, "und", dtype=object), np.zeros(n)
            there = np.flatnonzero(np.diff(np.concatenate([[0], ends])) > 0)
            if len(m.langs) and len(there):
                best, s = decode(m, sums[there] / np.maximum(count[there], 1)[:, None])
                lang[there], score[there] = np.array(m.langs, dtype=object)[best], s
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(lang.tolist(), pa.string()),
                                   pa.array(score), pa.array((score > 0) & (score < SURE))],
                                  names=["doc_id", "lang_pred", "score", "ambiguous"])

    return d.mapInArrow(run, "doc_id bigint, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous), learned from the
    labelled rows that are not held out."""
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "lang", "text"), per_lang)
    return predict(docs.select("doc_id", "text"), model).withColumn("held_out", held_out(F.col("doc_id")))
