"""Weighted acyclic automata over words, vectorised (numpy, inside tasks).

A count transducer holds n-grams of up to ``DEPTH`` words with their counts.
Every word occurrence gives one path of ``DEPTH`` symbols: the word and its
successors in the piece, ``END`` once the piece is over.  The weight of a path
is its count, so the count of a shorter n-gram is the sum of the weights over
the range of paths that start with it.

Symbols are places in a sorted list of words (place 0 is ``END``, the empty
string), hence sorted paths are in byte order of their words.  States with
equal arcs are one state, which is what keeps a shard's automaton small: most
pairs of words are followed by one word, once.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import rolling

DEPTH = 3
#: Symbols of a path fit into one 64-bit key while the word list is shorter than this.
PACKED = 1 << 21

# Classes of bytes: 0 belongs to a word, 1 separates words, 2 separates pieces.
CLASS = np.zeros(256, dtype=np.uint8)
CLASS[[9, 32]] = 1
CLASS[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = 2


@dataclass
class Tokens:
    """Words of a text buffer: lower-cased bytes, place and length of each word, its piece and its row."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    row: np.ndarray


def tokens(data: np.ndarray, bounds: np.ndarray) -> Tokens:
    """Cut every row into pieces and words; no word or piece crosses rows."""
    low = rolling.LOWER[data]
    kind = CLASS[low]
    word = kind == 0
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.ones(len(data), dtype=bool)
    before[1:] = ~word[:-1]
    after = np.ones(len(data), dtype=bool)
    after[:-1] = ~word[1:]
    starts = np.flatnonzero(word & (before | edge[:-1]))
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    row = np.searchsorted(bounds, starts, side="right") - 1
    return Tokens(low, starts, ends, np.cumsum(kind == 2)[starts] if len(data) else starts, row)


def _hashes(t: Tokens) -> np.ndarray:
    """64 bits of every word."""
    out = np.empty(len(t.starts), dtype=np.uint64)
    at = 0
    while at < len(out):
        to = max(int(np.searchsorted(t.ends, t.starts[at] + rolling.BLOCK, side="right")), at + 1)
        s, e = t.starts[at:to] - t.starts[at], t.ends[at:to] - t.starts[at]
        p, down = rolling.prefix(rolling.LETTER[t.data[t.starts[at]:t.ends[to - 1]]])
        out[at:to] = rolling.mix((p[e] - p[s]) * down[s] + (e - s).astype(np.uint64) * rolling.M2)
        at = to
    return out


def _same(t: Tokens, other: np.ndarray) -> bool:
    """Whether every word has the bytes of the word ``other`` names for it."""
    n = t.ends - t.starts
    if (n != n[other]).any():
        return False
    at = 0
    total = np.cumsum(n)
    while at < len(n):
        to = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + rolling.BLOCK, side="right")), at + 1)
        k = n[at:to]
        inner = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        if (t.data[np.repeat(t.starts[at:to], k) + inner] != t.data[np.repeat(t.starts[other[at:to]], k) + inner]).any():
            return False
        at = to
    return True


def symbols(t: Tokens) -> tuple[pa.Array, np.ndarray]:
    """The sorted words (``END`` first) and the symbol of every word.  Words are
    found by hash and compared byte by byte; should two differ, all are looked up as texts."""
    raw = t.data.tobytes()
    _, first, inverse = np.unique(_hashes(t), return_index=True, return_inverse=True)
    if not _same(t, first[inverse]):
        seen: dict[bytes, int] = {}
        inverse = np.array([seen.setdefault(raw[s:e], len(seen)) for s, e in zip(t.starts.tolist(), t.ends.tolist())])
        found = list(seen)
    else:
        found = [raw[s:e] for s, e in zip(t.starts[first].tolist(), t.ends[first].tolist())]
    words = pa.array([b"", *found], type=pa.binary())
    order = pc.sort_indices(words).to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return words.take(pa.array(order)), place[np.asarray(inverse, dtype=np.int64) + 1]


def paths(symbol: np.ndarray, piece: np.ndarray, row: np.ndarray) -> np.ndarray:
    """One path of ``DEPTH`` symbols per word."""
    out = np.zeros((len(symbol), DEPTH), dtype=np.int64)
    out[:, 0] = symbol
    for k in range(1, DEPTH):
        same = (piece[k:] == piece[:-k]) & (row[k:] == row[:-k])
        out[:len(symbol) - k, k][same] = symbol[k:][same]
    return out


def summed(path: np.ndarray, weight: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paths in order with the sums of their weights."""
    if not len(path):
        return path, weight
    if n_words <= PACKED:
        key = (path[:, 0] << 42) | (path[:, 1] << 21) | path[:, 2]
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    else:
        order = np.lexsort((path[:, 2], path[:, 1], path[:, 0]))
        p = path[order]
        new = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]).any(axis=1)]))
    return path[order[new]], np.add.reduceat(weight[order], new)


def starts_of(path: np.ndarray, k: int) -> np.ndarray:
    """Where runs of equal first ``k`` symbols start in sorted paths."""
    if not len(path):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], (path[1:, :k] != path[:-1, :k]).any(axis=1)]))


@dataclass
class Automaton:
    """States of each depth as ranges of arcs.  ``arcs[k]`` are (symbol, next):
    next is a state of depth k + 1, or the weight after the last symbol."""
    words: pa.Array
    first: list[np.ndarray]
    arcs: list[tuple[np.ndarray, np.ndarray]]

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All paths in order, with their weights."""
        symbol, state = self.arcs[0]
        out = [symbol]
        for k in range(1, DEPTH):
            lo = self.first[k][state]
            n = self.first[k][state + 1] - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out = [np.repeat(x, n) for x in out] + [self.arcs[k][0][at]]
            state = self.arcs[k][1][at]
        return np.stack(out, axis=1).astype(np.int64), state


def _share(first: np.ndarray, symbol: np.ndarray, nxt: np.ndarray):
    """States with equal arcs become one: (state of each, first, symbol, next)."""
    n = np.diff(first)
    at = first[:-1]
    single = n == 1
    known = np.full(len(n), -1, dtype=np.int64)
    key = np.stack([symbol[at[single]], nxt[at[single]]], axis=1)
    one, where = np.unique(key, axis=0, return_inverse=True) if len(key) else (key, np.zeros(0, dtype=np.int64))
    known[single] = where.reshape(-1)
    register: dict[bytes, int] = {}
    both = np.stack([symbol, nxt], axis=1)
    keep = []
    for i in np.flatnonzero(~single).tolist():
        k = both[at[i]:at[i] + n[i]].tobytes()
        s = register.get(k)
        if s is None:
            s = register[k] = len(one) + len(keep)
            keep.append(i)
        known[i] = s
    keep = np.array(keep, dtype=np.int64)
    size = np.concatenate([np.ones(len(one), dtype=np.int64), n[keep]])
    inner = np.arange(n[keep].sum()) - np.repeat(np.cumsum(n[keep]) - n[keep], n[keep])
    arcs = both[np.repeat(at[keep], n[keep]) + inner] if len(keep) else both[:0]
    arcs = np.concatenate([one.reshape(-1, 2), arcs])
    return known, np.concatenate([[0], np.cumsum(size)]), arcs[:, 0], arcs[:, 1]


def build(words: pa.Array, path: np.ndarray, weight: np.ndarray) -> Automaton:
    """The minimal automaton of sorted distinct paths, built from the last symbol to the first."""
    first, arcs = [None] * DEPTH, [None] * DEPTH
    nxt, at = weight, np.arange(len(path))
    for k in range(DEPTH - 1, 0, -1):
        runs = starts_of(path[at], k)  # states of depth k: runs of equal first k symbols
        state, first[k], symbol, target = _share(np.concatenate([runs, [len(at)]]), path[at, k], nxt)
        arcs[k], nxt, at = (symbol, target), state, at[runs]
    first[0], arcs[0] = np.array([0, len(at)]), (path[at, 0], nxt)
    return Automaton(words, first, arcs)


def cut(words: list[bytes], path: np.ndarray, bound: tuple[bytes, ...]) -> int:
    """How many of the sorted paths stand before ``bound`` (``DEPTH`` words)."""
    lo, hi = 0, len(path)
    for k, w in enumerate(bound):
        s = bisect_left(words, w)
        column = path[lo:hi, k]
        found = s < len(words) and words[s] == w
        a = lo + int(np.searchsorted(column, s))
        if not found:
            return a
        lo, hi = a, lo + int(np.searchsorted(column, s, side="right"))
    return lo


def used(words: pa.Array, path: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words that stand in ``path`` (and ``END``), with the symbols anew."""
    seen = np.zeros(len(words), dtype=bool)
    seen[0] = True
    seen[path.reshape(-1)] = True
    return words.filter(pa.array(seen)), (np.cumsum(seen) - 1)[path]


def union(parts: list[Automaton]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, paths, weights) of several automata together: one word list, equal paths summed."""
    every = pc.unique(pa.concat_arrays([p.words for p in parts]))
    words = every.take(pc.sort_indices(every))
    path, weight = [], []
    for p in parts:
        x, w = p.paths()
        path.append(pc.index_in(p.words, value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)[x])
        weight.append(w)
    path, weight = summed(np.concatenate(path), np.concatenate(weight), len(words))
    return words, path, weight
