"""Vectorised hashes over text buffers (numpy, inside tasks).

A prefix sum of mixed values times powers of an odd base gives the hash of any
byte range in constant time, independent of where the range lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
M1, M2, M3 = U(0xA0761D6478BD642F), U(0xD6E8FEB86659FD93), U(0x8EBC6AF09C88C6E3)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * M2
    x ^= x >> U(29)
    x *= M1
    return x ^ (x >> U(32))


class Powers:
    """Powers of the base and of its inverse, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            up, down = np.full(n, BASE, dtype=U), np.full(n, INVERSE, dtype=U)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P, down): the hash of values[i:j] is (P[j] - P[i]) * down[i]."""
    up, down = POWERS.get(len(values) + 1)
    p = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * up[:-1], out=p[1:])
    return p, down


def grams8(data: np.ndarray) -> np.ndarray:
    """A mixed value of the 8 bytes from each place (8 bytes at least are there)."""
    n = len(data)
    x = data.astype(U)
    x = x[:n - 1] | (x[1:] << U(8))
    x = x[:n - 3] | (x[2:n - 1] << U(16))
    x = x[:n - 7] | (x[4:n - 3] << U(32))
    return mix(x * M1 + M3)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the bounds of its rows in them (one more than rows)."""
    c = column.cast(pa.large_binary())
    off = np.frombuffer(c.buffers()[1], dtype=np.int64)[c.offset:c.offset + len(c) + 1]
    raw = c.buffers()[2]
    data = np.frombuffer(raw if raw is not None else b"", dtype=np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTER = mix(np.arange(1, 257, dtype=U) * M3)
BLOCK = 1 << 20


def word_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of every row."""
    word = ~SEPARATOR[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[bounds] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | first[1:-1]
    return np.diff(np.searchsorted(np.flatnonzero(starts), bounds))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lower-cased) and the bounds of the rows' words."""
    if not len(data):
        return np.zeros(0, dtype=U), np.zeros(len(bounds), dtype=np.int64)
    sep = SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate([[True], sep[:-1]]) | edge[:-1]
    after = np.concatenate([sep[1:], [True]]) | edge[1:]
    starts, ends = np.flatnonzero(~sep & before), np.flatnonzero(~sep & after) + 1
    out = np.empty(len(starts), dtype=U)
    at = 0
    while at < len(starts):
        # as many whole words as fit into a block, one at least
        to = max(int(np.searchsorted(ends, starts[at] + BLOCK, side="right")), at + 1)
        s, e = starts[at:to] - starts[at], ends[at:to] - starts[at]
        p, down = prefix(LETTER[LOWER[data[starts[at]:ends[to - 1]]]])
        out[at:to] = mix((p[e] - p[s]) * down[s] + (e - s).astype(U) * M2)
        at = to
    return out, np.searchsorted(starts, bounds)


def shingles(words: np.ndarray, bounds: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its n-word shingles; fewer words
    are one shingle, none is an empty set."""
    if len(words) >= n:
        h = words[:len(words) - n + 1].copy()
        for k in range(1, n):
            h = mix(h * M3 + words[k:len(words) - n + 1 + k])
        h = mix(h + U(n))
    else:
        h = words[:0]
    for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if e - s >= n:
            yield np.unique(h[s:e - n + 1])
        elif e > s:
            one = words[s:s + 1].copy()
            for k in range(s + 1, e):
                one = mix(one * M3 + words[k:k + 1])
            yield mix(one + U(e - s))
        else:
            yield words[:0]
