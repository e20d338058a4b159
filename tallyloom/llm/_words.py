"""Words of many texts at once as NumPy arrays: where they are, and 64-bit hashes of them and of runs of them.

A word is a run of characters other than space and U+0009 to U+000D. A word's hash is the sum of its 8-byte pieces, each mixed together with
its place, mixed again with the word's length; a run's hash is mixed from those of the two longest stretches of 2**k values that cover it, and
so on down to single values. Every step goes through a bijective mixer: no arithmetic between pieces or words is left that patterned text
could cancel (polynomials modulo 2**64 give the Thue-Morse words over two letters one hash for every base). Equal text has an equal hash in every process.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x + U((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def find(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each text the number of words before it (n + 1 entries). between: for each byte whether it is outside words."""
    n = len(data)
    blank = np.empty(n + 2, dtype=bool)
    blank[0] = blank[-1] = True
    np.take(between, data, out=blank[1:-1])
    word = ~blank[1:-1]
    before, after = blank[:-2].copy(), blank[2:].copy()
    inside = offsets[(offsets > 0) & (offsets < n)]
    before[inside] = True
    after[inside - 1] = True
    starts, ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte range, none of them empty; other seeds give independent ones."""
    if not len(starts):
        return np.zeros(0, dtype=U)
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    n = (ends - starts + 7) >> 3
    first = np.cumsum(n) - n
    place = np.arange(int(n.sum())) - np.repeat(first, n)
    at = np.repeat(starts, n) + 8 * place
    beyond = np.maximum(at + 8 - np.repeat(ends, n), 0).astype(U) << U(3)
    pieces = eight[at] & (U(0xFFFFFFFFFFFFFFFF) >> beyond)
    places = mix(np.arange(int(n.max()), dtype=U), 2 * seed + 101)
    sums = np.add.reduceat(mix(pieces + places[place], 2 * seed + 102), first)
    return mix(sums ^ mix((ends - starts).astype(U), 2 * seed + 103), seed)


class Runs:
    """Hashes of runs of consecutive values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]  # levels[k][i] is the hash of the 2**k values from i on

    def _level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            below, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(mix(mix(below[: max(len(below) - step, 0)], 201) + below[step:], 202))
        return self.levels[k]

    def hash(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        """The hash of each run, none of them empty."""
        out, n = np.empty(len(starts), dtype=U), ends - starts
        if not len(n):
            return out
        for k in range(int(n.min()).bit_length() - 1, int(n.max()).bit_length()):
            some = np.flatnonzero((n >> k) == 1)
            if len(some):
                level, a, b = self._level(k), starts[some], ends[some] - (1 << k)
                out[some] = mix(mix(level[a], 203) + level[b] + mix(n[some].astype(U), 204), seed)
        return out
