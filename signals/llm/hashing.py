"""64-bit hashes of a text's words and shingles, on whole byte buffers with numpy."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240229))
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_VALUE = _VALUE[_LOWER]  # A-Z count as a-z
_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of the hash base and of its inverse, grown as longer buffers come."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (_BASE, _INVERSE)
            )
        return self.up[:n], self.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes, powers: Powers) -> np.ndarray:
    """A hash for each word (run without white space, A-Z lower-cased), in order."""
    b = np.frombuffer(text, np.uint8)
    word = np.zeros(len(b) + 2, np.int8)
    word[1:-1] = ~_SPACE[b]
    edges = np.flatnonzero(np.diff(word))
    starts, ends = edges[0::2], edges[1::2]
    up, down = powers.upto(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUE[b] * up[: len(b)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words in order; with fewer words, one for the whole sequence; none without words."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out = mixed(out * np.uint64(_BASE) + words[i : n - width + 1 + i])
    return out
