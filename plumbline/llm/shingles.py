"""Sets of word shingles as sorted 64-bit hashes, computed on the bytes of a text without a loop over words."""

from __future__ import annotations

import hashlib

import numpy as np

_ODD = 0x9E3779B97F4A7C15  # multiplier of the rolling sums
_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the finaliser of a public 64-bit generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Shingler:
    """Shingles of ``words`` consecutive words; A-Z in lower case; words end at the blanks \\x20 and \\x09-\\x0D.

    A text with fewer words is one shingle of all its words; a text without words has none.
    """

    def __init__(self, words: int):
        self.words = words
        self._byte = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
        upper = np.arange(ord("A"), ord("Z") + 1)
        self._byte[upper] = self._byte[upper + 32]
        self._blank = np.zeros(256, bool)
        self._blank[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
        self._up = self._down = np.zeros(0, np.uint64)

    def _word_hashes(self, text) -> np.ndarray:
        data = np.frombuffer(text, np.uint8)
        if len(data) >= len(self._up):
            size = 2 * len(data) + 2
            self._up, self._down = _powers(_ODD, size), _powers(pow(_ODD, -1, 1 << 64), size)
        edges = np.flatnonzero(np.diff(np.concatenate([[True], self._blank[data], [True]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._byte[data] * self._up[: len(data)], out=sums[1:])
        # Sum of byte values times powers, shifted so that it starts at power 0, and the length.
        return _mixed((sums[ends] - sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))

    def __call__(self, text) -> np.ndarray:
        """Sorted distinct hashes of a text's shingles."""
        words = self._word_hashes(text)
        size = min(self.words, len(words))
        if not size:
            return words
        out = np.full(len(words) - size + 1, size, np.uint64)
        for j in range(size):
            out = _mixed(out * np.uint64(_ODD) + words[j : len(words) - size + 1 + j])
        return np.unique(out)


def fingerprint(shingles: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
