"""Hashed word shingles of whole texts."""

from __future__ import annotations

import numpy as np

WORDS = 5
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Two random codes for each byte, for two hash functions.
BYTE_CODES = np.random.default_rng(11).integers(0, 1 << 64, (2, 256), np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if _powers[0].size < n:
        size = max(n, 1 << 14)
        for i, base in enumerate((_BASE, _INVERSE)):
            _powers[i] = np.cumprod(np.concatenate((
                np.ones(1, np.uint64), np.full(size, base, np.uint64))))
    return _powers


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes without white space."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _BLANK[raw], [True]))))
    return edge[::2], edge[1::2]


def hash_runs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of bytes, from one running sum; ``kind`` picks the function."""
    up, down = powers(raw.size + 1)
    codes = BYTE_CODES[kind][raw]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * up[:raw.size])))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """A hash of every word, in order."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return hash_runs(raw, *words_of(raw))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of WORDS consecutive words; a shorter text is one shingle."""
    words = word_hashes(text)
    if not words.size:
        return words
    size = min(WORDS, words.size)
    up = powers(size)[0]
    out = np.full(words.size - size + 1, size, np.uint64)
    for i in range(size):
        out += words[i:words.size - size + 1 + i] * up[i]
    return np.unique(mix(out))
