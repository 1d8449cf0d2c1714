"""Word hashes and shingle hashes of whole texts (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection on 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word bytes -> 64-bit hash, remembered up to ``limit`` words (then started afresh)."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words (order matters); fewer words than ``k``: none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix((out + hashes[i:i + n]) * _STEP + np.uint64(i))
    return out


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct ``k``-word shingles; with fewer words the whole sequence as one."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(windows(hashes, min(k, len(hashes))))
