"""Fingerprints of words and of runs of words, the same in every task."""

from __future__ import annotations

import numpy as np
import xxhash

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Words remembered before the cache starts anew.
_LIMIT = 500_000


class WordHashes(dict):
    """64-bit fingerprints of words, computed once while they stay in the cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _LIMIT:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * _A + (right ^ (right >> np.uint64(29))) * _B
    return (x ^ (x >> np.uint64(32))) * _C


def runs(words: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of all runs of so many words, by doubling: none if there are fewer words."""
    count = len(words) - width + 1
    if count < 1:
        return np.empty(0, np.uint64)
    out, covered, power, size = None, 0, words, 1
    while True:
        if width & size:
            part = power[covered : covered + count]
            out = part if out is None else _join(out, part)
            covered += size
        if covered == width:
            return out ^ (out >> np.uint64(31))
        power = _join(power[:-size], power[size:])
        size *= 2
