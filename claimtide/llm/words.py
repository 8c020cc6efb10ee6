"""Words of texts as 64-bit hashes, and runs of words from them."""

from __future__ import annotations

import numpy as np
import xxhash

_PRIME = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word (bytes) -> hash, remembered up to a bounded number of words."""

    def __init__(self, most: int = 100_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` words, in order; of fewer words, one for all of them; of
    none, none."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    total = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total * _PRIME + hashes[k:len(hashes) - size + 1 + k])
    return total
