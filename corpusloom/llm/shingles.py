"""Word shingles of a text as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 200_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], "uint64")


class WordHashes(dict):
    """Hashes of words seen before; starts afresh when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def shingle_set(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; all words as one if there are fewer.

    A-Z are lower-cased; words are what ASCII white space separates.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, "uint64")
    each = np.fromiter(map(hashes.__getitem__, words), "uint64", len(words))
    width = min(n, len(each))
    total = np.full(len(each) - width + 1, width, "uint64")
    for i in range(width):
        total = mix(total + each[i : len(each) - width + 1 + i] * _FACTORS[i % 3] + np.uint64(i))
    return np.unique(total)
