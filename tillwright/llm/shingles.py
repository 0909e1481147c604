"""Words and word shingles of texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

CACHED_WORDS = 1_000_000
# Odd multipliers of the mixing steps (fixed values).
SPREAD, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z as small letters."""
    return (text or "").encode().lower().split()


class WordHashes(dict):
    """A 64-bit hash for every word, remembered for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * TURN
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Sets of shingles of ``size`` words; a shorter text is one shingle, an empty one none."""

    def __init__(self, size: int):
        self.size = size
        self.hashes = WordHashes()

    def set_of(self, text: str | None) -> np.ndarray:
        """The distinct shingles in ascending order of their hashes."""
        words = words_of(text)
        if not words:
            return np.empty(0, np.uint64)
        values = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        width = min(self.size, len(values))
        count = len(values) - width + 1
        made = np.full(count, width, np.uint64)
        for i in range(width):
            made = mixed(made * SPREAD + values[i : i + count])
        return np.unique(made)


def fingerprint(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a whole set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)
