"""Monotone sequences of integers in Elias-Fano form, built and searched by arrays.

A key is split into low bits, packed one after the other, and high bits, written in unary:
for every value of the high bits a run of ones, one for each key, and a zero. Directories
count the zeros and the ones before each word. Zeros lead to the keys of one high value, its
bucket, without walking, and a binary search for the successor goes on inside the bucket;
ones lead to the key at a place, so that a sequence of pointers can be read anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bits that can be read at any bit offset from the eight bytes there.
WINDOW = 56
HEADER = 7
#: Masks to count the ones of all bytes of a number at once, and its highest bits.
PAIRS, FOURS, BYTES = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333), np.uint64(0x0F0F0F0F0F0F0F0F)
EVERY, TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: The place of the one of each rank, from 0, in each byte; 0 where it has fewer ones.
IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[:8] for byte in range(256)], np.int64).ravel()


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits of each value, one after the other, least bit first."""
    words = np.zeros((len(values) * width + 63) // 64 + 2, np.uint64)
    if width:
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(words, word, values << shift)
        over = np.where(shift > 0, values >> ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        np.bitwise_or.at(words, word + 1, over)
    return words


def _directory(before: np.ndarray, total: int) -> np.ndarray:
    """Bits before each word, and the total behind the last one."""
    made = np.full(-(-(len(before) + 1) // 2) * 2, total, np.uint32)
    made[: len(before)] = before
    return made.view(np.uint64)


def encode(keys: np.ndarray, universe: int) -> list[np.ndarray]:
    """Header, low bits, high bits and directories of ascending ``keys`` (uint64).

    Keys may repeat; a search then finds any one of the equal keys.
    """
    count = len(keys)
    width = max(0, min(WINDOW, (universe // max(count, 1)).bit_length() - 1))
    low = keys & np.uint64((1 << width) - 1)
    high = (keys >> np.uint64(width)).astype(np.int64)
    buckets = (universe >> width) + 1
    ones = np.arange(count, dtype=np.int64) + high
    words = np.zeros((count + buckets + 63) // 64 + 2, np.uint64)
    np.bitwise_or.at(words, ones >> 6, np.uint64(1) << (ones & 63).astype(np.uint64))
    # Ones before each word; the start of bucket h is behind h zeros.
    set_ = np.concatenate(([0], np.cumsum(np.bitwise_count(words).astype(np.int64))))[:-1]
    zeros = _directory(np.arange(len(words)) * 64 - set_, len(words) * 64 - count)
    places = _directory(set_, count)
    lows = _pack(low, width)
    header = np.array([count, width, buckets, len(lows), len(words), len(zeros), len(places)], np.uint64)
    return [header, lows, words, zeros, places]


class EliasFano:
    """A mapped or loaded sequence; ``size`` is the number of 64-bit words that it takes."""

    def __init__(self, words: np.ndarray):
        count, width, buckets, *sizes = words[:HEADER].tolist()
        self.count, self.width, self.buckets = count, width, buckets
        ends = np.cumsum([HEADER, *sizes]).tolist()
        self.size = ends[-1]
        self.low, self.high = (self._at_bytes(words[a:b]) for a, b in zip(ends[:2], ends[1:3], strict=True))
        self.high_words = words[ends[1] : ends[2]]
        self.zeros, self.ones = (words[a:b].view(np.uint32) for a, b in zip(ends[2:4], ends[3:], strict=True))

    @staticmethod
    def _at_bytes(words: np.ndarray) -> np.ndarray:
        """The eight bytes at every byte, as numbers."""
        raw = words.view(np.uint8)
        return np.lib.stride_tricks.as_strided(raw.view(np.uint64), (len(raw) - 7,), (1,))

    @staticmethod
    def _bits(source: np.ndarray, at: np.ndarray) -> np.ndarray:
        """At least ``WINDOW`` + 1 bits from each bit offset."""
        return source[at >> 3] >> (at & 7).astype(np.uint64)

    @staticmethod
    def _select(words: np.ndarray, before: np.ndarray, word: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The place of the set bit of each rank, from 1, that lies in ``word``."""
        need = (rank - before[word] - 1).astype(np.uint64)
        # Ones of each byte and of the bytes before it, in the eight bytes of a number.
        sums = words - ((words >> np.uint64(1)) & PAIRS)
        sums = (sums & FOURS) + ((sums >> np.uint64(2)) & FOURS)
        sums = ((sums + (sums >> np.uint64(4))) & BYTES) * EVERY
        # The byte where the rank is reached lies behind those whose sums are not above it.
        before_it = (((need * EVERY) | TOPS) - sums) & TOPS
        bit = np.bitwise_count(before_it).astype(np.uint64) << np.uint64(3)
        need -= ((sums << np.uint64(8)) >> bit) & np.uint64(255)
        inside = ((words >> bit) & np.uint64(255)) << np.uint64(3) | need
        bit = bit.astype(np.int64) + IN_BYTE[inside.astype(np.int64)]
        return word * 64 + bit

    @staticmethod
    def _word_of(before: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return np.maximum(np.searchsorted(before, rank.astype(np.uint32)) - 1, 0)

    def _starts(self, bucket: np.ndarray) -> np.ndarray:
        """The bit where each bucket starts: behind as many zeros as its number."""
        word = self._word_of(self.zeros, bucket)
        return np.where(bucket > 0, self._select(~self.high_words[word], self.zeros, word, bucket) + 1, 0)

    def _ones(self, places: np.ndarray) -> np.ndarray:
        """The bit of each place's one."""
        word = self._word_of(self.ones, places + 1)
        return self._select(self.high_words[word], self.ones, word, places + 1)

    def _keys(self, places: np.ndarray, ones: np.ndarray) -> np.ndarray:
        low = self._bits(self.low, places * self.width) & np.uint64((1 << self.width) - 1)
        return ((ones - places).astype(np.uint64) << np.uint64(self.width) | low).astype(np.int64)

    def at(self, places: np.ndarray) -> np.ndarray:
        """The keys at places of the sequence."""
        return self._keys(places, self._ones(places))

    def pairs_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys at places of the sequence, and those at the next places."""
        ones, after = self._ones(places), places + 1
        # The next one mostly lies in the bits that are read behind the first.
        bits = self._bits(self.high, ones + 1) & np.uint64((1 << WINDOW) - 1)
        next_ = ones + 1 + np.bitwise_count(~bits & (bits - np.uint64(1))).astype(np.int64)
        if len(far := np.flatnonzero(bits == 0)):
            next_[far] = self._ones(after[far])
        return self._keys(places, ones), self._keys(after, next_)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in the sequence, or -1."""
        return self.find_within(keys, np.zeros(len(keys), np.int64), np.full(len(keys), self.count))

    def find_within(self, keys: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place of each key in its own range of the sequence, or -1."""
        found = np.full(len(keys), -1, np.int64)
        if not self.count or not len(keys):
            return found
        bucket = (keys >> np.uint64(self.width)).astype(np.int64)
        mask = np.uint64((1 << self.width) - 1)
        # Buckets beyond the last one hold nothing.
        active = np.flatnonzero((bucket < self.buckets) & (begins < ends))
        bucket, low = bucket[active], keys[active] & mask
        starts = self._starts(bucket)
        # A bucket is a run of ones, which mostly ends in the bits that are read.
        bits = self._bits(self.high, starts) & np.uint64((1 << WINDOW) - 1)
        run = np.bitwise_count(bits & ~(bits + np.uint64(1))).astype(np.int64)
        if len(long := np.flatnonzero(run == WINDOW)):
            run[long] = self._starts(bucket[long] + 1) - 1 - starts[long]
        first = np.maximum(starts - bucket, begins[active])
        last = np.minimum(starts - bucket + run, ends[active])
        # Low bits ascend within a bucket: halve its range until the successor is left.
        open_ = np.flatnonzero(first < last)
        begin, end = first.copy(), last.copy()
        while len(open_):
            middle = (begin[open_] + end[open_]) >> 1
            below = (self._bits(self.low, middle * self.width) & mask) < low[open_]
            begin[open_] = np.where(below, middle + 1, begin[open_])
            end[open_] = np.where(below, end[open_], middle)
            open_ = open_[begin[open_] < end[open_]]
        inside = np.flatnonzero(begin < last)
        hit = (self._bits(self.low, begin[inside] * self.width) & mask) == low[inside]
        found[active[inside[hit]]] = begin[inside[hit]]
        return found


def decode(sequence: EliasFano) -> Iterator[int]:
    """All keys in order, one by one; for tests and small sequences."""
    bucket, place, position = 0, 0, 0
    while place < sequence.count:
        here = np.array([position])
        if int(sequence._bits(sequence.high, here)[0]) & 1:
            low = int(sequence._bits(sequence.low, np.array([place * sequence.width]))[0])
            yield bucket << sequence.width | low & ((1 << sequence.width) - 1)
            place += 1
        else:
            bucket += 1
        position += 1
