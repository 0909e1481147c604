"""Scores of texts by an n-gram model in an Elias-Fano trie.

The first level is the vocabulary: 64-bit word hashes in ascending order; a word's id is its
place. Each further level holds the followers of the nodes of the level before, in order of
these nodes. A level is three monotone or packed arrays:

- pointers, an Elias-Fano sequence of where each node's range of followers begins;
- followers, an Elias-Fano sequence of word ids, each raised by the last value of the range
  before, so that ranges go on ascending; a follower is found by the successor of its raised
  id inside the range that the pointers give;
- one byte for each smoothed probability and, where a node has followers, for its back-off weight.

The trie is cut by the first word of its paths: shards are ranges of the word's hash, and the
paths from a very frequent word are spread by their second word. Every path lies in one file,
which tasks map into memory. Probabilities are interpolated by absolute discounting.
"""

from __future__ import annotations

import mmap
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import staged
from tillwright.llm.elias_fano import EliasFano, encode
from tillwright.llm.shingles import WordHashes, words_of
from tillwright.llm.token_files import local_path
from tillwright.session import shared_folder

ORDER = 3
DISCOUNT = 0.75
LETTERS_AT_ONCE = 4_000_000
PAIRS_AT_ONCE = 3_000_000
#: There are as many shards as make this much text each, so that a task's share is bounded.
BYTES_A_SHARD = 64 << 20
#: Paths from a word of more tokens are spread by their second word, so many tokens a part, so
#: that files are as many as the texts ask for. Numbers of parts are below ``HOT_PARTS``.
HOT_CONTEXT, HOT_PARTS = 2_000_000, 1 << 14
#: Ids of words must fit into half a key of 64 bits.
MOST_WORDS = (1 << 32) - 2
#: Files of a kind that a task holds mapped at once; pages of more would count as its memory.
OPEN_FILES = 16
#: Codes span this many decades of probability, in equal steps of the logarithm.
DECADES = 16.0
END = (1 << 64) - 1

COUNTED = "shard int, part int, keys binary, counts binary"
BUILT = "shard int, part int, size long, total long, contexts binary, followers binary"


def codes_of(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-log10 * (255 / DECADES)), 0, 255).astype(np.uint8)


def values_of(codes: np.ndarray) -> np.ndarray:
    return -codes.astype(np.float64) * (DECADES / 255)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(count, first)


class Hashes:
    """Token hashes of texts: words, then one end each. No word has the hash of the end."""

    def __init__(self):
        self.known = WordHashes()

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens, and the place behind the end of every text."""
        known, flat, ends = self.known.__getitem__, [], []
        for text in texts:
            flat += map(known, words_of(text))
            flat.append(END)
            ends.append(len(flat))
        made = np.array(flat, np.uint64)
        ends = np.array(ends, np.int64)
        is_end = np.zeros(len(made), bool)
        is_end[ends - 1] = True
        made[~is_end & (made == END)] = 0
        return made, ends


def _slices(texts: list[str | None], most: int = LETTERS_AT_ONCE) -> Iterator[slice]:
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "") + 1
        if size >= most:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def _packed_words(key: np.ndarray, count: np.ndarray, shard_bits: int) -> pa.RecordBatch:
    """Hashes and counts of each shard; hashes ascend within it."""
    shard = (key >> np.uint64(64 - shard_bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(shard, prepend=-1))
    ends = [*cuts[1:], len(key)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(shard[cuts], pa.int32()),
            pa.array(np.zeros(len(cuts)), pa.int32()),
            pa.array([key[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
            pa.array([count[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
        ],
        names=["shard", "part", "keys", "counts"],
    )


def _words(shard_bits: int):
    """Counts of tokens by hash; shards are ranges of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys, counts, waiting = Hashes(), [], [], 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in _slices(texts):
                key, count = np.unique(hashes.of(texts[part])[0], return_counts=True)
                keys.append(key), counts.append(count)
                waiting += len(key)
                if waiting > PAIRS_AT_ONCE:
                    yield _packed_words(*_merged(keys, counts), shard_bits)
                    keys, counts, waiting = [], [], 0
        if keys:
            yield _packed_words(*_merged(keys, counts), shard_bits)

    return run


def _write(place: str, name: str, arrays: list[np.ndarray]) -> None:
    """Arrays of 64-bit words, each after its length; a file appears whole, also if it is written again."""
    made = os.path.join(place, f"{name}-{uuid.uuid4().hex}")
    with open(made, "wb") as out:
        for array in arrays:
            words = np.frombuffer(array.tobytes().ljust(-(-array.nbytes // 8) * 8, b"\0"), np.uint64)
            out.write(np.array([len(words)], np.uint64).tobytes())
            out.write(words.tobytes())
    os.replace(made, os.path.join(place, name))


def _sections(place: str, name: str) -> list[np.ndarray]:
    with open(os.path.join(place, name), "rb") as file:
        words = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.uint64)
    at, found = 0, []
    while at < len(words):
        size = int(words[at])
        found.append(words[at + 1 : at + 1 + size])
        at += 1 + size
    return found


def _sequence(keys: np.ndarray, universe: int) -> np.ndarray:
    return np.concatenate(encode(keys.astype(np.uint64), universe))


def _totals(counts: np.ndarray) -> np.ndarray:
    """Sums of all counts before each one, and of all."""
    return np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))


def _built(shard: int, part: int, size: int, total: int, contexts: bytes, followers: bytes) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    names = [column.split()[0] for column in BUILT.split(", ")]
    values = [shard, part, size, total, contexts, followers]
    return pa.table({n: pa.array([v], k) for n, v, k in zip(names, values, kinds, strict=True)})


def _build_words(place: str, shard_bits: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, counts = _merged(
            [np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()],
            [np.frombuffer(x, np.uint32).astype(np.int64) for x in table["counts"].to_pylist()],
        )
        shard, total = key[0].as_py(), int(counts.sum())
        within = keys & np.uint64((1 << (64 - shard_bits)) - 1)
        # Counts are the steps of their sums, which ascend.
        _write(place, f"words-{shard}", [_sequence(within, 1 << (64 - shard_bits)), _sequence(_totals(counts), total)])
        return _built(shard, 0, len(keys), total, b"", b"")

    return run


@dataclass
class Layout:
    """Where the levels are: the first id of each shard, and the sums that scores need."""

    place: str
    order: int
    shard_bits: int
    firsts: np.ndarray
    tokens: int
    size: int


class Level:
    """The followers of a level's nodes in one file."""

    def __init__(self, pointers: np.ndarray, followers: np.ndarray, codes: np.ndarray, weights: np.ndarray):
        self.pointers, self.followers = EliasFano(pointers), EliasFano(followers)
        self.codes, self.weights = codes.view(np.uint8), weights.view(np.uint8)

    def find(self, nodes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The place of each word among the followers of its node, or -1."""
        # Rows of one node stand together, so its range is read once.
        first = np.flatnonzero(np.diff(nodes, prepend=-1))
        own, times = nodes[first], np.diff(first, append=len(nodes))
        begins, ends = self.pointers.pairs_at(own)
        before = np.where(begins > 0, self.followers.at(np.maximum(begins - 1, 0)), 0)
        begins, ends, before = (np.repeat(x, times) for x in (begins, ends, before))
        return self.followers.find_within((before + words + 1).astype(np.uint64), begins, ends)


class Trie:
    """The levels as mapped files, opened as they are needed."""

    def __init__(self, layout: Layout):
        self.layout = layout
        self.level = lru_cache(OPEN_FILES)(self._level)
        self.branches = lru_cache(OPEN_FILES)(self._branches)
        self.weights = lru_cache(OPEN_FILES)(self._weights)

    def _level(self, shard: int) -> tuple[EliasFano, EliasFano] | None:
        if not (bounds := self.layout.firsts[shard : shard + 2])[0] < bounds[1]:
            return None
        hashes, totals = _sections(self.layout.place, f"words-{shard}")
        return EliasFano(hashes), EliasFano(totals)

    def _branches(self, file: int) -> tuple[EliasFano, list[Level]] | None:
        """The first words of a file's paths, and its levels; None if there is no such path."""
        if not os.path.exists(os.path.join(self.layout.place, f"paths-{file}")):
            return None
        roots, *rest = _sections(self.layout.place, f"paths-{file}")
        return EliasFano(roots), [Level(*rest[i : i + 4]) for i in range(0, len(rest), 4)]

    def _weights(self, shard: int) -> np.ndarray:
        return _sections(self.layout.place, f"weights-{shard}")[0].view(np.uint8)

    def counts(self, shard: int) -> np.ndarray:
        totals = self.level(shard)[1]
        return np.diff(totals.at(np.arange(totals.count)))

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and count of each hash; -1 and 0 for unknown words."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        bits = self.layout.shard_bits
        shard = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        for own, rows in _by_value(shard):
            if held := self.level(own):
                at = held[0].find(hashes[rows] & np.uint64((1 << (64 - bits)) - 1))
                rows, at = rows[at >= 0], at[at >= 0]
                ids[rows] = at + self.layout.firsts[own]
                counts[rows] = held[1].at(at + 1) - held[1].at(at)
        return ids, counts

    def shard_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard of each word id and its place there."""
        shard = np.searchsorted(self.layout.firsts, ids, "right") - 1
        return shard, ids - self.layout.firsts[shard]

    def files_of(self, firsts: np.ndarray, seen: np.ndarray, seconds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The file that holds a path, by its first two words and how often the first was
        seen, and the first word's place in its shard."""
        shard, place = self.shard_of(firsts)
        parts = np.minimum(-(-seen // HOT_CONTEXT), HOT_PARTS - 1)
        part = np.where(parts > 1, 1 + seconds * parts // (self.layout.size + 1), 0)
        return shard * HOT_PARTS + part, place

    def weights_of(self, ids: np.ndarray) -> np.ndarray:
        """The weight of the first level behind each word."""
        found = np.empty(len(ids))
        shard, place = self.shard_of(ids)
        for own, rows in _by_value(shard):
            found[rows] = 10 ** values_of(self.weights(own)[place[rows]])
        return found

    def roots(self, files: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The node of a path's first word in its file, or -1."""
        found = np.full(len(files), -1, np.int64)
        for own, rows in _by_value(files):
            if held := self.branches(own):
                found[rows] = held[0].find(places[rows].astype(np.uint64))
        return found

    def follow(self, depth: int, files: np.ndarray, nodes: np.ndarray, words: np.ndarray):
        """Node, discounted probability and back-off weight of each word behind its node on
        the level of ``depth`` words; -1, 0 and 1 where it never followed."""
        found = np.full(len(files), -1, np.int64)
        chance, weight = np.zeros(len(files)), np.ones(len(files))
        known = np.flatnonzero(nodes >= 0)
        for own, rows in _by_value(files[known]):
            rows, level = known[rows], self.branches(own)[1][depth - 1]
            at = level.find(nodes[rows], words[rows])
            rows, at = rows[at >= 0], at[at >= 0]
            found[rows], chance[rows] = at, 10 ** values_of(level.codes[at])
            if len(level.weights):
                weight[rows] = 10 ** values_of(level.weights[at])
        return found, chance, weight


def _by_value(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    cuts = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] - 1))
    for a, b in zip(cuts, [*cuts[1:], len(values)], strict=True) if len(values) else ():
        yield int(ordered[a]), order[a:b]


class Tokens:
    """Texts as word ids with their counts, by a memory of lately seen words."""

    def __init__(self, trie: Trie):
        self.trie, self.hashes = trie, Hashes()

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, ends = self.hashes.of(texts)
        distinct, place = np.unique(hashes, return_inverse=True)
        ids, counts = self.trie.look_up(distinct)
        return ids[place], counts[place], ends


def _opened(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The tokens of each text behind one end, which opens it as a context."""
    starts = np.concatenate(([0], ends[:-1]))
    return np.insert(values, starts, values[ends - 1])


def _steps(ends: np.ndarray) -> np.ndarray:
    """How many tokens have come before each place of opened texts; 0 where a text opens."""
    sizes = np.diff(ends, prepend=0) + 1
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _distinct(parents: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct nodes in order of parent and word, and the place of each row among them."""
    key = parents.astype(np.uint64) << np.uint64(32) | words.astype(np.uint64)
    nodes, place = np.unique(key, return_inverse=True)
    return (nodes >> np.uint64(32)).astype(np.int64), (nodes & np.uint64((1 << 32) - 1)).astype(np.int64), place


def _packed_paths(trie: Trie, ids: np.ndarray, seen: np.ndarray, step: np.ndarray) -> pa.RecordBatch:
    """The paths of opened texts as one small trie for each file.

    A small trie is an array of unsigned integers: the number of nodes on each level, the first
    words' places in their shard, and for each further level how many nodes follow each node
    of the level before, the words and their counts.
    """
    order = trie.layout.order
    begin = np.flatnonzero(step[1:] > 0)
    file, place = trie.files_of(ids[begin], seen[begin], ids[begin + 1])
    files, roots, node = _distinct(file, place)
    levels, size = [], len(roots)
    for depth in range(1, order):
        if depth > 1:
            # A path goes on only within its text.
            goes_on = np.flatnonzero(begin + depth < len(ids))
            goes_on = goes_on[step[begin[goes_on] + depth] == step[begin[goes_on]] + depth]
            begin, node = begin[goes_on], node[goes_on]
        parent, word, node = _distinct(node, ids[begin + depth])
        levels.append((np.bincount(parent, minlength=size), word, np.bincount(node, minlength=len(word))))
        size = len(word)
    cuts = np.flatnonzero(np.diff(files, prepend=-1))
    bounds = [np.append(cuts, len(files))]
    for fans, _, _ in levels:
        bounds.append(_totals(fans)[bounds[-1]])
    roots = roots.astype(np.uint32)
    levels = [tuple(array.astype(np.uint32) for array in level) for level in levels]
    blobs = []
    for i in range(len(cuts)):
        own = [slice(at[i], at[i + 1]) for at in bounds]
        arrays = [np.array([x.stop - x.start for x in own], np.uint32), roots[own[0]]]
        for (fans, word, count), above, here in zip(levels, own, own[1:], strict=False):
            arrays += [fans[above], word[here], count[here]]
        blobs.append(np.concatenate(arrays).tobytes())
    at = files[cuts]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(at // HOT_PARTS, pa.int32()),
            pa.array(at % HOT_PARTS, pa.int32()),
            pa.array(blobs, pa.binary()),
            pa.array([b""] * len(blobs), pa.binary()),
        ],
        names=["shard", "part", "keys", "counts"],
    )


def _paths(shared):
    """Counts of all paths of the texts, packed by the file they go to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        tokens = Tokens(trie)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in _slices(texts):
                ids, seen, ends = tokens.of(texts[part])
                yield _packed_paths(trie, _opened(ids, ends), _opened(seen, ends), _steps(ends))

    return run


def _united(blobs: list[bytes], order: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Small tries as one: its first words, and parents, words and counts of each further level."""
    tries = [np.frombuffer(blob, np.uint32) for blob in blobs]
    sizes = np.array([trie[:order] for trie in tries], np.int64)
    at = [order] * len(tries)

    def take(depth: int) -> np.ndarray:
        pieces = []
        for i, trie in enumerate(tries):
            pieces.append(trie[at[i] : at[i] + sizes[i, depth]])
            at[i] += sizes[i, depth]
        return np.concatenate(pieces).astype(np.int64)

    roots, node = np.unique(take(0), return_inverse=True)
    levels = []
    for depth in range(1, order):
        above = np.repeat(node, take(depth - 1))
        words, counts = take(depth), take(depth)
        parent, word, node = _distinct(above, words)
        total = np.zeros(len(word), np.int64)
        np.add.at(total, node, counts)
        levels.append((parent, word, total))
    return roots, levels


def _raised(parent: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Each word plus one above the last value of the range before its own."""
    if not len(parent):
        return word
    last = np.append(parent[1:] != parent[:-1], True)
    steps = np.where(last, word + 1, 0)
    return np.cumsum(steps) - steps + word + 1


def _build_paths(shared):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        layout: Layout = shared.value
        shard, part = key[0].as_py(), key[1].as_py()
        roots, levels = _united(table["keys"].to_pylist(), layout.order)
        size = int(layout.firsts[shard + 1] - layout.firsts[shard])
        arrays, above = [_sequence(roots, size)], Trie(layout).counts(shard)[roots]
        for depth, (parent, word, count) in enumerate(levels, 1):
            raised = _raised(parent, word)
            codes = codes_of(np.log10((count - DISCOUNT) / above[parent]))
            weights = np.empty(0, np.uint8)
            if depth < len(levels):
                fans = np.bincount(levels[depth][0], minlength=len(word))
                weights = codes_of(np.log10(np.maximum(DISCOUNT * fans / count, 1e-300)))
            pointers = _totals(np.bincount(parent, minlength=len(above)))
            universe = int(raised[-1]) + 1 if len(raised) else 1
            arrays += [_sequence(pointers, len(word) + 1), _sequence(raised, universe), codes, weights]
            above = count
        _write(layout.place, f"paths-{shard * HOT_PARTS + part}", arrays)
        followers = np.bincount(levels[0][0], minlength=len(roots))
        return _built(shard, part, len(roots), 0, roots.tobytes(), followers.astype(np.int64).tobytes())

    return run


def _build_weights(shared):
    """Back-off weights of the first level; a frequent word's followers lie in several files."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        layout: Layout = shared.value
        shard = key[0].as_py()
        seen = Trie(layout).counts(shard)
        distinct = np.zeros(len(seen))
        for contexts, followers in zip(table["contexts"].to_pylist(), table["followers"].to_pylist(), strict=True):
            distinct[np.frombuffer(contexts, np.int64)] += np.frombuffer(followers, np.int64)
        _write(layout.place, f"weights-{shard}", [codes_of(np.log10(np.maximum(DISCOUNT * distinct / seen, 1e-300)))])
        return _built(shard, 0, len(seen), 0, b"", b"")

    return run


def train(texts: DataFrame, order: int = ORDER) -> Layout:
    """Build the trie of all rows of ``texts(text)`` in files of the shared folder.

    ``order`` is the number of words of the longest paths, two at least. Words are counted in
    ranges of their hash, paths in the range of their first word, of which there are as many
    as the length of all texts asks for. Counts are combined in each task before they are
    shuffled, so what a range gets of one path is at most one count for each chunk of texts.
    Only the sizes of the ranges come to the driver.
    """
    if order < 2:
        raise ValueError("a path has two words at least")
    spark = texts.sparkSession
    place = local_path(shared_folder(spark, "ngram-trie"))
    os.makedirs(place, exist_ok=True)
    letters = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), letters // BYTES_A_SHARD + 1)
    bits = max(1, (shards - 1).bit_length())
    counted = texts.select("text").mapInArrow(_words(bits), COUNTED).repartition(1 << bits, "shard")
    built = staged(counted.groupBy("shard").applyInArrow(_build_words(place, bits), BUILT), "ngram-words")
    sizes, total = np.zeros(1 << bits, np.int64), 0
    for row in built.select("shard", "size", "total").collect():
        sizes[row["shard"]] = row["size"]
        total += row["total"]
    layout = Layout(place, order, bits, _totals(sizes), total, int(sizes.sum()))
    if layout.size > MOST_WORDS:
        raise ValueError(f"{layout.size} distinct words do not fit into 32 bits")
    if not total:
        return layout
    shared = spark.sparkContext.broadcast(layout)
    paths = texts.select("text").mapInArrow(_paths(shared), COUNTED).repartition(1 << bits, "shard", "part")
    built = staged(paths.groupBy("shard", "part").applyInArrow(_build_paths(shared), BUILT), "ngram-paths")
    # Written only for its files.
    staged(built.groupBy("shard").applyInArrow(_build_weights(shared), BUILT), "ngram-weights")
    return layout


def _chances(trie: Trie, ids: np.ndarray, seen: np.ndarray, step: np.ndarray, single: np.ndarray) -> np.ndarray:
    """The probability of each token of opened texts after the tokens before it.

    ``single`` is that of the token alone. Each longer context that was seen takes the
    shorter one's probability times its weight and adds its own discounted one.
    """
    chance = single.copy()
    begin = np.flatnonzero((step[1:] > 0) & (ids[:-1] >= 0))
    distinct, place = np.unique(ids[begin], return_inverse=True)
    weight = trie.weights_of(distinct)[place] if len(begin) else np.empty(0)
    file = node = None
    for depth in range(1, trie.layout.order):
        chance[begin + depth] *= weight
        known = np.flatnonzero(ids[begin + depth] >= 0)
        begin = begin[known]
        if depth == 1:
            firsts, words, place = _distinct(ids[begin], ids[begin + 1])
            times = np.zeros(len(firsts), np.int64)
            times[place] = seen[begin]
            files, roots = trie.files_of(firsts, times, words)
            nodes = trie.roots(files, roots)
        else:
            parents, words, place = _distinct(node[known], ids[begin + depth])
            files, nodes = file[parents], held[parents]
        held, added, weights = trie.follow(depth, files, nodes, words)
        chance[begin + depth] += added[place]
        # Paths that were seen go on, within their text.
        goes_on = (held[place] >= 0) & (begin + depth + 1 < len(ids))
        goes_on[goes_on] = step[begin[goes_on] + depth + 1] == step[begin[goes_on]] + depth + 1
        begin, node, file = begin[goes_on], place[goes_on], files
        weight = weights[node]
    return chance


def score_documents(df: DataFrame, layout: Layout, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Tokens are words and one end; a null text is its end alone. ``base_score`` adds one to
    every count; ``score`` is the log10 probability of the text under the model, whose first
    level gives an unknown word the mass of discounts on one more word. With nothing to learn
    from both are 0 for every text. Ids may be null or repeated.
    """
    shared = df.sparkSession.sparkContext.broadcast(layout)
    columns = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = ["doc_id", *(column.split()[0] for column in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        tokens, total, size = Tokens(trie), shared.value.tokens, shared.value.size
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in _slices(texts):
                ids, seen, ends = tokens.of(texts[part])
                starts = np.concatenate(([0], ends[:-1]))
                base = np.log10((seen + 1) / (total + size + 1))
                # The first level: discounted counts, and what they leave shared by all words.
                rest = DISCOUNT * size / total / (size + 1) if total else 1.0
                opened, step = _opened(seen, ends), _steps(ends)
                single = np.maximum(opened - DISCOUNT, 0) / max(total, 1) + rest
                score = np.log10(_chances(trie, _opened(ids, ends), opened, step, single)[step > 0])
                n = ends - starts
                values = [
                    pa.array(n, pa.int64()),
                    pa.array(np.add.reduceat((seen > 0).astype(np.int64), starts), pa.int64()),
                    pa.array(np.full(len(n), total), pa.int64()),
                    pa.array(np.add.reduceat(base, starts), pa.float64()),
                    pa.array(np.add.reduceat(score, starts), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0)[part.start : part.stop], *values], names=names)

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, f"doc_id long, {columns}")


def language_model_report(df: DataFrame, folds: int = 7, fold: int = 2, order: int = ORDER) -> DataFrame:
    """Scores of all documents by a model of those whose id is not in the held-out fold.

    A document without an id is learnt from; a repeated row counts each time it occurs.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))
    layout = train(df.where(~held).select("text"), order)
    scored = score_documents(df, layout)
    return scored.select("doc_id", held.alias("held_out"), *scored.columns[1:])
