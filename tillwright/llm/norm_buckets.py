"""Ranked lexical search over buckets of impact vectors of like length.

A document is a vector of impacts, one for each term that some item holds; an item is a
vector of the times it holds a term, and a score is their inner product. Vectors are laid
out by length. Longest first they are cut into buckets, and an item skips each bucket
whose length times its own (Cauchy-Schwarz) stays below the score that its k best have
reached. Inside a bucket the largest impact of each coordinate bounds what coordinates can
add: only documents in the lists of the few coordinates without which the score cannot be
reached are looked at, and of these only those go on whose partial product and remaining
length still allow it. These survivors are scored again from their own rows in integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import staged

# Bytes of a term: digits, letters in lower case, and all bytes of other characters.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
BYTES_AT_ONCE = 1 << 20
ROWS_PER_BUCKET = 1024
ENTRIES_PER_BUCKET = 1_000_000
# Items are searched in blocks of about so many pairs of item and term, what one broadcast holds.
PAIRS_PER_BLOCK = 500_000
# About so many of the longest vectors are searched first, to start all tasks from good scores.
HEADS = 4096
# Above the rounding of the sums of doubles in the bounds.
SLACK = 1 + 1e-9

COUNTED = "doc_id long, n long, terms binary, counts binary"
PLACED = "place long, doc_id long, length double, terms binary, impacts binary"
FOUND = "item int, item_id long, doc_id long, score long"


def terms_of(raw: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, a bounded part of the text at a time."""
    at = 0
    while raw is not None and at < len(raw):
        end = at + BYTES_AT_ONCE
        part = raw[at:end].translate(TERM_BYTES)
        while end < len(raw) and part[-1] != 0x20:
            # A part ends at a byte between terms; a longer term makes it longer.
            more = raw[end : end + 4096].translate(TERM_BYTES)
            cut = more.find(b" ")
            more = more[: cut + 1] if cut >= 0 else more
            part, end = part + more, end + len(more)
        yield part.split()
        at = end


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, terms, times = [], [], []
        for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            counts: Counter[bytes] = Counter()
            for part in terms_of(raw):
                counts.update(part)
            ids += [item] * len(counts)
            terms += [term.decode() for term in counts]
            times += counts.values()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(terms, pa.string()), pa.array(times, pa.int64())],
            names=["item_id", "term", "times"],
        )


def _count(vocabulary):
    """Terms of each text, and which terms of the vocabulary it holds how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            totals, terms, counts = [], [], []
            for raw in batch.column(1).cast(pa.binary()).to_pylist():
                total, known = 0, []
                for part in terms_of(raw):
                    total += len(part)
                    known.append(np.array([x for x in map(number, part) if x is not None], np.int32))
                held, times = np.unique(np.concatenate(known or [np.empty(0, np.int32)]), return_counts=True)
                totals.append(total)
                terms.append(held.tobytes())
                counts.append(times.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                names=["doc_id", "n", "terms", "counts"],
            )

    return run


def _holders(size: int):
    """Documents of a task that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                df[np.frombuffer(raw, np.int32)] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held])], names=["term", "df"])

    return run


def _weigh(weights, documents: int, all_terms: int):
    """Impact vectors with their lengths; documents without an impact are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = weights.value
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = ([], [], [], [], [])
            for doc_id, n, raw, counts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                place += 1
                terms, tf = np.frombuffer(raw, np.int32), np.frombuffer(counts, np.int32).astype(np.int64)
                damping = 100 - 75 + (75 * n * documents) // all_terms
                impacts = weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * damping))
                some = impacts > 0
                if some.any():
                    terms, impacts = terms[some], impacts[some]
                    length = float(np.sqrt(np.square(impacts.astype(np.float64)).sum()))
                    for column, value in zip(out, (place, doc_id, length, terms.tobytes(), impacts.tobytes()), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)],
                names=["place", "doc_id", "length", "terms", "impacts"],
            )

    return run


class Items(NamedTuple):
    """The items of one block; item i has terms ``terms[i]``, each ``times[i]`` times."""

    ids: list[int | None]
    terms: list[np.ndarray]
    times: list[np.ndarray]
    lengths: list[float]


class Bucket:
    """Some vectors, by row and by term."""

    def __init__(self, ids: np.ndarray, unnamed: np.ndarray, lengths: np.ndarray, terms: list[bytes], impacts: list[bytes]):
        self.ids, self.unnamed, self.lengths = ids, unnamed, lengths
        self.longest = lengths.max()
        self.terms = np.frombuffer(b"".join(terms), np.int32)
        self.impacts = np.frombuffer(b"".join(impacts), np.int64)
        self.sizes = np.array([len(x) // 4 for x in terms])
        self.starts = np.cumsum(self.sizes) - self.sizes
        order = np.argsort(self.terms, kind="stable")
        self.list_row = np.repeat(np.arange(len(ids)), self.sizes)[order]
        self.list_impact = self.impacts[order].astype(np.float64)
        self.held, begin = np.unique(self.terms[order], return_index=True)
        self.peak = np.maximum.reduceat(self.list_impact, begin)
        self.bounds = np.append(begin, len(order))

    def exact(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Scores of rows in integers; ``wanted`` has the times of each term of an item."""
        sizes = self.sizes[rows]
        first = np.cumsum(sizes) - sizes
        entry = np.arange(sizes.sum()) + np.repeat(self.starts[rows] - first, sizes)
        return np.add.reduceat(wanted[self.terms[entry]] * self.impacts[entry], first)

    def survivors(self, terms: np.ndarray, times: np.ndarray, least: int) -> np.ndarray:
        """Rows that may have a score of ``least``."""
        at = np.minimum(np.searchsorted(self.held, terms), len(self.held) - 1)
        here = self.held[at] == terms
        at, times = at[here], times[here].astype(np.float64)
        most = times * self.peak[at]
        by_most = np.argsort(-most, kind="stable")
        at, times, most = at[by_most], times[by_most], most[by_most]
        # What the coordinates from i on can add at most, 0 behind the last.
        rest = np.append(np.cumsum(most[::-1])[::-1], 0.0) * SLACK
        if rest[0] < least:
            return np.empty(0, np.int64)
        # Without one of the first ``focus`` coordinates no row gets there.
        focus = int(np.argmax(rest < least))
        partial, squares = np.zeros(len(self.ids)), np.zeros(len(self.ids))
        for coordinate, times_here in zip(at[:focus], times[:focus], strict=True):
            entries = slice(self.bounds[coordinate], self.bounds[coordinate + 1])
            rows, impact = self.list_row[entries], self.list_impact[entries]
            partial[rows] += times_here * impact
            squares[rows] += impact * impact
        # The rounding of length and squares is far below a part in a million of the length.
        left = np.sqrt(np.maximum(np.square(self.lengths) * (1 + 1e-9) - squares, 0.0))
        others = np.minimum(rest[focus], left * math.sqrt(np.square(times[focus:]).sum()))
        return np.flatnonzero((partial > 0) & ((partial + others) * SLACK >= least))


def _best(ids, unnamed, scores, k):
    """The k best of some rows: highest score, then smallest id, rows without an id last."""
    keep = np.lexsort((ids, unnamed, -scores))[:k]
    return ids[keep], unnamed[keep], scores[keep]


def _buckets(batches: Iterator[pa.RecordBatch], rows_per_bucket: int) -> Iterator[Bucket]:
    for batch in batches:
        unnamed = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
        lengths = batch.column(1).to_numpy(zero_copy_only=False)
        terms, impacts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        begin = entries = 0
        for row in range(len(terms) + 1):
            full = row - begin >= rows_per_bucket or entries >= ENTRIES_PER_BUCKET
            if row > begin and (row == len(terms) or full):
                part = slice(begin, row)
                yield Bucket(ids[part], unnamed[part], lengths[part], terms[part], impacts[part])
                begin, entries = row, 0
            if row < len(terms):
                entries += len(terms[row]) // 4


def _search(items, reached, vocabulary_size: int, k: int, rows_per_bucket: int):
    """The k best of a task for each item, of scores not below what is ``reached``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Items = items.value
        least = list(reached.value)
        none = np.empty(0, np.int64)
        best = [(none, none.astype(bool), none)] * len(asked.ids)
        wanted = np.zeros(vocabulary_size, np.int64)
        for bucket in _buckets(batches, rows_per_bucket):
            for i, (terms, times) in enumerate(zip(asked.terms, asked.times, strict=True)):
                if asked.lengths[i] * bucket.longest * SLACK < least[i]:
                    continue
                rows = bucket.survivors(terms, times, least[i])
                if not len(rows):
                    continue
                wanted[terms] = times
                scores = bucket.exact(rows, wanted)
                wanted[terms] = 0
                good = scores >= least[i]
                rows, scores = rows[good], scores[good]
                ids, unnamed, known = best[i]
                best[i] = _best(
                    np.concatenate((ids, bucket.ids[rows])),
                    np.concatenate((unnamed, bucket.unnamed[rows])),
                    np.concatenate((known, scores)),
                    k,
                )
                if len(best[i][0]) == k:
                    least[i] = max(least[i], int(best[i][2][-1]))
        sizes = [len(x[0]) for x in best]
        doc_ids, unnamed, scores = (np.concatenate([x[j] for x in best] or [none]) for j in range(3))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(best)), sizes), pa.int32()),
                pa.array([x for x, size in zip(asked.ids, sizes, strict=True) for _ in range(size)], pa.int64()),
                pa.array(doc_ids, pa.int64(), mask=unnamed.astype(bool)),
                pa.array(scores, pa.int64()),
            ],
            names=["item", "item_id", "doc_id", "score"],
        )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(pairs: DataFrame, limit: int) -> int:
    """In how many blocks items are dealt, so that none has over twice the limit of pairs
    unless an item alone has more than that."""
    total = pairs.count()
    blocks = max(1, -(-total // limit))
    while blocks > 1:
        dealt = pairs.groupBy("item_id", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block")).count()
        sizes = dealt.groupBy("block").agg(F.sum("count").alias("pairs"), F.count(F.lit(1)).alias("items"))
        if sizes.where(f"pairs > {2 * limit} AND items > 1").isEmpty():
            break
        blocks *= 2
    return blocks


def _length_of(index: DataFrame, rows: int) -> float:
    """A length that about so many vectors have, or more if many are alike."""
    # Some thousand bins at most: doubles of this size span fewer than 70 powers of two.
    bins = index.groupBy(F.floor(F.log2("length") * 64).alias("bin"))
    sizes = bins.agg(F.count(F.lit(1)).alias("rows"), F.min("length").alias("least")).orderBy(F.desc("bin")).collect()
    cut, held = math.inf, 0
    for size in sizes:
        if held >= rows:
            break
        cut, held = size.least, held + size.rows
    return cut


def _search_block(counted_from: DataFrame, rows: list, k: int, heads: int, rows_per_bucket: int) -> DataFrame:
    spark = counted_from.sparkSession
    sc = spark.sparkContext
    number: dict[str, int] = {}
    by_item: dict[int | None, list[tuple[int, int]]] = {}
    for row in rows:
        by_item.setdefault(row.item_id, []).append((number.setdefault(row.term, len(number)), row.times))
    vectors = [np.array(sorted(x), np.int64) for x in by_item.values()]
    items = Items(
        list(by_item),
        [x[:, 0].astype(np.int32) for x in vectors],
        [x[:, 1] for x in vectors],
        [float(np.sqrt(np.square(x[:, 1].astype(np.float64)).sum())) for x in vectors],
    )
    vocabulary = sc.broadcast({term.encode(): i for term, i in number.items()})
    counted = staged(counted_from.mapInArrow(_count(vocabulary), COUNTED), "term-counts")
    sums = counted.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    if not sums.documents:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    holders = counted.select("terms").mapInArrow(_holders(len(number)), "term int, df long")
    weights = np.full(len(number), math.floor(1000 * math.log(2 * sums.documents + 2)), np.int64)
    for row in holders.groupBy("term").agg(F.sum("df").alias("df")).collect():
        weights[row.term] = math.floor(1000 * math.log((2 * sums.documents + 2) / (2 * row.df + 1)))
    placed = counted.mapInArrow(_weigh(sc.broadcast(weights), sums.documents, sums.terms), PLACED)
    # The place of a row splits vectors of equal length, however many copies they are.
    by_length = placed.repartitionByRange(F.desc("length"), F.col("place"))
    index = staged(by_length.sortWithinPartitions(F.desc("length"), "place"), "norm-buckets")
    asked = sc.broadcast(items)

    def search(part: DataFrame, reached: list[int]) -> DataFrame:
        task = _search(asked, sc.broadcast(reached), len(number), k, rows_per_bucket)
        return part.select("doc_id", "length", "terms", "impacts").mapInArrow(task, FOUND)

    # Any k documents give a lower bound of the kth score; scores below 1 are none.
    reached = [1] * len(items.ids)
    cut = _length_of(index, heads)
    first = index.where(F.col("length") >= cut)
    for row in _ranked(search(first, reached), k).where(F.col("rank") == k).collect():
        reached[row.item] = row.score
    shortest = min((x / y for x, y in zip(reached, items.lengths, strict=True)), default=0.0)
    found = search(index.where(F.col("length") >= shortest / SLACK), reached)
    return _ranked(found, k).select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pairs_per_block: int = PAIRS_PER_BLOCK,
    heads: int = HEADS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the k documents of highest score for each item.

    Terms are runs of letters, digits and characters beyond ASCII of the whole text, only A-Z
    in lower case. A term has the weight ``floor(1000 ln((2 N + 2) / (2 df + 1)))`` of ``N``
    documents with terms, ``df`` of them with this one; a document adds to a score, for each
    time that the item holds the term, the weight times ``10^9 tf div (1000 tf + 8 m)`` with ``m``
    = ``25 + 75 n N div L``. Only scores above 0 are ranked, ties by ascending id.

    Null and empty texts have no terms: such documents count nowhere, such items get no rows.
    A document with a null id counts as any other and stands behind equal scores. Repeated
    documents count and rank once a row. Equal rows of items count once; different texts of
    one item id are one item with the terms of all. Other columns are not looked at. Empty
    tables give an empty result.

    Items are dealt into blocks of bounded size, each of which passes over all documents; one
    block holds any set of items up to half a million pairs of item and term. Broadcast are
    one block's items, their weights and the scores reached. ``heads`` and ``rows_per_bucket``
    change no result: about ``heads`` of the longest vectors only give scores to start from.
    """
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    split = asked.distinct().mapInArrow(_item_terms, "item_id long, term string, times long")
    pairs = staged(split.groupBy("item_id", "term").agg(F.sum("times").alias("times")), "item-terms")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = _blocks(pairs, pairs_per_block)
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = [
        _search_block(texts, pairs.where(block == i).orderBy("item_id", "term").collect(), k, heads, rows_per_bucket)
        for i in range(blocks)
    ]
    return reduce(DataFrame.unionByName, found)
