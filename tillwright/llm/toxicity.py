"""Toxicity of documents by a linear classifier over character n-grams of their words,
each feature scaled by its naive Bayes log-count ratio."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import staged

FIT_ROWS = 8000
FEATURES = 1 << 18
SHORTEST, LONGEST = 2, 5
PENALTY = 1e-3
ROUNDS = 40
CACHED_WORDS = 300_000
#: Words longer than this are rare, and not kept.
CACHED_LETTERS = 64
NONZEROS_AT_ONCE = 2_000_000
APART = str.maketrans({mark: " " for mark in ".,;:!?\"'()[]{}<>"})


class WordFeatures(dict):
    """Hashed n-grams of a word of any length between its edges, and the whole word, as
    int32 bytes."""

    def __missing__(self, word: str) -> bytes:
        raw = f"\x02{word}\x03"
        grams = {raw[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(raw) - n + 1)}
        grams.add(f"={word}")
        made = np.array([zlib.crc32(gram.encode()) % FEATURES for gram in grams], np.int32).tobytes()
        if len(word) > CACHED_LETTERS:
            return made
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = made
        return made


class Features:
    """The distinct features of a text."""

    def __init__(self):
        self.words = WordFeatures()
        self.last = np.zeros(FEATURES, np.int64)

    def of(self, text: str | None) -> np.ndarray:
        words = set((text or "").lower().translate(APART).split())
        found = np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32)
        # A feature counts where it occurs last, which needs no sorting.
        places = np.arange(len(found))
        self.last[found] = places
        return found[self.last[found] == places]


def _minimum(loss_and_slope, start: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """A minimum of a smooth convex function by L-BFGS with backtracking."""
    at, moves, turns = start, [], []
    loss, slope = loss_and_slope(at)
    for _ in range(rounds):
        step, shares = slope.copy(), []
        for move, turn in zip(moves[::-1], turns[::-1], strict=True):
            shares.append((move @ step) / (move @ turn))
            step -= shares[-1] * turn
        step *= (moves[-1] @ turns[-1]) / (turns[-1] @ turns[-1]) if moves else 1 / max(1, np.linalg.norm(slope))
        for move, turn, share in zip(moves, turns, shares[::-1], strict=True):
            step += move * (share - (turn @ step) / (move @ turn))
        size = 1.0
        while True:
            new = at - size * step
            new_loss, new_slope = loss_and_slope(new)
            if new_loss <= loss - 1e-4 * size * (slope @ step) or size < 1e-6:
                break
            size /= 2
        if (new - at) @ (new_slope - slope) > 1e-12:
            moves, turns = [*moves, new - at][-memory:], [*turns, new_slope - slope][-memory:]
        done = abs(loss - new_loss) < 1e-6
        at, loss, slope = new, new_loss, new_slope
        if done:
            break
    return at


def fit(rows: list[np.ndarray], toxic: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the features and the constant; both classes weigh the same in total."""
    count, positive = len(rows), int(toxic.sum())
    if not 0 < positive < count:
        # Nothing to learn from: every text gets the share of toxic rows as its score.
        share = np.clip(positive / count if count else 0.0, 1e-6, 1 - 1e-6)
        return np.append(np.zeros(FEATURES), np.log(share / (1 - share)))
    sizes = np.array([len(row) for row in rows])
    flat, ends = np.concatenate(rows), np.cumsum(sizes)
    parts = np.searchsorted(ends, np.arange(0, ends[-1], NONZEROS_AT_ONCE), "right")
    parts = np.unique(np.append(parts, count))
    spans = [(a, b, flat[ends[a] - sizes[a] : ends[b - 1]]) for a, b in zip(parts[:-1], parts[1:], strict=True)]
    gather = lambda values: sum(
        np.bincount(own, np.repeat(values[a:b], sizes[a:b]), FEATURES) for a, b, own in spans
    )
    shares = [1.0 + gather((toxic == kind).astype(float)) for kind in (1, 0)]
    ratio = np.log(shares[0] / shares[0].sum()) - np.log(shares[1] / shares[1].sum())
    weight = np.where(toxic == 1, count / (2 * positive), count / (2 * (count - positive))) / count

    def loss_and_slope(at: np.ndarray) -> tuple[float, np.ndarray]:
        scaled = ratio * at[:-1]
        z = np.concatenate(
            [np.bincount(np.repeat(np.arange(b - a), sizes[a:b]), scaled[own], b - a) for a, b, own in spans]
        ) + at[-1]
        off = weight * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - toxic)
        loss = weight @ (np.logaddexp(0, z) - toxic * z) + 0.5 * penalty * (at[:-1] @ at[:-1])
        return loss, np.append(ratio * gather(off) + penalty * at[:-1], off.sum())

    found = _minimum(loss_and_slope, np.zeros(FEATURES + 1), rounds)
    return np.append(found[:-1] * ratio, found[-1])


def train(docs: DataFrame, labels: DataFrame, usable: Column, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Weights from at most ``fit_rows`` labelled documents, half of each class at most.

    The rows are picked by a hash of their id among those that are ``usable``; rows with a
    null label or id are not. Their ids, a few thousand at most, are broadcast to the scan
    of the documents; the fit runs in one task over that bounded sample.
    """
    known = labels.where(usable & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    halves = [
        known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows // 2)
        for kind in (0, 1)
    ]
    sample = staged(halves[0].union(halves[1]).distinct(), "toxicity-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features().of
        for batch in batches:
            rows = [of(text).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.binary()), batch.column(2)], names=["doc_id", "found", "toxic"]
            )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, toxic = [], []
        for batch in batches:
            rows += [np.frombuffer(row, np.int32) for row in batch.column(1).to_pylist()]
            toxic += batch.column(2).to_pylist()
        weights = fit(rows, np.array(toxic, float)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], names=["weights"])

    rows = staged(texts.mapInArrow(features, "doc_id long, found binary, toxic int"), "toxicity-features")
    # Repeated ids and rows may have more rows than the sample; the bound holds for rows too.
    rows = rows.orderBy("doc_id").limit(fit_rows).coalesce(1)
    found = rows.mapInArrow(solve, "weights binary").first()
    return np.frombuffer(found["weights"], np.float32) if found else fit([], np.empty(0)).astype(np.float32)


def score_documents(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with a column ``toxicity`` between 0 and 1, from the whole text alone.

    Null and empty texts get the classifier's constant. A column of that name is replaced;
    nothing is shuffled, and the weights are a table of fixed size (1 MB).
    """
    shared = df.sparkSession.sparkContext.broadcast(weights)
    others = [c for c in df.columns if c != "toxicity"]
    schema = df.select(others).schema.add("toxicity", "double")
    at = others.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = Features().of, shared.value.astype(np.float64)
        for batch in batches:
            z = np.array([table[of(text)].sum() for text in batch.column(at).to_pylist()]) + table[-1]
            score = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score, pa.float64())], names=[*batch.schema.names, "toxicity"]
            )

    return df.select(others).mapInArrow(run, schema)


def held_out(id_col: str, folds: int, fold: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; ids of fold 1 of 3 are not learnt
    from. A row without an id is not held out."""
    fold = lambda c: F.coalesce(held_out(c, 3, 1), F.lit(False))
    weights = train(docs, labels, ~fold("doc_id"))
    scored = score_documents(docs.select("doc_id", "text"), weights)
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), fold("doc_id").alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= threshold).cast("int").alias("predicted"),
    )
