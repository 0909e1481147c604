"""Content and boilerplate lines by a linear-chain conditional random field.

Lines of a document are a sequence of two labels. A line's features are shares of its
characters and words; the field has a weight per feature and one per pair of neighbouring
labels. It is trained on lines of documents whose quality is labelled. Lines of good documents
are content. A bad document has ordinary lines too: its lines are boilerplate where a field
without pairs, trained as if all of them were, says so, then where the field itself does,
and at least one of them always is. Viterbi decoding
runs over all documents of a batch at once, line by line. A document is kept if enough of
its words are in lines of content.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import staged

SYMBOLS = b"#*$%&|<>"
BOILERPLATE, CONTENT = 0, 1
# Bounds of the training sample: documents of each quality, and lines in a row of each of them.
DOCUMENTS_PER_CLASS = 2_000
LINES_PER_DOCUMENT = 64
ROUNDS, STEPS, RATE, DECAY = 2, 200, 0.1, 2e-4
LEAST_WORDS, MOST_REPEATED = 50, 50
LEAST_CONTENT = 0.5
BYTES_AT_ONCE = 16 << 20

FEATURES = (
    "always", "words", "word length", "short words", "long words", "symbols", "marks", "stops",
    "digits", "capitals", "shouted words", "bare marks", "word again", "distinct words", "line before", "ends a sentence",
)

WORD = re.compile("[^\x20\x09-\x0D]+")
# White space for Python that belongs to words here.
NO_BREAK = re.compile("[\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]")


def words_of(line: str) -> list[str]:
    """Words between blanks and the ASCII controls from tab to carriage return."""
    return WORD.findall(line) if NO_BREAK.search(line) else line.split()


def line_features(line: str, words: list[str], seen: bool) -> list[float]:
    n, chars = len(words), sum(map(len, words))
    if not n:
        return [1.0] + [0.0] * (len(FEATURES) - 1)
    raw = line.encode()
    count = lambda marks: len(raw) - len(raw.translate(None, marks))
    return [
        1.0,
        min(n, 40) / 40,
        min(chars / n, 20) / 20,
        sum(len(w) <= 3 for w in words) / n,
        sum(len(w) > 15 for w in words) / n,
        min(count(SYMBOLS) / n, 1.0),
        min(count(b"!?@=_~^+/\\:;()[]{}\"") / n, 1.0),
        min(count(b".,") / n, 1.0),
        min(4 * count(b"0123456789") / chars, 1.0),
        sum(w[:1].isupper() for w in words) / n,
        sum(w.isupper() and len(w) > 1 for w in words) / n,
        sum(not w[0].isalnum() for w in words) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(words)) / n,
        float(seen),
        float(words[-1][-1] in ".!?"),
    ]


def base_counts(text: str, lines: list[list[str]], raw_lines: list[str]) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, lines that an earlier one equals, words in windows
    of three that occur twice or more."""
    words = [word for line in lines for word in line]
    written = Counter(line for line, own in zip(raw_lines, lines, strict=True) if own)
    raw = text.encode()
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        here = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
        inside = np.zeros(len(words), bool)
        for shift in range(3):
            inside[shift : shift + len(here)] |= here
        repeated = int(inside.sum())
    return (
        len(words),
        sum(map(len, words)),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        sum(written.values()) - len(written),
        repeated,
    )


class Measured:
    """Features of all lines of one text, and its base counts."""

    def __init__(self, text: str | None):
        self.raw_lines = (text or "").split("\n")
        self.lines = [words_of(line) for line in self.raw_lines]
        self.base = base_counts(text or "", self.lines, self.raw_lines)
        seen: set[str] = set()
        rows = []
        for raw, words in zip(self.raw_lines, self.lines, strict=True):
            rows.append(line_features(raw, words, raw in seen))
            seen.add(raw)
        self.features = np.array(rows)


def viterbi(scores: list[np.ndarray], between: np.ndarray) -> list[np.ndarray]:
    """The best labels of each sequence of line scores (of content, against boilerplate).

    All sequences advance together, the longest first, so that the ones still running are
    always the first rows. Ties go to content.
    """
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    sizes = np.array([len(scores[i]) for i in order])
    ends = np.cumsum(sizes)
    flat = np.concatenate([scores[i] for i in order] or [np.empty(0)])
    from_content = np.empty((len(flat), 2), bool)
    best = np.zeros((len(order), 2))
    for at in range(sizes[0] if len(sizes) else 0):
        running = int(np.searchsorted(-sizes, -at, side="left"))
        entry = ends[:running] - sizes[:running] + at
        if at:
            ways = best[:running, :, None] + between[None, :, :]
            from_content[entry] = ways[:, CONTENT, :] >= ways[:, BOILERPLATE, :]
            best[:running] = ways.max(axis=1)
        best[:running, CONTENT] += flat[entry]
    labels = np.empty(len(flat), np.int8)
    state = np.empty(len(order), np.int8)
    for at in range((sizes[0] if len(sizes) else 0) - 1, -1, -1):
        running = int(np.searchsorted(-sizes, -at, side="left"))
        entry = ends[:running] - sizes[:running] + at
        last = sizes[:running] - 1 == at
        state[:running][last] = best[:running][last, CONTENT] >= best[:running][last, BOILERPLATE]
        labels[entry] = state[:running]
        state[:running] = from_content[entry, state[:running]]
    out: list[np.ndarray] = [np.empty(0, np.int8)] * len(order)
    for i, end, size in zip(order, ends, sizes, strict=True):
        out[i] = labels[end - size : end]
    return out


class Ragged:
    """Sequences line by line: first the first lines of all, the longest sequence first, then
    the second lines of those that have one, and so on."""

    def __init__(self, sequences: list[np.ndarray]):
        self.order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        sizes = np.array([len(sequences[i]) for i in self.order])
        self.running = [int((sizes > at).sum()) for at in range(sizes[0])]
        begin = np.cumsum([0, *self.running]).tolist()
        self.steps = [slice(x, y) for x, y in zip(begin, begin[1:])]
        self.sequence = np.concatenate([np.arange(n) for n in self.running])
        # The line before each line but the first ones.
        self.before = np.concatenate([np.arange(x, x + n) for x, n in zip(begin, self.running[1:])] or [np.empty(0, int)])
        self.later = slice(self.running[0], begin[-1])

    def flat(self, parts: list[np.ndarray]) -> np.ndarray:
        picked = [parts[i] for i in self.order]
        return np.concatenate([np.array([p[at] for p in picked[:n]]) for at, n in enumerate(self.running)])


def _either(scores: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Log of the sum over labels of ``scores`` and the pair weights, per next label."""
    return np.logaddexp(scores[:, :1] + between[0], scores[:, 1:] + between[1])


def fit_field(
    sequences: list[np.ndarray], labels: list[np.ndarray], weigh: list[float], chained: bool = True
) -> np.ndarray:
    """Weights of the features, then of the four pairs of neighbours, by gradient ascent on
    the weighted conditional log-likelihood (forward-backward) with a small penalty.

    Pairs weigh nothing unless ``chained``.
    """
    lines = Ragged(sequences)
    x, y = lines.flat(sequences), lines.flat(labels).astype(int)
    size = x.shape[1]
    weight = np.array(weigh)[lines.order][lines.sequence]
    observed = np.append(
        x.T @ (weight * y),
        np.bincount(y[lines.before] * 2 + y[lines.later], weights=weight[lines.later], minlength=4),
    )
    theta, first, second = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    for step in range(1, STEPS + 1):
        between = theta[size:].reshape(2, 2)
        score = np.zeros((len(x), 2))
        score[:, CONTENT] = x @ theta[:size]
        forward, backward = score.copy(), np.zeros_like(score)
        for now, then in zip(lines.steps, lines.steps[1:]):
            running = then.stop - then.start
            forward[then] += _either(forward[now][:running], between)
        for now, then in zip(lines.steps[-2::-1], lines.steps[:0:-1]):
            backward[now.start : now.start + then.stop - then.start] = _either(score[then] + backward[then], between.T)
        whole = (forward + backward)[lines.steps[0]]
        norm = np.logaddexp(whole[:, 0], whole[:, 1])[lines.sequence]
        content = np.exp(forward[:, CONTENT] + backward[:, CONTENT] - norm)
        ways = forward[lines.before][:, :, None] + between + (score + backward)[lines.later][:, None, :]
        pairs = np.exp(ways - norm[lines.later][:, None, None])
        expected = np.append(x.T @ (weight * content), np.einsum("i,ijk->jk", weight[lines.later], pairs))
        gradient = (observed - expected) / weight.sum() - DECAY * theta
        gradient[size:] *= chained
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return theta


def learn_field(sequences: list[np.ndarray], good: list[bool]) -> np.ndarray | None:
    """Weights from windows of lines and the quality of their documents; None unless there are
    documents of both qualities."""
    if not any(good) or all(good):
        return None
    # Documents of both qualities together count alike.
    share = sum(good) / len(good)
    weigh = [0.5 / share if g else 0.5 / (1 - share) for g in good]
    labels = [np.full(len(s), int(g), np.int8) for s, g in zip(sequences, good, strict=True)]
    size = len(FEATURES)
    for chained in [False] + [True] * ROUNDS:
        theta = fit_field(sequences, labels, weigh, chained)
        scores = [s @ theta[:size] for s in sequences]
        for i, found in enumerate(viterbi(scores, theta[size:].reshape(2, 2))):
            if not good[i]:
                found[scores[i].argmin()] = BOILERPLATE
                labels[i] = found
    return fit_field(sequences, labels, weigh)


def _windows(lines: int):
    """From ``good, pick, text``: features of a window of lines, at a place picked by a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, features = [], []
            for is_good, pick, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                measured = Measured(text).features
                begin = pick % (max(len(measured) - lines, 0) + 1)
                good.append(is_good)
                features.append(measured[begin : begin + lines].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(good, pa.bool_()), pa.array(features, pa.binary())], names=["good", "features"]
            )

    return run


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    good, sequences = [], []
    for batch in batches:
        good += batch.column(0).to_pylist()
        sequences += [np.frombuffer(x).reshape(-1, len(FEATURES)) for x in batch.column(1).to_pylist()]
    theta = learn_field(sequences, good)
    found = [] if theta is None else [theta.tolist()]
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64()))], names=["theta"])


def train_labeller(
    docs: DataFrame, labels: DataFrame, per_class: int = DOCUMENTS_PER_CLASS, lines: int = LINES_PER_DOCUMENT
) -> list[float] | None:
    """The weights of the field, learned from documents of labelled ``quality``.

    The sample has the ``per_class`` documents of each quality with the smallest hash of their
    id and of each at most ``lines`` lines in a row, so its size is bounded whatever the
    tables hold; it is fitted in one task. A document with both labels is a bad one, of several
    texts of one id the least counts. None without documents of both qualities.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_quality"))
    known = known.where("_id IS NOT NULL AND _quality IN (0, 1)").distinct()
    picked = [known.where(f"_quality = {q}").orderBy(F.xxhash64("_id"), "_id").limit(per_class) for q in (0, 1)]
    sample = picked[0].unionByName(picked[1]).groupBy("_id").agg((F.min("_quality") == 1).alias("good"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    chosen = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    single = chosen.groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    windows = single.select("good", pick.alias("pick"), "text").mapInArrow(_windows(lines), "good boolean, features binary")
    # Sorted, since sums of doubles depend on the order.
    bounded = staged(windows, "line-windows").coalesce(1).sortWithinPartitions("good", "features")
    fitted = staged(bounded.mapInArrow(_fit, "theta array<double>"), "line-field")
    found = fitted.first()
    return None if found is None else list(found.theta)


def _measured(batch: pa.RecordBatch, column: int) -> Iterator[tuple[slice, list[Measured]]]:
    """Texts of a batch, as many at a time as have some megabytes."""
    texts = batch.column(column).to_pylist()
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= BYTES_AT_ONCE or i + 1 == len(texts):
            yield slice(begin, i + 1), [Measured(x) for x in texts[begin : i + 1]]
            begin, size = i + 1, 0


def _labels(measured: list[Measured], theta: np.ndarray | None) -> list[np.ndarray]:
    if theta is None:
        return [np.ones(len(m.lines), np.int8) for m in measured]
    size = len(FEATURES)
    return viterbi([m.features @ theta[:size] for m in measured], theta[size:].reshape(2, 2))


JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "content_words long, base_failed boolean, kept boolean"
)


def judge_documents(docs: DataFrame, theta: list[float] | None, least_content: float = LEAST_CONTENT) -> DataFrame:
    """Base counts of each document, its words in lines of content, and whether it is kept.

    ``base_failed`` with fewer than 50 words or more than half of them in windows of three words
    that the text repeats. Kept is what has not failed and has at least ``least_content`` of
    its words in lines labelled content. Without weights (``theta`` null) all lines are content.

    One row per row: repeated rows and null ids are judged like others. A null text is empty;
    an empty text has no words and fails. Texts of any length are read whole. Other columns
    are not looked at; an empty table gives an empty result. There is no shuffle.
    """
    weights = None if theta is None else np.array(theta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, measured in _measured(batch, 1):
                rows = []
                for m, labels in zip(measured, _labels(measured, weights), strict=True):
                    n, *_, repeated = m.base
                    content = sum(len(words) for words, label in zip(m.lines, labels.tolist(), strict=True) if label)
                    failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
                    rows.append((*m.base, content, failed, not failed and content >= least_content * n))
                columns = zip(*rows, strict=True)
                kinds = [pa.int64()] * 6 + [pa.bool_()] * 2
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part.start : part.stop]]
                    + [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                    names=[x.split()[0] for x in JUDGED.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, JUDGED)


def label_lines(docs: DataFrame, theta: list[float] | None) -> DataFrame:
    """``doc_id, line, text, content``: every line of every text, numbered from 0, with its label.

    Nulls, repeats and other columns as in :func:`judge_documents`; a null text is one empty line.
    """
    weights = None if theta is None else np.array(theta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part, measured in _measured(batch, 1):
                for doc_id, m, labels in zip(ids[part], measured, _labels(measured, weights), strict=True):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([doc_id] * len(m.lines), pa.int64()),
                            pa.array(range(len(m.lines)), pa.int64()),
                            pa.array(m.raw_lines, pa.string()),
                            pa.array(labels == CONTENT, pa.bool_()),
                        ],
                        names=["doc_id", "line", "text", "content"],
                    )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, line long, text string, content boolean")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`judge_documents` by a field trained on the labelled documents; its rules for nulls,
    repeats and other columns hold here, those of labels are in :func:`train_labeller`."""
    return judge_documents(docs, train_labeller(docs, labels))
