"""Line labels and base counts of documents against plain versions."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwright.llm.line_labels import (
    FEATURES, Measured, fit_field, judge_documents, label_lines, learn_field, quality_report, train_labeller, viterbi,
)
from tillwright.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {i + j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


ODD = [
    None, "", " ", "\n\n", "a b c a b c", "a a a a", "x\x1cy\xa0z w", "one\ntwo\none\n \n \none", "é ü ñ #*$%&|<> |",
    "line\r\nline\r\n", "word " * 60, "\x85 \x0b\x0c t", "a\tb\tc\ta\tb\tc\td",
]


def test_base_counts_of_odd_texts(spark):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("ab \n\t#.") for _ in range(rng.randrange(300))) for _ in range(150)]
    texts += ["kept words follow here one by one " * 30_000, ODD[4]]
    rows = [(i if i != 3 else None, t, "c", 1) for i, t in enumerate(texts)]
    judged = judge_documents(spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int"), None)
    found = sorted((tuple(r) for r in judged.select("doc_id", *BASE, "base_failed", "kept").collect()), key=repr)
    expected = []
    for i, text, *_ in rows:
        counts = base(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        expected.append((i, *counts, failed, not failed))
    assert found == sorted(expected, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_equals_every_labelling(seed):
    rng = np.random.default_rng(seed)
    between = rng.normal(size=(2, 2))
    scores = [rng.normal(size=n) * 2 for n in (3, 1, 7, 5, 1, 7, 2)]
    for score, labels in zip(scores, viterbi(scores, between), strict=True):
        value = lambda y: sum(s for s, a in zip(score, y) if a) + sum(between[a, b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=len(score)), key=value)
        assert tuple(labels.tolist()) == best


def likelihood(theta, sequences, labels, weigh):
    """Mean log-likelihood with the penalty, by every labelling."""
    total = count = 0.0
    for x, y, w in zip(sequences, labels, weigh, strict=True):
        value = lambda z: sum(x[i] @ theta[:-4] for i, a in enumerate(z) if a) + sum(theta[-4:][2 * a + b] for a, b in zip(z, z[1:]))  # noqa: B023, E731
        total += w * (value(y) - np.log(sum(np.exp(value(z)) for z in itertools.product((0, 1), repeat=len(x)))))
        count += w * len(x)
    return total / count - 1e-4 * (theta**2).sum()


def test_training_finds_the_top_of_the_likelihood():
    rng = np.random.default_rng(1)
    sequences = [np.column_stack([np.ones(n), rng.normal(size=n)]) for n in (4, 2, 1, 5, 3, 6, 2, 4, 5, 3)]
    labels = [(s[:, 1] + 2 * rng.normal(size=len(s)) > 0).astype(np.int8) for s in sequences]
    weigh = [1.0, 2.0, 1.0, 0.5, 1.0] * 2
    theta = fit_field(sequences, labels, weigh)
    top = likelihood(theta, sequences, labels, weigh)
    for i in range(len(theta)):
        for step in (-0.3, 0.3):
            assert likelihood(theta + step * (np.arange(len(theta)) == i), sequences, labels, weigh) < top


def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    theta = train_labeller(docs, labels.where(~held))
    judged = judge_documents(docs.where(held), theta).where("NOT base_failed").join(labels, "doc_id")
    share = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.98 and share[0] <= 0.1, share


def test_junk_lines_between_ordinary_ones_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    theta = train_labeller(docs, labels)
    good = ["The ansoning of the tion and therble. On the hethere.", "In reth that was erhent, for an ouly.", "Oning the st. By whed."]
    more = ["Ands of reoning by the therer in it.", "With the onst that ereth, in an ouning.", "Is tionly for reds."]
    bad = ["$$$ ha*** ha*** HA!! ha*** ha*** || ha*** %%% ha*** ||| $$$", "st*** ST!! st*** | ou%%% ou%%% || $$$", "&&& re### re### | | re***"]
    text = "\n".join(good + bad + more)
    rows = label_lines(spark.createDataFrame([(1, text, True), (2, None, False)], "doc_id long, text string, content boolean"), theta)
    found = [r.content for r in rows.where("doc_id = 1").orderBy("line").collect()]
    assert found == [True] * 3 + [False] * 3 + [True] * 3
    assert [r.text for r in rows.where("doc_id = 2").collect()] == [""]


def test_the_query_counts_whole_texts(spark):
    rows = QUERIES["op12_line_labels"](spark, FOLDER)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = {r.doc_id: r for r in rows.collect()}
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        row, counts = found[doc_id], base(text)
        assert tuple(row[name] for name in BASE) == counts
        assert row.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert row.kept == (not row.base_failed and row.content_words >= 0.5 * row.n_words)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (None, 0), (2, 0)]])
def test_without_both_qualities_all_lines_are_content(spark, labels):
    docs = spark.createDataFrame([(1, "some words in a row " * 20 + str(list(range(60)))), (2, None)], "doc_id long, text string")
    rows = quality_report(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert [(r.doc_id, r.content_words == r.n_words) for r in rows.orderBy("doc_id").collect()] == [(1, True), (2, True)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality_report(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_repeated_rows_and_conflicting_labels_bound_the_sample(spark):
    docs = spark.createDataFrame([(1, "Good words. They stand here.\nAnd here."), (2, "## ##\n$$ $$")] * 30, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, 1)], "doc_id long, quality int")
    theta = train_labeller(docs, labels, per_class=3)
    assert theta is not None and len(theta) == len(FEATURES) + 4


def test_learning_needs_both_classes():
    assert learn_field([Measured("a b").features], [True]) is None
