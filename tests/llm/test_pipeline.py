"""The registered queries and the pipeline on the smallest sample tables."""

from __future__ import annotations

import os
import random

import duckdb
import pytest

import corpus_pipeline
from tillwright.llm.common import table
from tillwright.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for source in ("embeddings", "pages", "documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {source} AS SELECT * FROM '{FOLDER}/{source}.parquet'").fetchall()
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(map(repr, map(tuple, df.select(*columns).collect())))
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert got == sorted(map(repr, want))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_return_every_document(spark, name):
    documents = {row.doc_id for row in table(spark, FOLDER, "documents").select("doc_id").collect()}
    found = {row.doc_id for row in QUERIES[name](spark, FOLDER).select("doc_id").collect()}
    assert found == documents or name == "op6_line_dedup" and found < documents


def rewrapped(spark, docs):
    """Two documents of the same words in lines of other lengths: no line of one is near a
    line of the other, so only the n-gram join can tell that they are copies."""
    longest = docs.where("lang = 'en'").orderBy("n_chars").tail(1)[0].text
    words = longest.split()[:400]
    random.Random(9).shuffle(words)
    texts = ["\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n)) for n in (9, 13)]
    rows = [(900_001 + i, text, "en", "planted", len(text)) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, docs.schema)


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, FOLDER, "documents")
    # On this small table line dedup leaves no near copies behind; these are some that it must.
    docs = docs.unionByName(rewrapped(spark, docs))
    before = {row.doc_id for row in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert (kept.columns, kept.dtypes) == (docs.columns, docs.dtypes)
        after = {row.doc_id for row in kept.select("doc_id").collect()}
        assert after < before and len(after) > len(before) // 2, name
        docs, before = kept, after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {row.doc_id for row in pieces.select("doc_id").collect()} == before
    assert {900_001, 900_002} & before == {900_001}
    assert {row.doc_id for row in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()} == before - {900_001}


def test_stages_take_empty_and_odd_documents(spark):
    text = "a line of words that both of these documents have in full"
    rows = [(1, text, "en", None, 3), (2, None, None, "s", None), (3, "", "x", "s", 0), (None, text, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows_in in ([], rows, [*rows, rows[0]]):
        docs = spark.createDataFrame(rows_in, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
        assert len({row.doc_id for row in docs.collect()}) == (4 if rows_in else 0)
