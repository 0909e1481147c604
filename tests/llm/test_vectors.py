"""Grid join and approximation-file search against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwright.llm.grid_join import near_duplicate_vectors
from tillwright.llm.va_file import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, label int, block int, dim string"


def rows_of(seed: int, count: int, dims: int = 6):
    """Clusters, copies, scaled copies, and every kind of unusable vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    rows = []
    for i in range(count):
        vector = centres[rng.integers(5)] + rng.normal(size=dims) * rng.choice([0.01, 0.1, 1.0])
        rows.append((i, [float(np.float32(x)) for x in vector], int(rng.integers(2)), 1, "x"))
    rows += [(count + i, [2 * x for x in rows[i][1]], rows[i][2], 1, "x") for i in range(10)]
    rows += [(count + 20 + i, rows[0][1], rows[0][2], 1, None) for i in range(30)]
    odd = [None, [], [0.0] * dims, [math.nan] * dims, [math.inf] + [1.0] * (dims - 1), [None] + [1.0] * (dims - 1), [1.0, 2.0]]
    rows += [(count + 100 + i, vector, 1, None, None) for i, vector in enumerate(odd)]
    rows += [(count + 200, rows[1][1], None, 1, "x"), (None, rows[1][1], rows[1][2], 1, "x")]
    return rows + [rows[3], rows[3]]


def usable(vector, zero: bool = False) -> bool:
    if not vector or any(x is None or not math.isfinite(x) for x in vector):
        return False
    return zero or any(vector)


def brute_links(rows, threshold):
    good = {(i, tuple(v), label) for i, v, label, *_ in rows if i is not None and label is not None and usable(v)}
    links = {}
    for i, v, label in good:
        for j, w, other in good:
            if i != j and label == other and len(v) == len(w):
                cosine = np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)
                if cosine >= threshold:
                    links.setdefault(i, set()).add(j)
    smallest = {i: i for i, *_ in rows if i is not None}
    changed = True
    while changed:
        changed = False
        for i, near in links.items():
            least = min(smallest[x] for x in near | {i})
            if least < smallest[i]:
                smallest[i], changed = least, True
    return links, smallest


@pytest.mark.parametrize("block", [16, 1024])
def test_grid_join_equals_brute_force(spark, block):
    rows = rows_of(1, 300)
    got = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA), 0.98, rows_per_block=block, axes=3).collect()
    links, smallest = brute_links(rows, 0.98)
    assert len(got) == len(rows)
    for row in got:
        if row.vec_id is None:
            assert (row.n_links, row.component_id, row.kept) == (0, None, True)
        else:
            want = (len(links.get(row.vec_id, ())), smallest[row.vec_id])
            assert (row.n_links, row.component_id) == want
            assert row.kept == (row.vec_id == want[1])


def test_grid_join_of_an_empty_table(spark):
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def brute_top(rows, k):
    vectors = {i: [math.floor(1024 * x) for x in v] for i, v, *_ in rows if i is not None and usable(v, zero=True)}
    found = []
    for q in sorted(i for i in vectors if i % 10 == 0):
        scored = [
            (-sum(x * y for x, y in zip(vectors[q], v, strict=True)), i)
            for i, v in vectors.items()
            if i != q and len(v) == len(vectors[q])
        ]
        found += [(q, n, i, -score) for n, (score, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("block", [8, 8192])
def test_search_equals_brute_force(spark, block):
    rows = rows_of(2, 150)
    df = spark.createDataFrame(rows, SCHEMA)
    got = exact_top_k(df, F.col("vec_id") % 10 == 0, 10, rows_per_block=block, queries_per_block=8)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 10)


def test_search_beyond_the_range_of_doubles(spark):
    rows = [(i, [float(2**20 + i), float(2**20 - i)], 0, 0, "") for i in range(12)]
    got = exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, 3).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, 3)


def test_search_with_fewer_rows_than_asked_for_and_none(spark):
    one = spark.createDataFrame([(0, [1.0], 0, 0, ""), (1, [2.0], 0, 0, "")], SCHEMA)
    assert list(map(tuple, exact_top_k(one, F.lit(True), 10).collect())) != []
    assert exact_top_k(spark.createDataFrame([], SCHEMA), F.lit(True), 10).collect() == []


def test_search_sends_no_vector_to_the_driver_or_to_a_salt(spark):
    rows = rows_of(3, 60)
    got = exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, 10, rows_per_block=8, queries_per_block=8)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan
    assert "Broadcast" not in plan and "Generate" not in plan
