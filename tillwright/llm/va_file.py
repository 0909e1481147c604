"""Exact top-k search by inner product over vector-approximation blocks.

Every block of rows keeps a coarse copy of its vectors: each component as the number of
one of 64 equal cells between the smallest and the largest value of the block. For a
query, the cell centres bound all inner products from above and below at once; exact
vectors are read in the order of the bounds until no unread row can enter the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import staged, vector_groups

CELLS = 64
ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 2048
READ_AT_ONCE = 64

BLOCK = "block long, dim int, ids binary, cells binary, low binary, step binary, exact binary"
FOUND = "query_id long, vec_id long, score long"


def _pack(scale: int, rows_per_block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal number
            parts = waiting.pop(dim)
            ids = np.concatenate([p[0] for p in parts])
            exact = np.concatenate([p[1] for p in parts])
            low, high = exact.min(axis=0), exact.max(axis=0)
            step = np.maximum((high - low) / CELLS, 1e-300)
            cells = np.minimum((exact - low) / step, CELLS - 1).astype(np.uint8)
            number += 1
            payload = [ids, cells, low, step, exact]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([dim], pa.int32())]
                + [pa.array([x.tobytes()], pa.binary()) for x in payload],
                names=["block", "dim", "ids", "cells", "low", "step", "exact"],
            )

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for rows, matrix in vector_groups(batch.column(1)):
                whole = np.floor(matrix * scale)
                for at in range(0, len(rows), rows_per_block):
                    part = slice(at, at + rows_per_block)
                    kept = waiting.setdefault(matrix.shape[1], [])
                    kept.append((ids[rows[part]].astype(np.int64), whole[part]))
                    if sum(len(p[0]) for p in kept) >= rows_per_block:
                        yield block(matrix.shape[1])
        for dim in list(waiting):
            yield block(dim)

    return run


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact at any size."""
    reach = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * rows.shape[1]
    if reach < 2**53:
        return (rows @ queries).astype(np.int64)
    exact = [sum(int(x) * int(y) for x, y in zip(row, queries, strict=True)) for row in rows]
    return np.array(exact, dtype=object)


def _best(query, query_id, ids, upper, exact, k, floor):
    """Ids and scores of the rows that may be among the k best; ``floor`` is a score that
    k other rows reach already."""
    order = np.argsort(-upper, kind="stable")
    got_ids, got = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(order), READ_AT_ONCE):
        if floor is not None and upper[order[at]] < floor:
            break
        rows = order[at : at + READ_AT_ONCE]
        rows = rows[ids[rows] != query_id]
        if len(rows):
            got = np.concatenate((got, _products(query, exact[rows])))
            got_ids = np.concatenate((got_ids, ids[rows]))
            keep = np.lexsort((got_ids, -got))[:k]
            got, got_ids = got[keep], got_ids[keep]
            if len(got) == k and (floor is None or got[-1] > floor):
                floor = got[-1]
    return got_ids, got, floor


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[int, object] = {}
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                read = lambda name, kind=np.float64: np.frombuffer(row[name], kind)
                ids, low, step = read("ids", np.int64), read("low"), read("step")
                exact = read("exact").reshape(-1, dim)
                cells = read("cells", np.uint8).reshape(-1, dim)
                centres = low + (cells + 0.5) * step
                query_ids = read("query_ids", np.int64)
                queries = read("queries").reshape(-1, dim)
                # Rounding is far below the slack of one part in a million.
                half = np.abs(queries) @ (step * 0.5)
                slack = 1 + 1e-6 * (np.abs(queries) @ np.abs(centres).max(axis=0, initial=0))
                out_query, out_ids, out_score = [], [], []
                for i, query_id in enumerate(query_ids.tolist()):
                    upper = centres @ queries[i] + half[i] + slack[i]
                    near, score, floors[query_id] = _best(
                        queries[i], query_id, ids, upper, exact, k, floors.get(query_id)
                    )
                    out_query += [query_id] * len(near)
                    out_ids += near.tolist()
                    out_score += score.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (out_query, out_ids, out_score)],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def exact_top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    rows_per_block: int = ROWS_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k rows nearest to each query row.

    Components become ``floor(scale * x)`` and the score is their integer inner product.
    A query's own id is no candidate; ties go to the smaller id. Vectors that are null or
    empty or hold null or non-finite components, and rows with a null id, take no part;
    vectors meet only vectors of their length. A repeated row of one id and vector counts
    once. An empty table gives an empty result.

    Each partition of blocks of rows meets each partition of blocks of queries where it is
    read, so no vector is broadcast or shuffled again; a task holds one partition of
    queries and streams its blocks by. The best k of each pair of blocks are combined by a
    window that is cut before its shuffle.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("q")
    ).where("id IS NOT NULL AND vector IS NOT NULL")
    rows = rows.dropDuplicates(["id", "vector"])
    blocks = staged(rows.select("id", "vector").mapInArrow(_pack(scale, rows_per_block), BLOCK), "va-file")
    asked = rows.where("q").select("id", "vector")
    asked = staged(asked.mapInArrow(_pack(scale, queries_per_block), BLOCK), "va-queries")
    asked = asked.select("dim", F.col("ids").alias("query_ids"), F.col("exact").alias("queries"))
    # Every partition of blocks reads every partition of queries, each as it lies on disk.
    pairs = blocks.join(asked.hint("shuffle_replicate_nl"), "dim")
    found = pairs.mapInArrow(_search(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
