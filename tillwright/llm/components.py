"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import staged

# So many links, 16 MB, are taken through one task instead of several rounds of joins.
IN_ONE_TASK = 1_000_000
# A side of a join is broadcast only if it has at most so many rows.
BROADCAST_ROWS = 500_000
ROWS_PER_FILE = 250_000


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent[x]) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(parent.setdefault(a, a)), find(parent.setdefault(b, b))
            parent[max(a, b)] = min(a, b)
    ids = list(parent)
    for at in range(0, len(ids), 10_000):
        part = ids[at : at + 10_000]
        columns = [pa.array(part, pa.int64()), pa.array(map(find, part), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "component_id"])


def _state(edges: DataFrame) -> tuple[int, int]:
    got = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
    ).first()
    return got["n"], got["x"] or 0


def components(links: DataFrame, native: bool = False) -> DataFrame:
    """``id, component_id`` of every id in ``links(a, b)``: the smallest reachable id.

    Links with a null end and loops count for nothing. A counted table of few links is
    solved in one task, unless ``native`` asks for DataFrame functions alone. Otherwise
    each round hangs the larger neighbours of an id on its smallest neighbour, then the
    smaller ones; minima are combined before the shuffle and joined back, so no list of
    neighbours is gathered, and a hub is an ordinary hot join key. Rounds grow with the
    logarithm of a component's diameter. Every round ends in a table in the shared folder.
    """

    def table(rows: DataFrame, most: int | None) -> DataFrame:
        if most is not None and most < 8 * ROWS_PER_FILE:
            rows = rows.coalesce(1 + most // ROWS_PER_FILE)
        return staged(rows, "links")

    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = table(edges.distinct(), None)
    before = _state(edges)
    if not native and before[0] <= IN_ONE_TASK:
        return edges.coalesce(1).mapInArrow(_in_one_task, "id long, component_id long")
    while before[0]:
        count = before[0]
        side = F.broadcast if count <= BROADCAST_ROWS else lambda x: x
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        # A row of ``both`` goes to its larger end, and each id hangs on its own minimum.
        large = both.where("b > a").select("b", "a").union(edges.select("a", "a").distinct())
        large = large.toDF("id", "a").join(side(least), "a").select("id", "m").where("id <> m")
        large = table(large.toDF("a", "b").distinct(), 2 * count)
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(side(below), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = table(small.where("a <> b").union(below).distinct(), 2 * count)
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(roots)
