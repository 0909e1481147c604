"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors are put into grid cells of width epsilon on their leading principal axes and
sorted by the cells; the sorted sequence is cut into blocks. Two blocks meet only if the
boxes around their projections come within epsilon, and inside such a pair both intervals
are halved again and again as long as their boxes do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import Forest, staged, vector_groups
from tillwright.llm.components import components

AXES = 8
FIT_ROWS = 2048
ROWS_PER_BLOCK = 1024
LEAF = 128

POINTS = "rep long, copies long, label string, dim int, cells array<int>, unit binary"
BLOCKS = (
    "block long, label string, dim int, low array<double>, high array<double>, "
    "reps binary, copies binary, units binary"
)


def _principal_axes(classes: DataFrame, axes: int, fit_rows: int) -> dict[int, np.ndarray]:
    """The leading principal axes by length of vector, from at most ``fit_rows`` vectors.

    The axes decide how well the order prunes, never which pairs are found.
    """
    picked = classes.select("rep", "vector").orderBy(F.xxhash64("rep"), "rep").limit(fit_rows)
    by_dim: dict[int, list] = {}
    for row in picked.collect():
        by_dim.setdefault(len(row["vector"]), []).append(row["vector"])
    found = {}
    for dim, rows in by_dim.items():
        unit = np.array(rows, np.float64)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        _, turn = np.linalg.eigh(np.cov(unit.T, bias=True).reshape(dim, dim))
        found[dim] = np.ascontiguousarray(turn[:, ::-1][:, :axes])
    return found


def _axes_for(axes: dict[int, np.ndarray], dim: int, count: int) -> np.ndarray:
    return axes[dim] if dim in axes else np.eye(dim, min(dim, count))


def _place(axes: dict[int, np.ndarray], count: int, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in vector_groups(batch.column(3)):
                # Scaling by the largest component first keeps tiny and huge vectors exact.
                matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
                unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
                cells = np.zeros((len(rows), count), np.int32)
                at = unit @ _axes_for(axes, matrix.shape[1], count)
                cells[:, : at.shape[1]] = np.floor(at / width)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        batch.column(2).take(take),
                        pa.array(np.full(len(rows), matrix.shape[1], np.int32)),
                        pa.array(list(cells), pa.list_(pa.int32())),
                        pa.array([u.tobytes() for u in unit], pa.binary()),
                    ],
                    names=["rep", "copies", "label", "dim", "cells", "unit"],
                )

    return run


def _cut(axes: dict[int, np.ndarray], count: int, size: int):
    """Consecutive rows of one label and length as blocks of at most ``size`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        key, reps, copies, units = None, [], [], []

        def block() -> pa.RecordBatch:
            nonlocal number
            number += 1
            label, dim = key
            matrix = np.frombuffer(b"".join(units)).reshape(-1, dim)
            at = matrix @ _axes_for(axes, dim, count)
            low, high = np.zeros(count), np.zeros(count)
            low[: at.shape[1]], high[: at.shape[1]] = at.min(axis=0), at.max(axis=0)
            doubles = pa.list_(pa.float64())
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([label], pa.string()),
                    pa.array([dim], pa.int32()),
                    pa.array([low], doubles),
                    pa.array([high], doubles),
                    pa.array([np.array(reps, np.int64).tobytes()], pa.binary()),
                    pa.array([np.array(copies, np.int64).tobytes()], pa.binary()),
                    pa.array([matrix.tobytes()], pa.binary()),
                ],
                names=[part.split()[0] for part in BLOCKS.split(", ")],
            )
            reps.clear(), copies.clear(), units.clear()
            return made

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5)]
            for rep, n, label, dim, unit in zip(*columns, strict=True):
                if reps and (len(reps) >= size or key != (label, dim)):
                    yield block()
                key = (label, dim)
                reps.append(rep), copies.append(n), units.append(unit)
        if reps:
            yield block()

    return run


def _meet(axes: dict[int, np.ndarray], count: int, width: float, threshold: float):
    """Weighted counts of links and a spanning forest of the links of two blocks."""

    def join(a, b, same: bool):
        reach = width * (1 + 1e-9) + 1e-12
        turn = _axes_for(axes, a.shape[1], count)
        at_a, at_b = a @ turn, b @ turn

        def near(i, j):
            x, y = at_a[i], at_b[j]
            gap = np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0))
            return (gap <= reach).all()

        todo = [(slice(0, len(a)), slice(0, len(b)))]
        while todo:
            i, j = todo.pop()
            rows, columns = i.stop - i.start, j.stop - j.start
            if not near(i, j):
                continue
            if rows <= LEAF and columns <= LEAF:
                linked = a[i] @ b[j].T >= threshold
                if same:
                    linked &= np.arange(i.start, i.stop)[:, None] != np.arange(j.start, j.stop)
                if linked.any():
                    yield i, j, linked
            elif rows >= columns:
                middle = i.start + rows // 2
                todo += [(slice(i.start, middle), j), (slice(middle, i.stop), j)]
            else:
                middle = j.start + columns // 2
                todo += [(i, slice(j.start, middle)), (i, slice(middle, j.stop))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim, same = row["dim"], row["a"] == row["b"]
                units = [np.frombuffer(row[x]).reshape(-1, dim) for x in ("units_a", "units_b")]
                reps = [np.frombuffer(row[x], np.int64) for x in ("reps_a", "reps_b")]
                copies = [np.frombuffer(row[x], np.int64) for x in ("copies_a", "copies_b")]
                links = [np.zeros(len(x), np.int64) for x in reps]
                shift = 0 if same else len(reps[0])
                forest = Forest(shift + len(reps[1]))
                edges = []
                for i, j, linked in join(*units, same):
                    links[0][i] += linked @ copies[1][j]
                    if not same:
                        links[1][j] += copies[0][i] @ linked
                    # Smallest label over the links, until nothing changes: one edge for
                    # each row instead of one for each pair.
                    rows, columns = np.arange(i.start, i.stop), shift + np.arange(j.start, j.stop)
                    first = np.where(linked.any(axis=1), rows, forest_end := 2 * len(forest.parent))
                    while True:
                        down = np.where(linked, first[:, None], forest_end).min(axis=0)
                        back = np.minimum(first, np.where(linked, down, forest_end).min(axis=1))
                        if (back == first).all():
                            break
                        first = back
                    for members, roots in ((rows, first), (columns, down)):
                        for x, y in zip(members.tolist(), roots.tolist(), strict=True):
                            if y != forest_end and forest.union(x, y):
                                edges.append((x, y))
                names = np.concatenate(reps) if shift else reps[0]
                counted = [(r[n > 0], n[n > 0]) for r, n in zip(reps, links, strict=True)]
                ids = np.concatenate([c[0] for c in counted] + [names[[e[0] for e in edges]]] if edges else [c[0] for c in counted])
                n = np.concatenate([c[1] for c in counted] + [np.zeros(len(edges), np.int64)])
                other = [None] * (len(n) - len(edges)) + names[[e[1] for e in edges]].tolist() if edges else [None] * len(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(other, pa.int64())],
                    names=["id", "links", "other"],
                )

    return run


def near_duplicate_vectors(
    df: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    axes: int = AXES,
    fit_rows: int = FIT_ROWS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Two vectors link if their labels are equal and not null, their lengths are equal and
    their cosine is at least ``threshold`` (over 0). Null, empty and zero vectors, vectors
    with null or non-finite components and rows with a null id link with nothing; such a
    row is its own component. Equal vectors of a label are joined once, with the number of
    their ids as weight. A repeated row counts once and comes back as often as it came in.
    An empty table gives an empty result.

    The sequence is cut by range of label, cells and id, so that a label or a cell with any
    share of the rows is spread over many blocks. Each pair of blocks returns counts and a
    spanning forest, never its pairs.
    """
    width = float(np.sqrt(2 - 2 * threshold))
    rows = df.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).alias("vector"),
        F.col(label_col).cast("string").alias("label"),
    )
    usable = (
        "vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL"
        " AND forall(vector, x -> x IS NOT NULL AND abs(x) < double('infinity'))"
        " AND exists(vector, x -> x <> 0)"
    )
    valid = rows.where(usable)
    classes = (
        valid.distinct()
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    )
    classes = staged(classes.select("rep", "copies", "label", "vector"), "vector-classes")
    turn = _principal_axes(classes, axes, fit_rows)
    points = classes.mapInArrow(_place(turn, axes, width), POINTS)
    order = ["label", "dim", *[F.col("cells")[i] for i in range(axes)], "rep"]
    ordered = points.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = staged(ordered.mapInArrow(_cut(turn, axes, rows_per_block), BLOCKS), "grid-blocks")

    strip = lambda x: F.floor(x / width).cast("int")
    boxes = blocks.select("block", "label", "dim", "low", "high")
    wide = boxes.select(
        F.col("block").alias("a"), "label", "dim", F.col("low").alias("low_a"), F.col("high").alias("high_a"),
        strip(F.col("low")[0] - 1.001 * width).alias("first_a"), strip(F.col("high")[0] + 1.001 * width).alias("last_a"),
    ).withColumn("strip", F.explode(F.sequence("first_a", "last_a")))
    narrow = boxes.select(
        F.col("block").alias("b"), "label", "dim", F.col("low").alias("low_b"), F.col("high").alias("high_b"),
        strip(F.col("low")[0]).alias("first_b"), strip(F.col("high")[0]).alias("last_b"),
    ).withColumn("strip", F.explode(F.sequence("first_b", "last_b")))
    close = (F.col("a") <= F.col("b")) & (F.col("strip") == F.greatest("first_a", "first_b"))
    for i in range(axes):
        gap = F.greatest(F.col("low_a")[i] - F.col("high_b")[i], F.col("low_b")[i] - F.col("high_a")[i])
        close &= gap <= width * 1.001
    pairs = wide.join(narrow, ["label", "dim", "strip"]).where(close).select("a", "b")
    side = lambda x: blocks.select(
        F.col("block").alias(x), *([] if x == "b" else ["dim"]),
        *[F.col(c).alias(f"{c}_{x}") for c in ("reps", "copies", "units")],
    )
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    met = met.mapInArrow(_meet(turn, axes, width, threshold), "id long, links long, other long")
    met = staged(met, "grid-links")

    counted = met.where("other IS NULL").groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(met.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    per_class = (
        classes.select("rep", "copies", "label", "vector")
        .join(counted.withColumnRenamed("id", "rep"), "rep", "left")
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "label", "vector",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    linked = valid.join(per_class, ["label", "vector"])
    alone = rows.where(f"coalesce(NOT ({usable}), true)")
    alone = alone.withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col("vec_id")})
    columns = ["vec_id", "n_links", "component_id"]
    return (
        linked.select(columns)
        .union(alone.select(columns))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
