"""State per key, kept in levels of runs.

A batch adds one run to level 0 of each of its tables. When a level has gathered ``FANOUT``
runs, the next batch merges them into one run of the level above, sorted by key. A table
of n batches so consists of at most ``FANOUT`` runs on each of log n levels, and a row is
rewritten once a level. All tables of a batch are published in one manifest: they change
together, and a batch that is run again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwright.operators.snapshots import latest_per_key
from tillwright.sinks.manifest import fresh_folder, latest, publish

FANOUT = 8
STATE = "state"
Merge = Callable[[DataFrame], DataFrame]


class Changes(NamedTuple):
    """What a batch adds to a table, how rows of several runs become one, and the columns that
    merged runs are sorted by and runs are partitioned by."""

    rows: DataFrame
    merge: Merge | None = None
    keys: Sequence[str] = ()
    partition: str | None = None


def newest(keys: Sequence[str]) -> Merge:
    """Merging by the row of the last batch that changed a key."""
    return lambda rows: latest_per_key(rows, "batch_id", keys)


def _write(rows: DataFrame, path: str, change: Changes) -> dict:
    folder = fresh_folder()
    writer = rows.write
    held = []
    if change.partition:
        writer = writer.partitionBy(change.partition)
        # The values of a partition column, such as days, are few whatever the rows.
        held = sorted(r[0] for r in rows.select(change.partition).distinct().collect())
    writer.parquet(f"{path}/{folder}")
    return {"folder": folder, "held": held}


def _merged(spark: SparkSession, path: str, runs: list[dict], change: Changes) -> list[dict]:
    """The runs of a table with every full level merged into the one above."""
    level = 0
    while change.merge and any(run["level"] >= level for run in runs):
        full = [run for run in runs if run["level"] == level]
        if len(full) >= FANOUT:
            rows = change.merge(_of_runs(spark, path, full))
            if change.keys:
                rows = rows.hint("rebalance", *change.keys).sortWithinPartitions(*change.keys)
            run = {"level": level + 1, "first": full[0]["first"], **_write(rows, path, change)}
            runs = [r for r in runs if r["level"] > level] + [run] + [r for r in runs if r["level"] < level]
        level += 1
    return runs


def put(spark: SparkSession, path: str, batch_id: int, changes: dict[str, Changes]) -> None:
    """Publish a batch of changes of some tables together."""
    before = latest(spark, path)
    tables = dict(before.content) if before else {}
    for name, change in changes.items():
        # The last batch is always a run of its own, so that it can be replaced.
        runs = [run for run in tables.get(name, []) if run["first"] < batch_id]
        runs = _merged(spark, path, runs, change)
        rows = change.rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
        tables[name] = [*runs, {"level": 0, "first": batch_id, **_write(rows, path, change)}]
    publish(spark, path, tables, [run["folder"] for runs in tables.values() for run in runs], before)


def put_batch(changed: DataFrame, path: str, batch_id: int, keys: Sequence[str] = ()) -> None:
    """Publish changed rows; runs are merged by the newest row per key if keys are given."""
    put(changed.sparkSession, path, batch_id, {STATE: Changes(changed, newest(keys) if keys else None, keys)})


def _of_runs(spark: SparkSession, path: str, runs: list[dict]) -> DataFrame:
    frames = [spark.read.parquet(f"{path}/{run['folder']}") for run in runs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def runs_of(spark: SparkSession, path: str, table: str = STATE) -> list[dict]:
    """The runs of a table, the oldest first."""
    found = latest(spark, path)
    return [] if found is None else found.content.get(table, [])


def read_runs(
    spark: SparkSession, path: str, table: str, before: int | None = None, partition: str | None = None, values: Sequence = ()
) -> DataFrame | None:
    """All rows of the runs of a table, None without any; of batches before ``before`` and of
    some values of the partition column, if given, of which only those folders are listed."""
    runs = [r for r in runs_of(spark, path, table) if before is None or r["first"] < before]
    if partition is None:
        return _of_runs(spark, path, runs) if runs else None
    frames = [
        spark.read.option("basePath", f"{path}/{run['folder']}").parquet(*folders)
        for run in runs
        if (folders := [f"{path}/{run['folder']}/{partition}={v}" for v in values if v in run["held"]])
    ]
    return reduce(DataFrame.unionByName, frames) if frames else None


def read_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    return newest(keys)(read_runs(spark, path, STATE)).drop("batch_id")


def compact(spark: SparkSession, path: str, keys: Sequence[str], target: str) -> None:
    """Write the state as the first batch of a new table, for a stream that goes on there."""
    put_batch(read_state(spark, path, keys), target, -1)
