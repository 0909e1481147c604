"""Choosing among cumulative snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tillwright.operators.ingest import ORDER_KEYS


def latest_per_key(
    rows: DataFrame, version: str = "snapshot_date", keys: Sequence[str] = ORDER_KEYS
) -> DataFrame:
    """The row of the newest version per key.

    The planner keeps one row per key and task before the shuffle, so a key that
    is repeated very often is no burden on the task that receives it.
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc(version))
    return rows.withColumn("_r", F.row_number().over(newest)).where("_r = 1").drop("_r")


def newest_rows(
    rows: DataFrame, version: str = "snapshot_date", keys: Sequence[str] = ORDER_KEYS
) -> DataFrame:
    """All rows of the newest version per key, for keys that have several rows in one."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(version))
    return rows.withColumn("_r", F.rank().over(newest)).where("_r = 1").drop("_r")
