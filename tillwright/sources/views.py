"""Tables by name, for ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame


def name_tables(**tables: DataFrame) -> None:
    """Make each frame a temporary view, so that ``spark.sql`` can ask for it."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
