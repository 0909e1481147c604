"""Carrying the last heading forward over rows in document order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tillwright.operators.skew import MIN_HOT_ROWS, last_value_in_groups


def fill_forward(
    rows: DataFrame, column: str, group: Sequence[str], order: str, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """``column`` with nulls replaced by the last value before them in their group.

    For rows that are spread over a table, such as headings and cards exported
    line by line; one export of any length may be a group.
    """
    return last_value_in_groups(rows, group, order, column, min_hot_rows)
