"""Date keys, month buckets, age tests and epoch conversions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

STAMP_FORMAT = "yyyyMMdd_HHmmss"
SNAPSHOT_FORMAT = "%Y_%m_%d"


def instant(df: DataFrame, column: str, value: datetime | None) -> Column:
    """``value`` as a literal of the column's own timestamp type.

    A literal of the other timestamp type would wrap the column in a cast and
    keep the comparison from reaching the file scan.
    """
    kind = df.schema[column].dataType
    if value is None:
        return F.current_timestamp().cast(kind)
    keyword = "TIMESTAMP_NTZ" if isinstance(kind, T.TimestampNTZType) else "TIMESTAMP"
    return F.expr(f"{keyword} '{value.isoformat(sep=' ')}'")


def date_key(ts: Column) -> Column:
    """Calendar day as the integer yyyymmdd."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def month_bucket(ts: Column) -> Column:
    """Calendar month as the integer yyyymm."""
    return F.year(ts) * 100 + F.month(ts)


def file_stamp(moment: datetime) -> str:
    return moment.strftime("%Y%m%d_%H%M%S")


def snapshot_label(moment: datetime) -> str:
    return moment.strftime(SNAPSHOT_FORMAT)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def from_epoch_millis(value: Column) -> Column:
    return F.timestamp_millis(value)
