"""Lookups by key: price lists, single rows, first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

def rows_with_ids(rows: DataFrame, column: str, ids: Sequence) -> DataFrame:
    """Rows whose key is in a list; an empty list gives none.

    Ids are read as the type of the column; one that cannot be is in no row.
    """
    texts = [(None if i is None else str(i),) for i in ids]
    wanted = rows.sparkSession.createDataFrame(texts, "_id string")
    kind = rows.schema[column].dataType
    return rows_requested(rows, column, wanted.select(F.col("_id").try_cast(kind)))


def rows_requested(rows: DataFrame, column: str, requests: DataFrame) -> DataFrame:
    """Rows whose key occurs in the only column of ``requests``."""
    wanted = requests.select(F.col(requests.columns[0]).alias("_wanted"))
    return rows.join(wanted, rows[column] == wanted["_wanted"], "left_semi")


def price_list(products: DataFrame) -> DataFrame:
    """Products as callers see them: ``id, name, price``."""
    return products.select(
        "id", F.col("product_name").alias("name"), F.col("price").cast("double").alias("price")
    )


def prices_for(products: DataFrame, ids: Sequence | DataFrame) -> DataFrame:
    if isinstance(ids, DataFrame):
        return price_list(rows_requested(products, "id", ids))
    return price_list(rows_with_ids(products, "id", ids))


def row_by_key(rows: DataFrame, key: Column) -> DataFrame:
    return rows.where(key).limit(1)


def first_rows(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return rows.orderBy(*order).limit(n)
