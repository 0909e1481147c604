"""Prices that were valid when a line was sold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwright.operators.skew import MIN_HOT_ROWS, last_value_in_groups
from tillwright.schemas import MONEY


def priced_as_of(
    lines: DataFrame, prices: DataFrame, at: str = "created_at", min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """``lines`` with a ``unit_price`` and where it comes from, ``price_source``.

    A line keeps a price of its own (``own``); otherwise it takes the last price of its
    product that was valid from its time or earlier (``list``). Where there is none,
    the price is null and the source tells why: ``no product``, ``no time`` or ``no price then``.
    ``prices`` has ``product_id, valid_from, price``; of several prices from one instant the
    highest counts, and those without product, time or price do not.

    Prices and lines are one sequence per product, by time, in which prices are carried
    forward: no line meets more than one price, and a product with most lines is split.
    """
    columns = [F.col(c) for c in lines.columns]
    own = F.col("unit_price") if "unit_price" in lines.columns else F.lit(None).cast(MONEY)
    product = F.col("product_id").cast("string")
    # At one instant prices come first, the highest last; lines are told apart by a hash.
    sold = lines.select(
        product.alias("_product"),
        F.struct(
            F.col(at).cast("timestamp").alias("time"), F.lit(1).alias("kind"), F.lit(None).cast(MONEY).alias("price"),
            F.xxhash64(*columns).alias("line"),
        ).alias("_order"),
        F.lit(None).cast(MONEY).alias("_price"),
        F.struct(*columns, own.cast(MONEY).alias("_own")).alias("_line"),
    )
    listed = prices.where("product_id IS NOT NULL AND valid_from IS NOT NULL AND price IS NOT NULL").select(
        product.alias("_product"),
        F.struct(
            F.col("valid_from").cast("timestamp").alias("time"), F.lit(0).alias("kind"), F.col("price").cast(MONEY).alias("price"),
            F.lit(0).cast("long").alias("line"),
        ).alias("_order"),
        F.col("price").cast(MONEY).alias("_price"),
        F.lit(None).cast(sold.schema["_line"].dataType).alias("_line"),
    )
    carried = last_value_in_groups(sold.unionByName(listed), ["_product"], "_order", "_price", min_hot_rows)
    # A line without a time stands before every price and so gets none.
    source = (
        F.when(F.col("_line._own").isNotNull(), "own")
        .when(F.col("_product").isNull(), "no product")
        .when(F.col("_order.time").isNull(), "no time")
        .when(F.col("_price").isNull(), "no price then")
        .otherwise("list")
    )
    return carried.where("_line IS NOT NULL").select(
        *[F.col(f"_line.{c}") for c in lines.columns if c != "unit_price"],
        F.coalesce("_line._own", "_price").alias("unit_price"),
        source.alias("price_source"),
    )
