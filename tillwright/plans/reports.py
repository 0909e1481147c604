"""Reports over the warehouse.

Transaction measures are repeated on every item of the sales fact, so money and
points are taken once per transaction before they are added up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def transactions_of(sales: DataFrame, *columns: str) -> DataFrame:
    """The sales fact at one row per transaction, with the columns named."""
    once = [F.first(c).alias(c) for c in columns]
    return sales.groupBy("store_name", "transaction_id").agg(*once)


def sales_by_store_month(sales: DataFrame) -> DataFrame:
    """Transactions, money and points per store and month."""
    return (
        transactions_of(sales, "month", "final_amount", "point_changed")
        .groupBy("store_name", "month")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum("final_amount").alias("revenue"),
            F.sum("point_changed").cast("long").alias("points"),
        )
    )


def top_products(sales: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products sold most, by quantity; ties go to the smaller id."""
    return (
        sales.groupBy("product_id")
        .agg(
            F.sum("quantity").cast("long").alias("quantity"),
            F.count(F.lit(1)).alias("order_lines"),
        )
        .orderBy(F.desc("quantity"), "product_id")
        .limit(n)
    )


def tier_summary(loyalty: DataFrame) -> DataFrame:
    """Customers, points and money per tier."""
    return loyalty.groupBy("tier").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("point").cast("long").alias("points"),
        F.sum("total_money_used").cast("long").alias("total_money_used"),
    )
