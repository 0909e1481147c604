"""Order documents: parsing, validation, totals and normal form."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tillwright.functions.money import after_discount, line_total, points_for
from tillwright.functions.payments import storage_payment
from tillwright.operators.reshape import order_header, order_items
from tillwright.schemas import DEFAULT_PAYMENT, MONEY, MONEY_SUM, ORDER


class Split(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The reason of the first rule that holds, null when none does."""
    reason = F.lit(None).cast("string")
    for broken, text in reversed(rules):
        reason = F.when(broken, text).otherwise(reason)
    return reason


def split_on_reason(judged: DataFrame, reason: str = "reject_reason") -> Split:
    return Split(
        judged.where(F.col(reason).isNull()).drop(reason), judged.where(F.col(reason).isNotNull())
    )


def parse_orders(documents: DataFrame, column: str = "value") -> DataFrame:
    """JSON order documents as typed columns; the text is kept as ``document``.

    Unpacking through an array makes the parse a step of its own: filters on the
    fields do not repeat it.
    """
    order = F.from_json(F.col(column), ORDER, {"mode": "PERMISSIVE"})
    return documents.select(F.col(column).alias("document"), F.inline(F.array(order)))


def with_order_defaults(orders: DataFrame) -> DataFrame:
    """Missing discount is 0, missing payment is cash; payment in the stored spelling."""
    method = F.coalesce("payment_method", F.lit(DEFAULT_PAYMENT))
    return orders.withColumns(
        {
            "discount": F.coalesce("discount", F.lit(0)).cast(MONEY),
            "given_payment": method,
            "payment_method": storage_payment(method),
        }
    )


def judge_orders(orders: DataFrame) -> DataFrame:
    """Orders with defaults applied and ``reject_reason``, null for valid ones."""
    bad_item = lambda i: i["product_id"].isNull() | i["quantity"].isNull() | i["unit_price"].isNull()
    rules = [
        (F.col("transaction_id").isNull(), "no transaction id"),
        (F.col("customer_id").isNull(), "no customer id"),
        (F.col("employee_id").isNull(), "no employee id"),
        (F.col("created_at").isNull(), "no creation time"),
        (F.coalesce(F.size("items"), F.lit(0)) <= 0, "no items"),
        (F.exists("items", bad_item), "incomplete item"),
        (F.col("payment_method").isNull(), "unknown payment method"),
    ]
    return with_order_defaults(orders).withColumn("reject_reason", first_reason(*rules))


def nested_totals(orders: DataFrame, discount_mode: str = "amount") -> DataFrame:
    """Total and final amount of nested orders, from the items in each row."""
    total = F.aggregate(
        "items",
        F.lit(0).cast(MONEY_SUM),
        lambda acc, i: (acc + line_total(i["quantity"], i["unit_price"])).cast(MONEY_SUM),
    )
    return _with_amounts(orders.withColumn("total_amount", total), discount_mode)


def item_totals(
    headers: DataFrame,
    items: DataFrame,
    keys: tuple[str, ...] = ("transaction_id",),
    discount_mode: str = "amount",
) -> DataFrame:
    """The same totals from header and item rows; an order without items totals 0."""
    sums = items.groupBy(*keys).agg(
        F.sum(line_total(F.col("quantity"), F.col("unit_price"))).alias("total_amount")
    )
    joined = headers.join(sums, list(keys), "left").withColumn(
        "total_amount", F.coalesce("total_amount", F.lit(0)).cast(MONEY_SUM)
    )
    return _with_amounts(joined, discount_mode)


def _with_amounts(orders: DataFrame, discount_mode: str) -> DataFrame:
    final = after_discount(F.col("total_amount"), F.col("discount"), discount_mode)
    return orders.withColumn("final_amount", final).withColumn(
        "point_changed", points_for(F.col("final_amount"))
    )


def priced_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with a unit price: their own, or the product's when they have none."""
    prices = products.select(F.col("id").alias("product_id"), F.col("price").alias("_list_price"))
    own = F.col("unit_price") if "unit_price" in items.columns else F.lit(None)
    return (
        items.join(prices, "product_id", "left")
        .withColumn("unit_price", F.coalesce(own, "_list_price").cast(MONEY))
        .drop("_list_price")
    )


class NormalOrders(NamedTuple):
    nested: DataFrame
    headers: DataFrame
    items: DataFrame
    rejected: DataFrame


def normalise_orders(documents: DataFrame, column: str = "value") -> NormalOrders:
    """JSON order documents as priced orders, their header and item rows, and rejects."""
    return normal_form(judge_orders(parse_orders(documents, column)))


def normal_form(judged: DataFrame) -> NormalOrders:
    """The same for orders that are parsed and judged already."""
    valid, rejected = split_on_reason(judged)
    valid = nested_totals(valid).drop("document", "given_payment")
    return NormalOrders(valid, order_header(valid), order_items(valid), rejected)
