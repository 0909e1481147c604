"""Lake to warehouse: dimensions first, then the facts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwright.functions.dates import month_bucket
from tillwright.operators.dimensions import (
    calendar,
    customer_members,
    dim_date_for,
    dim_employee,
    product_members,
    refresh_employees,
    refresh_members,
    store_members,
)
from tillwright.operators.facts import fact_point_transaction, fact_sales
from tillwright.operators.snapshots import newest_rows
from tillwright.sinks.manifest import read_version, write_version
from tillwright.sinks.warehouse import DIMENSION_ORDER, POINTS_ORDER, append_facts, months_of
from tillwright.sources.snapshots import raw_orders


class Masters(NamedTuple):
    """The store and loyalty tables that dimensions are made from."""

    stores: DataFrame
    employees: DataFrame
    products: DataFrame
    customers: DataFrame
    loyalty: DataFrame


def _replace(rows: DataFrame, warehouse: str, name: str) -> None:
    write_version(rows.sortWithinPartitions(*DIMENSION_ORDER[name]), f"{warehouse}/{name}")


def dimension(spark: SparkSession, warehouse: str, name: str) -> DataFrame | None:
    """The newest version of a dimension, None before its first load."""
    return read_version(spark, f"{warehouse}/{name}")


def load_dimensions(
    spark: SparkSession, warehouse: str, masters: Masters, dated: DataFrame | None = None
) -> None:
    """Bring the dimensions up to date with the masters; keys given out before stay as they are.

    Stores, products and customers take the attributes of the masters, employees keep a
    history. ``dated`` rows with ``created_at`` extend the calendar over their days. Each
    dimension is written anew and takes effect with its manifest, so a load that stops leaves
    every dimension in its old or its new state and can be run again.
    """
    members = {
        "dim_store": (store_members(masters.stores), "store_id", "store_key"),
        "dim_product": (product_members(masters.products), "product_id", "product_key"),
        "dim_customer": (
            customer_members(masters.customers, masters.loyalty), "customer_id", "customer_key",
        ),
    }
    for name, (rows, natural, key) in members.items():
        _replace(refresh_members(dimension(spark, warehouse, name), rows, natural, key), warehouse, name)
    stores = dimension(spark, warehouse, "dim_store")
    staff = dimension(spark, warehouse, "dim_employee")
    if staff is None:
        staff = dim_employee(masters.employees, stores)
    else:
        staff = refresh_employees(staff, masters.employees, stores)
    _replace(staff, warehouse, "dim_employee")
    if dated is not None:
        load_calendar(spark, warehouse, dated)


def load_calendar(spark: SparkSession, warehouse: str, dated: DataFrame) -> None:
    """Extend the calendar to every day between the first and the last of what it has and of
    ``dated``; holidays that were marked stay."""
    held = dimension(spark, warehouse, "dim_date")
    days = dim_date_for(dated)
    if held is not None:
        span = days.select("full_date").unionByName(held.select("full_date"))
        span = span.agg(F.min("full_date").alias("first"), F.max("full_date").alias("last"))
        every = calendar(span.select(F.explode(F.sequence("first", "last")).alias("full_date")))
        marked = held.select("date_key", F.col("is_holiday").alias("_held"))
        days = every.join(marked, "date_key", "left").withColumn(
            "is_holiday", F.coalesce("_held", "is_holiday")
        )
        days = days.select(held.columns)
    _replace(days, warehouse, "dim_date")


def load_facts(
    spark: SparkSession, warehouse: str, lake: str, snapshot: str | None = None
) -> None:
    """Load wide orders into both facts; loading them again changes nothing."""
    raw = raw_orders(spark, lake, snapshot)
    wide = newest_rows(raw) if snapshot is None else raw
    stores, employees, customers, products = (
        dimension(spark, warehouse, name)
        for name in ("dim_store", "dim_employee", "dim_customer", "dim_product")
    )
    months = months_of(raw.select(month_bucket(F.col("created_at")).alias("month")))
    append_facts(
        fact_sales(wide, stores, employees, customers, products),
        f"{warehouse}/fact_sales",
        months=months,
    )
    append_facts(
        fact_point_transaction(wide.where("part = 0"), stores, customers),
        f"{warehouse}/fact_point_transaction",
        keys=("transaction_key",),
        order=POINTS_ORDER,
        months=months,
    )
