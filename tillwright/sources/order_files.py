"""Order uploads: CSV rows whose ``items`` column is JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillwright.schemas import MONEY, ORDER, ORDER_ITEM

# The column of parsed items.
LISTED = "_listed"
UPLOAD = T.StructType([T.StructField(f.name, T.StringType()) for f in ORDER.fields])


def number_or_text(value: Column) -> tuple[Column, Column]:
    """A value as a number where it reads as one, and as trimmed text."""
    text = F.trim(value)
    return text.try_cast("double"), text


def listed_items(text: Column) -> Column:
    """The entries of a JSON array as variants, null if it is none."""
    return F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")


def _step(rows: DataFrame, *columns: str | Column) -> DataFrame:
    """Columns as a step of their own, so that filters and later columns do not repeat them."""
    return rows.select(F.inline(F.array(F.struct(*columns))))


def typed_items(listed: Column) -> Column:
    """Listed items of an order; a number in quotes is a number too, as forms send all as text."""
    cell = lambda item, f: F.try_variant_get(item, f"$.{f.name}", f.dataType.simpleString())
    return F.transform(
        listed, lambda item: F.struct(*[cell(item, f).alias(f.name) for f in ORDER_ITEM.fields])
    )


def typed_orders(raw: DataFrame) -> DataFrame:
    """Order columns given as text, in the types of an order."""
    text = {f.name: F.trim(F.col(f.name)) for f in ORDER.fields}
    if LISTED not in raw.columns:
        raw = raw.withColumn(LISTED, listed_items(text["items"]))
    return _step(
        raw,
        text["transaction_id"].alias("transaction_id"),
        text["customer_id"].alias("customer_id"),
        text["employee_id"].alias("employee_id"),
        F.try_to_timestamp(text["created_at"]).alias("created_at"),
        typed_items(F.col(LISTED)).alias("items"),
        text["discount"].try_cast(MONEY).alias("discount"),
        text["payment_method"].alias("payment_method"),
    )


def quarantine_reason(raw: DataFrame) -> Column:
    """Why a row of an upload cannot be read as an order; null if it can.

    A cell that is there but does not read as what it should be is a reason; one that is
    missing is left to the validation of orders. Items must be a JSON array of objects
    whose quantity and price are numbers.
    """
    text = {f.name: F.trim(F.col(f.name)) for f in ORDER.fields}
    listed = F.col(LISTED) if LISTED in raw.columns else listed_items(text["items"])
    given = lambda name: F.coalesce(text[name], F.lit("")) != ""
    number = lambda item, field: F.try_variant_get(item, f"$.{field}", "double").isNotNull()
    good = F.forall(listed, lambda item: number(item, "quantity") & number(item, "unit_price"))
    return (
        F.when(given("items") & listed.isNull(), "unreadable items")
        .when(given("items") & ~good, "items without numbers")
        .when(given("created_at") & F.try_to_timestamp(text["created_at"]).isNull(), "unreadable time")
        .when(given("discount") & number_or_text(text["discount"])[0].isNull(), "unreadable discount")
    )


def split_uploads(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed orders of uploaded rows, and the rows that cannot be read, with the reason."""
    parsed = _step(raw, *raw.columns, listed_items(F.trim("items")).alias(LISTED))
    judged = _step(parsed, *parsed.columns, quarantine_reason(parsed).alias("reject_reason"))
    good = judged.where("reject_reason IS NULL").drop("reject_reason")
    return typed_orders(good), judged.where("reject_reason IS NOT NULL").drop(LISTED)


def read_uploads(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the uploaded files as text; commas inside quoted JSON are data."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "enforceSchema": False}
    return spark.read.schema(UPLOAD).options(**options).csv(path)


def read_order_files(spark: SparkSession, path: str) -> DataFrame:
    """Every row of the uploaded files; commas inside quoted JSON are data."""
    return typed_orders(read_uploads(spark, path))
