"""From store tables to wide orders: age filter, items, rank, pivot."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tillwright.functions.dates import instant
from tillwright.operators.reshape import slot_columns
from tillwright.operators.skew import MIN_HOT_ROWS, hot_groups, row_number_in_groups

ORDER_KEYS = ("store_name", "transaction_id")
DEFAULT_SLOTS = 20
# A wide table is no wider than this; what a basket has beyond it goes to further rows.
MAX_SLOTS = 999


def aged_transactions(
    transactions: DataFrame,
    as_of: datetime | None = None,
    days: int = 7,
    ts: str = "created_at",
) -> DataFrame:
    """Transactions at least ``days`` old at ``as_of`` (now when not given)."""
    cutoff = instant(transactions, ts, as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return transactions.where(F.col(ts) <= cutoff)


def items_of(
    items: DataFrame, transactions: DataFrame, keys: Sequence[str] = ORDER_KEYS
) -> DataFrame:
    """Items whose transaction was selected; none when nothing was selected."""
    return items.join(transactions.select(*keys), list(keys), "left_semi")


def collated(items: DataFrame, collation: str | None) -> DataFrame:
    """Items with product ids compared under ``collation`` (binary when ``None``)."""
    if collation is None:
        return items
    return items.withColumn("product_id", F.collate("product_id", collation))


def rank_items(
    items: DataFrame,
    keys: Sequence[str] = ORDER_KEYS,
    name: str = "product_rank",
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Running number of each item in its transaction, by product id from 1."""
    return row_number_in_groups(items, keys, "product_id", name, min_rows=min_hot_rows)


def slots_needed(
    items: DataFrame, keys: Sequence[str] = ORDER_KEYS, at_least: int = 1
) -> int:
    """Items in the largest transaction, ``MAX_SLOTS`` at most: a width for wide orders."""
    widest = items.groupBy(*keys).count().agg(F.max("count").alias("n")).first()
    return max(at_least, min(MAX_SLOTS, int(widest["n"] or 0)))


def gather_items(
    items: DataFrame,
    keys: Sequence[str] = ORDER_KEYS,
    fields: Sequence[str] = ("product_id", "quantity"),
    name: str = "items",
) -> DataFrame:
    """One row per transaction with its items as an array, by product id.

    For nested documents, which hold a basket whole by their nature.
    """
    # The first field orders the array.
    return items.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))


def pivot_items(
    items: DataFrame,
    slots: int = DEFAULT_SLOTS,
    keys: Sequence[str] = ORDER_KEYS,
    part: str = "part",
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Rows with columns ``product_id_1, quantity_1, ...`` for each transaction.

    The place of an item is its rank in the transaction. A basket with more items than
    slots goes on in further rows, numbered from 0 in column ``part``, so that no row
    holds more than ``slots`` items and every basket fits.
    """
    entries = items.select(*keys, "product_id", "quantity")
    if hot_groups(entries, keys, min_hot_rows) is None:
        # No basket is too big for a row: gathered at once and cut, it needs no rank before.
        last = F.expr(f"(size(items) - 1) DIV {slots}").cast("int")
        cut = F.transform(F.sequence(F.lit(0), last), lambda at: F.slice("items", at * slots + 1, slots))
        gathered = gather_items(entries, keys).select(*keys, F.posexplode(cut).alias(part, "_b"))
    else:
        ranked = rank_items(entries, keys, "_rank", min_hot_rows)
        place = F.col("_rank") - 1
        gathered = (
            ranked.withColumn(part, F.expr(f"(_rank - 1) DIV {slots}").cast("int"))
            .groupBy(*keys, part)
            .agg(F.sort_array(F.collect_list(F.struct(place.alias("_at"), "product_id", "quantity"))).alias("_b"))
        )
    wide = []
    for slot in range(1, slots + 1):
        product, quantity = slot_columns(slot)
        entry = F.get("_b", F.lit(slot - 1))
        wide += [entry["product_id"].alias(product), entry["quantity"].alias(quantity)]
    return gathered.select(*keys, part, *wide)


def wide_orders(
    transactions: DataFrame,
    items: DataFrame,
    slots: int | None = DEFAULT_SLOTS,
    keys: Sequence[str] = ORDER_KEYS,
    part: str | None = None,
) -> DataFrame:
    """Transactions with their items in slots; those without items keep null slots.

    A transaction with more items than slots has several rows; ``part`` names a column
    that numbers them from 0. ``slots=None`` counts the widest basket of these
    transactions first. The join keeps only their items, so no semi-join comes before it.
    """
    if slots is None:
        slots = slots_needed(items_of(items, transactions, keys), keys)
    numbered = part or "_part"
    wide = transactions.join(pivot_items(items, slots, keys, numbered), list(keys), "left")
    if part is None:
        return wide.drop(numbered)
    # The number stands behind the transaction's own columns.
    return wide.withColumn(part, F.coalesce(part, F.lit(0)))
