"""Stores to lake: stage what is old enough, then write wide orders."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tillwright.functions.dates import snapshot_label
from tillwright.operators.facts import drop_counts
from tillwright.operators.ingest import DEFAULT_SLOTS, aged_transactions, items_of, wide_orders
from tillwright.sinks.lake import by_store, write_raw, write_staged
from tillwright.sources.snapshots import require_inputs, staged
from tillwright.sources.tables import Store, read_stores

log = logging.getLogger(__name__)


def stage(spark: SparkSession, stores: Sequence[Store], lake: str, as_of: datetime) -> str:
    """Stage aged transactions and their items from every store; return the snapshot."""
    snapshot = snapshot_label(as_of)
    names = [store.name for store in stores]
    aged = aged_transactions(read_stores(spark, stores, "transactions"), as_of)
    write_staged(aged, lake, "transactions", snapshot, names)
    # The staged copy is what was selected; the stores are not asked a second time.
    selected = staged(spark, lake, "transactions", snapshot)
    items = items_of(read_stores(spark, stores, "transaction_item"), selected)
    write_staged(by_store(items), lake, "transaction_item", snapshot, names)
    return snapshot


def build_raw(
    spark: SparkSession,
    stores: Sequence[str],
    lake: str,
    snapshot: str,
    slots: int | None = DEFAULT_SLOTS,
) -> DataFrame:
    """Wide orders of a staged snapshot; fails when a store's input is missing.

    A basket with more items than ``slots`` has several rows, numbered by ``part``.
    """
    require_inputs(spark, lake, stores, snapshot)
    transactions, items = (
        staged(spark, lake, table, snapshot).drop("snapshot_date")
        for table in ("transactions", "transaction_item")
    )
    return wide_orders(transactions, items, slots, part="part")


def run(
    spark: SparkSession,
    stores: Sequence[Store],
    lake: str,
    as_of: datetime,
    slots: int | None = DEFAULT_SLOTS,
) -> str:
    snapshot = stage(spark, stores, lake, as_of)
    wide = build_raw(spark, [store.name for store in stores], lake, snapshot, slots)
    written = write_raw(wide, lake, snapshot, **drop_counts())
    log.info("snapshot %s: %s", snapshot, written)
    return snapshot
