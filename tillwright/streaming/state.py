"""Central customer and points state, kept from events as they arrive.

Each function takes a streaming (or plain) frame of typed events and returns the
running state per customer, to be written in update mode. Spark combines rows of a
customer before the shuffle, so a very busy customer does not load one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwright.functions.identity import row_identity
from tillwright.schemas import CUSTOMER_CREATED, CUSTOMER_UPDATED, POINT_UPDATED
from tillwright.sinks.keyvalue import Changes, put, put_batch, read_runs


def latest_points(events: DataFrame) -> DataFrame:
    """The newest totals per customer. Events carry totals, so repeats do no harm."""
    totals = F.struct("timestamp", "points", "total_money_used")
    return (
        events.where(F.col("type") == POINT_UPDATED)
        .groupBy("customer_id")
        .agg(F.max(totals).alias("_last"))
        .select("customer_id", "_last.points", "_last.total_money_used")
    )


def latest_customers(events: DataFrame) -> DataFrame:
    """The newest name per customer and the joining date that came with it."""
    named = F.struct("timestamp", "name", "join_date")
    return (
        events.where(F.col("type").isin(CUSTOMER_CREATED, CUSTOMER_UPDATED))
        .groupBy("customer_id")
        .agg(F.max(named).alias("_last"))
        .select(
            "customer_id", "_last.name", F.to_timestamp("_last.join_date").alias("join_date")
        )
    )


# What makes two deliveries the same event; the payload tells events of one instant apart.
EVENT_KEY = ("customer_id", "type", "ts", "points", "total_money_used")


SEEN, SUMS = "seen", "sums"


def fresh_events(
    batch: DataFrame, path: str, batch_id: int, keys: Sequence[str] = EVENT_KEY
) -> DataFrame:
    """Events of a batch that no batch before it had, each once.

    The table ``seen`` at ``path`` keeps the identity of every event by its day, and a batch
    reads the days it has events of, so an event counts once however late it or its repeat
    comes. A batch that is run again sees the table as it was before it, and so finds the
    same events.
    """
    marked = batch.select(
        "*",
        row_identity(*[F.col(c) for c in keys]).alias("_event"),
        F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit("none")).alias("_day"),
    ).dropDuplicates(["_event"])
    # Days are as many as the calendar has, whatever the number of events.
    days = [row["_day"] for row in marked.select("_day").distinct().collect()]
    seen = read_runs(batch.sparkSession, path, SEEN, batch_id, "_day", days)
    if seen is not None:
        marked = marked.join(seen.select("_event"), "_event", "left_anti")
    return marked


def accrue_once(
    events: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = EVENT_KEY,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Add the points and money of each purchase event once, whenever it arrives.

    Each batch publishes the sums it adds and the events it counted together, so one is
    never there without the other.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        bought = batch.where(F.col("type") == POINT_UPDATED)
        fresh = fresh_events(bought, path, batch_id, keys).persist()
        try:
            deltas = fresh.select(
                "customer_id", "ts",
                F.col("points").alias("earned_point"), F.col("total_money_used").alias("amount"),
            )
            sums = Changes(accrued_points(deltas), _added_up, ["customer_id"])
            put(batch.sparkSession, path, batch_id, {SUMS: sums, SEEN: _noted(fresh)})
        finally:
            fresh.unpersist()

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _noted(fresh: DataFrame) -> Changes:
    """The identities of a batch's events; runs of them are merged as they are."""
    return Changes(fresh.select("_event", "_day"), lambda rows: rows, ["_day", "_event"], "_day")


def _note(fresh: DataFrame, path: str, batch_id: int) -> None:
    put(fresh.sparkSession, path, batch_id, {SEEN: _noted(fresh)})


def _added_up(sums: DataFrame) -> DataFrame:
    return sums.groupBy("customer_id").agg(
        F.sum("point").cast("long").alias("point"),
        F.sum("total_money_used").cast("long").alias("total_money_used"),
        F.max("last_updated").alias("last_updated"),
        F.max("batch_id").alias("batch_id"),
    )


def accrued_totals(spark: SparkSession, path: str) -> DataFrame:
    """Points, money and last purchase per customer over all batches of :func:`accrue_once`."""
    return _added_up(read_runs(spark, path, SUMS)).drop("batch_id")


def accrued_points(deltas: DataFrame) -> DataFrame:
    """Sums of earned points and money per customer, and the time of the last one."""
    return deltas.groupBy("customer_id").agg(
        F.sum(F.coalesce("earned_point", F.lit(0))).cast("long").alias("point"),
        F.sum(F.coalesce("amount", F.lit(0))).cast("long").alias("total_money_used"),
        F.max("ts").alias("last_updated"),
    )


def keep_state(
    state: DataFrame,
    path: str,
    checkpoint: str,
    finish: Callable[[DataFrame], DataFrame] = lambda changed: changed,
    trigger: Mapping | None = None,
    keys: Sequence[str] = ("customer_id",),
) -> StreamingQuery:
    """Publish changed rows of a running state, batch by batch; runs are merged on the way.

    ``finish`` runs on the changed rows of each batch, to add a tier for example.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        put_batch(finish(changed), path, batch_id, keys)

    return (
        state.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
