"""Customer profiles, upserts, points accrual and tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwright.operators.orders import Split, first_reason, split_on_reason


def judge_customer_requests(requests: DataFrame) -> Split:
    """Create-or-update requests; those without id or name are rejected."""
    reason = first_reason(
        (F.col("id").isNull() | (F.col("id") == ""), "missing id"),
        (F.col("name").isNull(), "missing name"),
    )
    return split_on_reason(requests.withColumn("reject_reason", reason))


def customer_profiles(customers: DataFrame, loyalty: DataFrame) -> DataFrame:
    """Every customer with the loyalty fields of their row, null when they have none."""
    fields = loyalty.withColumnRenamed("customer_id", "_loyal")
    return customers.join(fields, customers["id"] == fields["_loyal"], "left").drop("_loyal")


def profiles_requested(
    requests: DataFrame, customers: DataFrame, loyalty: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Profiles of the requested ids, and the ids no customer has."""
    wanted = requests.select(F.col(requests.columns[0]).alias("id")).distinct()
    found = customer_profiles(customers.join(wanted, "id", "left_semi"), loyalty)
    return found, wanted.join(customers, "id", "left_anti")


def upsert_customers(
    customers: DataFrame, requests: DataFrame, requested_at: str = "requested_at"
) -> DataFrame:
    """The customer table after create-or-update requests, in order of arrival.

    A known customer takes the newest name asked for. A new one also takes the
    joining date of the first request, or its arrival time when it names none.
    ``created`` is null for customers no request touched.
    """
    asked = requests.groupBy("id").agg(
        F.max_by("name", requested_at).alias("_name"),
        F.min_by(F.coalesce("join_date", F.col(requested_at)), requested_at).alias("_joined"),
    )
    known = customers.withColumn("_known", F.lit(True))
    asked = asked.withColumn("_asked", F.lit(True))
    return known.join(asked, "id", "full_outer").select(
        "id",
        F.when(F.col("_asked"), F.col("_name")).otherwise(F.col("name")).alias("name"),
        F.when(F.col("_known"), F.col("join_date")).otherwise(F.col("_joined")).alias("join_date"),
        F.when(F.col("_asked"), F.col("_known").isNull()).alias("created"),
    )


def accrued(requests: DataFrame, at: str = "requested_at") -> DataFrame:
    """Points and money earned per customer, missing values counted as 0."""
    return requests.groupBy("customer_id").agg(
        F.sum(F.coalesce("earned_point", F.lit(0))).cast("long").alias("_points"),
        F.sum(F.coalesce("amount", F.lit(0))).cast("long").alias("_money"),
        F.max(at).alias("_at"),
    )


def accrue_points(
    loyalty: DataFrame, requests: DataFrame, at: str = "requested_at"
) -> DataFrame:
    """The loyalty table after accrual requests; a new customer starts without a tier."""
    earned = accrued(requests, at)
    zero = F.lit(0)
    return loyalty.join(earned, "customer_id", "full_outer").select(
        "customer_id",
        "tier",
        (F.coalesce("point", zero) + F.coalesce("_points", zero)).cast("long").alias("point"),
        (F.coalesce("total_money_used", zero) + F.coalesce("_money", zero))
        .cast("long")
        .alias("total_money_used"),
        F.coalesce("_at", "last_updated").alias("last_updated"),
    )


def assign_tiers(customers: DataFrame, tiers: DataFrame, point: str = "point") -> DataFrame:
    """Set ``tier`` to the one with the greatest ``min_point`` not above the points.

    The ladder is one sorted array, a value that every row searches, so no customer row
    is moved. Tiers without a threshold are never reached; of equal thresholds the last
    name counts.
    """
    columns = [c for c in customers.columns if c != "tier"]
    steps = tiers.where("min_point IS NOT NULL")
    ladder = steps.agg(F.sort_array(F.collect_list(F.struct("min_point", "tier")))).scalar()
    reached = F.filter("_ladder", lambda step: step["min_point"] <= F.col(point))
    held = customers.withColumn("_ladder", ladder)
    return held.select(*columns, F.try_element_at(reached, F.lit(-1))["tier"].alias("tier"))
