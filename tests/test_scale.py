"""Plans that have to hold when tables are large and keys are uneven."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tillwright.operators import facts, ingest, keys, pages, quality, snapshots
from tillwright.plans.catalog import QUERIES
from tillwright.sources import sample_tables as sample

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    changed = {}

    def put(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            changed[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield put
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=60_000):
    """A third of all rows in one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("customer_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )


def test_a_hot_key_in_a_lookup_is_split_at_run_time(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100kb",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200kb",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__shuffle__partitions="8",
    )
    dim = spark.range(2000).select(F.col("id").cast("string").alias("customer_id"))
    dim = keys.assign_keys(dim, ["customer_id"], "customer_key")
    facts = keys.lookup_key(skewed(spark), dim, "customer_id", "customer_id", "customer_key")
    plan = final_plan(facts)
    assert "skew=true" in plan.split("Initial Plan")[0]
    assert facts.count() == 60_000


def test_a_transaction_with_a_third_of_all_items_becomes_facts(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50kb",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100kb",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__shuffle__partitions="8",
    )
    n = 60_000
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000)
        .alias("transaction_id"),
        F.col("id").cast("string").alias("product_id"),
        F.lit(1).alias("quantity"),
    )
    heads = spark.range(-1, 5000).select(
        F.lit("s").alias("store_name"), F.col("id").alias("transaction_id"),
        F.col("id").alias("employee_id"), F.col("id").cast("string").alias("customer_id"),
        F.current_timestamp().alias("created_at"), F.lit("cash").alias("payment_method"),
        F.lit(0).alias("discount"), F.lit(1).alias("final_amount"), F.lit(1).alias("point_changed"),
    )
    none = {
        "store": "store_id string, store_key long",
        "employee": "employee_id long, employee_key long, is_current int",
        "customer": "customer_id string, customer_key long",
        "product": "product_id string, product_key long",
    }
    dims = [spark.createDataFrame([], schema) for schema in none.values()]
    fact = facts.fact_of_items(heads, items, *dims, keys=("transaction_id",))
    assert "skew=true" in final_plan(fact).split("Initial Plan")[0]
    assert fact.where("transaction_id = -1").count() == n / 3


def test_hot_group_ranking_costs_nothing_when_no_group_is_hot(spark):
    items = sample.transaction_items(spark, FOLDER)
    plan = final_plan(ingest.rank_items(items, ("transaction_id",)))
    ran = plan.split("Initial Plan")[0]
    assert ran.count("Window ") == 1 and "Union" not in ran


def test_newest_rows_are_picked_before_the_shuffle(spark):
    df = skewed(spark).withColumn("snapshot_date", F.col("filler"))
    newest = snapshots.latest_per_key(df, "snapshot_date", ["customer_id"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_foreign_keys_are_counted_before_a_shuffled_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    parent = spark.range(10).select(F.col("id").cast("string").alias("id"))
    plan = quality.orphans(skewed(spark), "customer_id", parent, "id")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join LeftAnti") < text.index("Aggregate [customer_id")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")
@pytest.mark.parametrize(
    "name", ["aged_transactions", "orders_wide", "fact_sales", "sales_by_store_month"]
)
def test_no_join_is_a_product(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")
def test_scans_read_only_what_is_used(spark):
    plan = QUERIES["item_rank"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    schema = "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>"
    assert schema in plan


def test_only_pages_that_can_match_reach_python(spark):
    df = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")
    plan = pages.harvest_links(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Filter")
