"""Time the headline queries and print one JSON line.

Each query is run to the end with nothing collected. ``BENCH_SF_DIR`` names the
tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` a subset by name.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwright.plans.catalog import QUERIES  # noqa: E402
from tillwright.session import build_session  # noqa: E402

HEADLINES = (
    "aged_transactions",
    "items_of_aged",
    "item_rank",
    "orders_wide",
    "orders_long",
    "snapshot_latest",
    "dim_customer",
    "fact_sales",
    "fact_sales_from_wide",
    "fact_point_transaction",
    "order_totals",
    "order_header_rows",
    "quality_report",
    "customer_profile",
    "customer_upsert",
    "points_accrual",
    "tier_assignment",
    "page_links",
    "page_details",
    "region_slug",
    "sales_by_store_month",
    "top_products",
    "idempotent_append",
    "stream_points",
    "stream_accrual",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    spark = build_session(
        "tillwright-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed run starts the JVM's compilers and the Python workers.
    for name in ("orders_wide", "page_links"):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
