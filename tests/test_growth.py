"""What keeps the work of a query in proportion to its tables."""

from __future__ import annotations

import glob
import os
import tempfile
import time
import re

import pytest
from pyspark.sql import functions as F

from tillwright.operators import ingest, quality
from tillwright.plans import catalog
from tillwright.sinks import lake, warehouse
from tillwright.sources import order_files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_report_over_many_rows_counts_the_same_in_bounded_tasks(spark):
    orders = spark.range(50).select(F.col("id"), F.when(F.col("id") % 7 > 0, F.lit("x")).alias("name"))
    orders = orders.union(orders.where("id % 5 = 0"))
    items = spark.range(200).select((F.col("id") % 60).alias("order"), (F.col("id") % 90).alias("line"))
    tables = [
        quality.Checked("orders", orders, {"named": quality.missing("name")}, {"id unique": ["id"]}),
        quality.Checked("items", items, {}, {"line unique": ["line"]}, {"known": (["order"], "orders", "id unique")}),
    ]
    few, many = quality.constraint_report(tables), quality.constraint_report(tables, 7_000_000)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    assert re.search(r"hashpartitioning\(space#\d+, key#\d+, 7\)", plan(many))


def test_loaded_rows_go_before_the_rest_is_ranked(spark, tmp_path, rows):
    batch = spark.sql("SELECT * FROM VALUES (1L, 'a', 200001), (1L, 'b', 200001), (null, 'a', 200001), (2L, null, 200001) AS t(k, p, month)")
    path = str(tmp_path / "facts")
    warehouse.append_facts(batch.where("p = 'a' OR p IS NULL"), path, ("k", "p"), ("k",))
    fresh = warehouse.new_rows(batch.unionAll(batch), path, ("k", "p"))
    shown = plan(fresh)
    assert shown.index("Window") < shown.index("LeftAnti")
    assert rows(fresh) == [(1, "b", 200001)]
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    warehouse.append_facts(batch, path, ("k", "p"), ("k",))
    assert spark.read.parquet(path).count() == 4
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before


def test_orders_saved_twice_are_built_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(catalog.saved, "save_orders", lambda headers, items, *_: seen.extend([headers, items]))
    monkeypatch.setattr(catalog.saved, "saved_orders", lambda *_: seen[:2])
    catalog.QUERIES["saved_order_items"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 4 and all("lineitem" not in plan(df) and "Exchange" not in plan(df) for df in seen)


@pytest.mark.parametrize("hot", [1_000_000, 20])
def test_a_folder_of_csv_gets_one_file_unless_it_is_hot(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(lake, "hot_groups", lambda rows, keys, found=lake.hot_groups: found(rows, keys, hot))
    rows = spark.range(100, numPartitions=8).select("id", F.when(F.col("id") < 60, F.lit("big")).otherwise((F.col("id") % 5).cast("string")).alias("slug"))
    rows = rows.union(spark.sql("SELECT 100L, CAST(null AS STRING)"))
    lake.write_csv(rows, str(tmp_path / "out"), "slug")
    files = {d: [f for f in os.listdir(tmp_path / "out" / d) if f.endswith(".csv")] for d in os.listdir(tmp_path / "out") if d.startswith("slug=")}
    assert len(files) == 7 and all(len(f) == 1 for d, f in files.items() if d != "slug=big")
    assert (len(files["slug=big"]) > 1) == (hot == 20)
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 101


def test_baskets_are_cut_without_a_rank_unless_one_is_hot(spark, rows):
    items = spark.range(200).select((F.col("id") % 3).alias("transaction_id"), (F.col("id") * 37 % 211).cast("string").alias("product_id"), F.col("id").alias("quantity"))
    items = items.union(spark.sql("SELECT 9L, CAST(null AS STRING), 5L"))
    plain, hot = (ingest.pivot_items(items, 20, ("transaction_id",), min_hot_rows=n) for n in (1000, 10))
    assert "Window" not in plan(plain)
    assert rows(plain) == rows(hot) and plain.dtypes == hot.dtypes


def test_uploaded_items_are_parsed_once(spark):
    raw = spark.range(3).select(*[F.col("id").cast("string").alias(f.name) for f in order_files.UPLOAD.fields])
    for part in order_files.split_uploads(raw):
        assert part._jdf.queryExecution().optimizedPlan().toString().count("parse_json") <= 1


def test_what_the_key_determines_is_not_moved_and_shuffles_go(spark, rows, tmp_path):
    place = spark.conf.get("spark.local.dir", tempfile.gettempdir())
    shuffles = lambda: set(glob.glob(f"{place}/**/shuffle_*.data", recursive=True))
    key = F.sha2(F.concat_ws(":", F.col("k").cast("string"), "p"), 256)
    given = spark.range(200).select((F.col("id") % 40).alias("k"), F.when(F.col("id") % 3 > 0, "a").alias("p"), (F.col("id") % 7).alias("v"), F.lit(1).alias("month"))
    given = given.select(key.alias("digest"), "*")
    plain, narrow = str(tmp_path / "plain"), str(tmp_path / "narrow")
    fresh = warehouse.new_rows(given, narrow, ("k", "p"), made={"digest": key})
    assert "digest" not in fresh.columns and "digest" not in plan(fresh)
    before = shuffles()
    for _ in range(2):
        warehouse.append_facts(given, plain, ("k", "p"), ("k",))
        warehouse.append_facts(given, narrow, ("k", "p"), ("k",), made={"digest": key})
    loaded = spark.read.parquet(narrow)
    assert loaded.columns == given.columns and loaded.count() == 80
    assert rows(loaded) == rows(spark.read.parquet(plain))
    end = time.time() + 20
    # Spark itself still holds the shuffle of the latest write.
    while len(shuffles() - before) > 8 and time.time() < end:
        time.sleep(0.2)
    assert len(shuffles() - before) <= 8


def test_documents_of_the_stream_are_packed(spark, monkeypatch):
    folders = []

    def stopped(stream, to_facts, path, *rest, **more):
        folders.append(os.path.dirname(path))
        raise InterruptedError

    documents = spark.range(50).select(F.format_string('{"transaction_id": "%d"}', "id").alias("value"))
    monkeypatch.setattr(catalog.sample, "order_documents", lambda *_: documents)
    monkeypatch.setattr(catalog, "_held_dims", lambda *_: [])
    monkeypatch.setattr(catalog.sales_stream, "load_orders", stopped)
    with pytest.raises(InterruptedError):
        catalog.QUERIES["stream_sales"](spark, "")
    topic = f"{folders[0].removeprefix('file:')}/topic"
    files = [f for f in os.listdir(topic) if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert sorted(r.value for r in spark.read.text(topic).collect()) == sorted(r.value for r in documents.collect())


def test_dimensions_of_several_loads_are_built_once(spark, monkeypatch):
    loads = []

    def noted(fact, path, **more):
        loads.append((fact, more))
        if len(loads) == 3:
            raise InterruptedError

    monkeypatch.setattr(catalog.warehouse, "append_facts", noted)
    with pytest.raises(InterruptedError):
        catalog.QUERIES["report_on_loaded_fact"](spark, "/root/testdata/sf0.001")
    for fact, more in loads:
        assert more["months"] and set(more["made"]) == {"sales_key"}
        assert not [f for f in fact.inputFiles() if f.endswith(("/nation.parquet", "/part.parquet"))]


def test_pages_are_matched_once_and_folders_listed_by_few_tasks(spark, monkeypatch):
    pages = spark.range(80).select(F.col("id").alias("page_id"), F.format_string("<title>Town %d</title>", F.col("id") % 40).alias("html"))
    pages = pages.union(spark.sql("SELECT 80L, 'no title'")).union(spark.sql("SELECT 81L, CAST(null AS STRING)"))
    monkeypatch.setattr(catalog.sample, "pages", lambda *_: pages)
    written, write_csv = [], catalog.lake.write_csv
    monkeypatch.setattr(catalog.lake, "write_csv", lambda rows, *rest: (written.append(rows), write_csv(rows, *rest)))
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.sparkContext.setJobGroup("folders", "folders")
    found = catalog.QUERIES["region_files"](spark, "")
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("folders") for s in tracker.getJobInfo(j).stageIds]
    tasks = [info.numTasks for s in stages if (info := tracker.getStageInfo(s))]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(name) == before and tasks and max(tasks) < 40
    assert "regexp_extract" not in plan(written[0])
    counts = {r.slug: (r.pages, r.first_page) for r in found.collect()}
    assert len(counts) == 41 and counts["town-7"] == (2, 7) and counts[None] == (2, 80)
