"""Whole tables from files, a catalog or a store database, for one store or many."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Store:
    """One point-of-sale system: its name, and where its tables are.

    ``format`` is any Spark source. File sources take ``location`` as the folder of
    the tables; ``jdbc`` takes it as the URL, with the reader's ``options``.
    """

    name: str
    location: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


def read_table(spark: SparkSession, store: Store, table: str) -> DataFrame:
    """All rows of a store's table. Filters put on the result reach the source."""
    reader = spark.read.format(store.format).options(**store.options)
    if store.format == "jdbc":
        return reader.option("url", store.location).option("dbtable", table).load()
    return reader.load(f"{store.location.rstrip('/')}/{table}")


def partitioned_jdbc(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Reader options that fetch a table in parallel ranges of a numeric column."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


# Releases differ in how many slashes they show behind the scheme of a local file.
SLASHES = "^file:/+"


def _qualified(spark: SparkSession, path: str) -> str:
    """A path as file metadata shows it: with its scheme, and escaped."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub(SLASHES, "file:/", system.makeQualified(at).toUri().toString())


def _read_files(
    spark: SparkSession, stores: Sequence[Store], table: str, schema: StructType | None
) -> DataFrame:
    """A table of stores of one format by one reader; the path of a file tells its store.

    Without a declared schema the columns of all files are merged in one job.
    """
    reader = spark.read.format(stores[0].format).options(**stores[0].options)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    where = {s.name: f"{s.location.rstrip('/')}/{table}" for s in stores}
    # Each folder is read once, though two stores may share it.
    folders = {_qualified(spark, path): path for path in where.values()}
    rows = reader.load(list(folders.values()))
    file = F.regexp_replace("_metadata.file_path", SLASHES, "file:/")
    root = F.regexp_extract(file, f"^(.*/{re.escape(table)})(?:/.*)?$", 1)
    # As many rows as stores are configured.
    paths = [(_qualified(spark, path), name) for name, path in where.items()]
    named = F.broadcast(spark.createDataFrame(paths, "_root string, store_name string"))
    return rows.withColumn("_root", root).join(named, "_root").drop("_root")


def read_stores(
    spark: SparkSession, stores: Sequence[Store], table: str, schema: StructType | None = None
) -> DataFrame:
    """One table from every store, with the store's name on each row.

    Files of one format and of the same options are one scan, however many stores there
    are; each database is read by itself.
    """
    if not stores:
        raise ValueError("no store is configured")
    alike: dict[tuple, list[Store]] = {}
    for store in stores:
        own = (store.name,) if store.format == "jdbc" else ()
        alike.setdefault((store.format, tuple(sorted(store.options.items())), *own), []).append(store)
    named = [
        read_table(spark, group[0], table).withColumn("store_name", F.lit(group[0].name))
        if group[0].format == "jdbc"
        else _read_files(spark, group, table, schema)
        for group in alike.values()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line, in UTF-8 with or without a byte-order mark."""
    return (
        spark.read.schema(schema)
        .options(header=True, quote='"', escape='"', multiLine=True, enforceSchema=False)
        .csv(path)
    )
