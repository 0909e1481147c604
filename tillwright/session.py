"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Dates, month buckets and epoch values are all read in UTC.
SESSION_ZONE = "UTC"

# Settings for a session that this library builds itself. Skew handling stays on
# even when splitting a hot join partition costs one more shuffle downstream.
DEFAULTS = {
    "spark.sql.session.timeZone": SESSION_ZONE,
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that change results to a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    return spark


# A task takes about so many rows of an aggregate whose keys hardly ever repeat.
ROWS_OF_TASK = 1_000_000


def partitions_for(spark: SparkSession, rows: int) -> int | None:
    """Partitions that keep ``rows`` of distinct keys few per task; None if they are few anyway."""
    if rows <= 4 * ROWS_OF_TASK:
        return None
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_OF_TASK))


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs, which it does once the driver has
    collected its garbage; it may not do that for long by itself."""
    spark._jvm.System.gc()


# Spark lists each of up to 10,000 folders in a task of its own; so many per core do as well.
LISTING_TASKS_OF_CORE = 4


@contextmanager
def listing_by_few(spark: SparkSession) -> Iterator[None]:
    """Tables of very many folders that are opened inside are listed by few tasks, each of many
    folders, as starting a task takes longer than listing a folder."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    tasks = LISTING_TASKS_OF_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set(name, str(min(int(before), tasks)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Streaming checkpoints and intermediate tables go here, so every executor must
    see it. A local folder is made only when the setting is absent and the
    session is local.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="tillwright-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
