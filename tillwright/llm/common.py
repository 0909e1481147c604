"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.session import free_shuffles, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there.

    A lost executor later costs a read of the table and no new computation.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes the files of ``staged`` tables that nothing reads again.

    Shuffle files of finished writes but the latest go too: Spark deletes them once the
    driver has collected its garbage, which it may not do for long by itself.
    """
    for df in tables:
        spark = df.sparkSession
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        free_shuffles(tables[0].sparkSession)


# A side of a join is broadcast only if it is counted and has at most so many rows.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame) -> DataFrame:
    """A written table of narrow rows, to be broadcast if a count shows that it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def vector_groups(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and a float64 matrix for each length of vector in the column.

    Rows that are null or empty or hold null or non-finite components are left out.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    good = np.isfinite(values)
    if flat.null_count:
        good &= ~flat.is_null().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    bad = np.concatenate(([0], np.cumsum(~good)))
    whole = (lengths > 0) & (bad[starts[1:]] == bad[starts[:-1]])
    for length in np.unique(lengths[whole]):
        rows = np.flatnonzero(whole & (lengths == length))
        yield rows, values[starts[rows][:, None] + np.arange(length)]


class Forest:
    """Disjoint sets over 0..n-1 with the smallest member as root."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True
