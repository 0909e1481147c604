"""Tables whose files are named by a manifest that is published last.

Data goes to fresh folders and is never changed. A manifest says which folders make up the
table, and the newest one counts, so a write that stops anywhere before its manifest leaves
the table as it was, and readers of an older manifest are not disturbed. Only the last few
manifests are kept, with the folders they name; listing stays as short as that however
often a table is written. One writer at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

KEPT = 16


class Manifest(NamedTuple):
    version: int
    content: dict
    folders: list[str]


def _opened(spark: SparkSession, path: str):
    """The file system that a path lies in, and the path as it knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _file(path: str, version: int) -> str:
    return f"{path}/_manifest/{version:012d}.json"


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _opened(spark, f"{path}/_manifest")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(name[:-5]) for name in names if re.fullmatch(r"\d{12}\.json", name))


def _read(spark: SparkSession, path: str, version: int) -> Manifest:
    fs, at = _opened(spark, _file(path, version))
    stream = fs.open(at)
    try:
        kept = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Manifest(version, kept["content"], kept["folders"])


def latest(spark: SparkSession, path: str) -> Manifest | None:
    versions = _versions(spark, path)
    return _read(spark, path, versions[-1]) if versions else None


def fresh_folder() -> str:
    """A name under the table for data of a manifest to come."""
    return f"data-{uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, content: dict, folders: Iterable[str], after: Manifest | None) -> None:
    """Make ``content`` and ``folders`` the table, if ``after`` is still its newest manifest."""
    version = after.version + 1 if after else 0
    target = _file(path, version)
    fs, at = _opened(spark, target)
    _, draft = _opened(spark, f"{path}/_manifest/{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps({"content": content, "folders": sorted(folders)}).encode()))
    finally:
        stream.close()
    if fs.exists(at) or not fs.rename(draft, at):
        raise RuntimeError(f"another writer published version {version} of {path}")
    _expire(spark, path)


def _expire(spark: SparkSession, path: str) -> None:
    """Delete manifests beyond the last few, and what only they name."""
    versions = _versions(spark, path)
    for version, following in zip(versions[:-KEPT], versions[1:]):
        # A folder that has once left the table does not come back.
        gone = set(_read(spark, path, version).folders) - set(_read(spark, path, following).folders)
        for name in [*gone, f"_manifest/{version:012d}.json"]:
            fs, at = _opened(spark, f"{path}/{name}")
            fs.delete(at, True)


def write_version(rows: DataFrame, path: str) -> None:
    """Replace a table; ``rows`` may be made from the version that it replaces."""
    spark = rows.sparkSession
    before = latest(spark, path)
    folder = fresh_folder()
    rows.write.parquet(f"{path}/{folder}")
    publish(spark, path, {}, [folder], before)


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a table, or None if it has none."""
    found = latest(spark, path)
    return None if found is None else spark.read.parquet(f"{path}/{found.folders[0]}")
