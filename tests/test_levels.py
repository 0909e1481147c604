"""Tables behind a manifest, and state in levels of runs."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tillwright.sinks import keyvalue, manifest
from tillwright.sinks.keyvalue import put_batch, read_state, runs_of
from tillwright.sinks.manifest import read_version, write_version


def test_a_version_may_be_made_from_the_one_it_replaces(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert read_version(spark, path) is None
    write_version(spark.range(3).coalesce(1), path)
    before = read_version(spark, path)
    write_version(before.select((F.col("id") + 10).alias("id")), path)
    assert rows(before) == [(0,), (1,), (2,)]
    assert rows(read_version(spark, path)) == [(10,), (11,), (12,)]


def test_a_write_that_stops_before_its_manifest_changes_nothing(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_version(spark.range(2).coalesce(1), path)

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(manifest, "publish", stop)
        with pytest.raises(KeyboardInterrupt):
            write_version(spark.range(9).coalesce(1), path)
    assert rows(read_version(spark, path)) == [(0,), (1,)]
    write_version(spark.range(1).coalesce(1), path)
    assert rows(read_version(spark, path)) == [(0,)]


def test_a_second_writer_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(spark.range(1).coalesce(1), path)
    stale = manifest.latest(spark, path)
    write_version(spark.range(2).coalesce(1), path)
    with pytest.raises(RuntimeError, match="another writer"):
        manifest.publish(spark, path, {}, ["data-x"], stale)


def test_old_manifests_and_their_folders_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "KEPT", 3)
    path = str(tmp_path / "t")
    for n in range(8):
        write_version(spark.range(n).coalesce(1), path)
    folders = [f for f in os.listdir(path) if f.startswith("data-")]
    kept = [f for f in os.listdir(f"{path}/_manifest") if f.endswith(".json")]
    assert len(folders) == len(kept) == 3 and read_version(spark, path).count() == 7


def test_runs_stay_few_over_many_batches(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(keyvalue, "FANOUT", 3)
    path, expected, most = str(tmp_path / "s"), {}, 0
    for batch in range(41):
        changed = {f"k{(batch * 7 + i) % 12}": batch * 100 + i for i in range(3)}
        expected |= changed
        put_batch(spark.createDataFrame(list(changed.items()), "k string, v int").coalesce(1), path, batch, ["k"])
        most = max(most, len(runs_of(spark, path)))
    # Three runs on each of the levels 0 to 3, where single batches would be 41.
    assert most <= 12 and {run["level"] for run in runs_of(spark, path)} >= {0, 2}
    assert rows(read_state(spark, path, ["k"])) == sorted(expected.items())
    listed = [f for f in os.listdir(path) if f.startswith("data-")]
    assert len(listed) <= 12 + 3 * manifest.KEPT


def test_readers_keep_the_runs_they_began_with(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(keyvalue, "FANOUT", 2)
    path = str(tmp_path / "s")
    make = lambda v: spark.createDataFrame([("a", v)], "k string, v int")
    for batch in range(3):
        put_batch(make(batch), path, batch, ["k"])
    reader = read_state(spark, path, ["k"])
    for batch in range(3, 8):
        put_batch(make(batch), path, batch, ["k"])
    assert rows(reader) == [("a", 2)] and rows(read_state(spark, path, ["k"])) == [("a", 7)]


def test_the_last_batch_is_replaced_when_it_runs_again_even_as_levels_fill(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(keyvalue, "FANOUT", 2)
    path = str(tmp_path / "s")
    for batch in range(6):
        for attempt in range(2):
            frame = spark.createDataFrame([(f"k{batch}", 10 * batch + attempt)], "k string, v int")
            put_batch(frame, path, batch, ["k"])
    assert rows(read_state(spark, path, ["k"])) == [(f"k{b}", 10 * b + 1) for b in range(6)]
