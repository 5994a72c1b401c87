"""Tables of snapshots: replays, merged parts, readers that began before, removal."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from kerbside.sources import snapshots


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/table"


def batch(spark, n, rows=20):
    ids = spark.range(n * rows, (n + 1) * rows).select("id", F.lit(n).alias("n"))
    at = F.timestamp_seconds(F.lit(1_706_700_000) + F.col("id") * 1800)
    return ids.withColumn("at", at).withColumn("slot", snapshots.slot_of("at"))


def held(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_parts_are_merged_while_reads_go_on(spark, path):
    for n in range(5):
        snapshots.append_batch(batch(spark, n), path, n, run="a", split=("slot",))
    before = snapshots.latest(spark, path)
    reader = snapshots.read(spark, path, before)
    assert held(reader) == list(range(100))
    for n in range(5, 12):
        snapshots.append_batch(batch(spark, n), path, n, run="a", split=("slot",))
        snapshots.compact(spark, path, fan_in=3)
    now = snapshots.latest(spark, path)
    assert held(snapshots.read(spark, path)) == list(range(240))
    assert len(now.parts) <= 2 * 3 and max(p["generation"] for p in now.parts) == 2
    days = len({r.slot for r in snapshots.read(spark, path).select("slot").collect()})
    files = [f for p in now.parts for f in glob.glob(f"{path[7:]}/{p['folder']}/*/*.parquet")]
    assert len(files) <= days * len(now.parts)
    # The reader planned before all that, and what it named is still there.
    assert held(reader) == held(snapshots.read(spark, path, before)) == list(range(100))
    assert snapshots.vacuum(spark, path, versions=1, older_than_s=3600) == 0
    assert snapshots.vacuum(spark, path, versions=1, older_than_s=-60) > 5
    assert held(snapshots.read(spark, path)) == list(range(240))
    folders = {os.path.basename(f) for f in glob.glob(f"{path[7:]}/snapshot_part=*")}
    assert folders == {p["folder"] for p in snapshots.latest(spark, path).parts}


def test_replayed_batches_are_stored_once(spark, path):
    for n in (0, 1, 1, 0):
        snapshots.append_batch(batch(spark, n), path, n, run="a")
    assert held(snapshots.read(spark, path)) == list(range(40))
    snapshots.append_batch(batch(spark, 7), path, 0, run="b")
    snapshots.compact(spark, path, fan_in=2)
    assert snapshots.latest(spark, path).merged == {"a": 1, "b": 0}
    snapshots.append_batch(batch(spark, 1), path, 1, run="a")  # merged already
    assert held(snapshots.read(spark, path)) == [*range(40), *range(140, 160)]
    snapshots.append_batch(batch(spark, 2), path, 2, run="a")
    assert held(snapshots.read(spark, path)) == [*range(60), *range(140, 160)]


def test_a_batch_replayed_during_a_merge_is_not_lost(spark, path):
    for n in range(3):
        snapshots.append_batch(batch(spark, n), path, n, run="a")
    again = []

    def fold(rows):
        if not again:
            again.append(snapshots.append_batch(batch(spark, 2), path, 2, run="a"))
        return rows

    snapshots.compact(spark, path, fold=fold, fan_in=3)
    assert held(snapshots.read(spark, path)) == list(range(60))
    assert [p["generation"] for p in snapshots.latest(spark, path).parts] == [1]


def test_two_writers_of_one_number(spark, path, monkeypatch):
    snapshots.append_batch(batch(spark, 0), path, 0, run="a")
    real, stale = snapshots.latest, snapshots.latest(spark, path)
    snapshots.append_batch(batch(spark, 1), path, 1, run="a")
    answers = [stale, stale]
    monkeypatch.setattr(snapshots, "latest", lambda *a: answers.pop() if answers else real(*a))
    snapshots.append_batch(batch(spark, 2), path, 0, run="b")
    monkeypatch.undo()
    assert held(snapshots.read(spark, path)) == list(range(60))
    assert real(spark, path).version == 3


def test_columns_are_added_and_not_changed(spark, path):
    snapshots.append_batch(spark.createDataFrame([(1,)], "id long"), path, 0, run="a")
    snapshots.append_batch(spark.createDataFrame([(2, "x")], "id long, b string"), path, 1, run="a")
    snapshots.append_batch(spark.createDataFrame([], "id long"), path, 2, run="a")
    want = [(1, None), (2, "x")]
    assert sorted(map(tuple, snapshots.read(spark, path).collect())) == want
    snapshots.compact(spark, path, fan_in=2)
    assert sorted(map(tuple, snapshots.read(spark, path).collect())) == want
    with pytest.raises(ValueError, match="column id"):
        snapshots.append_batch(spark.createDataFrame([("x",)], "id string"), path, 3, run="a")
    with pytest.raises(ValueError, match="no snapshot"):
        snapshots.read(spark, f"{path}-absent")


def test_a_replaced_table_keeps_its_last_batches(spark, path):
    for n in range(4):
        snapshots.append_batch(batch(spark, n), path, n, run="a")
        snapshots.keep_batches(spark, path, "a", n - 1)
    assert [p["batch"] for p in snapshots.latest(spark, path).parts] == [2, 3]
