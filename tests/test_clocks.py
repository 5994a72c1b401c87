"""One clock per road: late rows kept, their windows repaired, silent roads, replays."""

import glob
import os
from datetime import datetime, timedelta

import numpy as np
import pytest

from kerbside.operators.trailing import trailing_mean
from kerbside.schema import PASSAGES
from kerbside.sources import snapshots
from kerbside.streaming import clocks

T0 = datetime(2025, 1, 31, 23, 0, 0)


@pytest.fixture(autouse=True)
def few_tasks(spark):
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", tasks)


def table(spark, rows):
    full = [(T0 + timedelta(seconds=float(s)), road, "A-B 001", float(v), False) for road, s, v in rows]
    return spark.createDataFrame(full, PASSAGES)


def add_file(spark, folder, rows, number):
    add_table(table(spark, rows), folder, number)


def add_table(df, folder, number):
    path = f"{folder}/in/{number}"
    df.coalesce(1).write.parquet(path)
    for name in os.listdir(path):
        os.utime(f"{path}/{name}", (1_700_000_000 + number, 1_700_000_000 + number))


def run(spark, folder, **options):
    reader = spark.readStream.schema(PASSAGES).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    root = f"file://{folder}/tables"
    query = clocks.start_clocked(reader.parquet(f"{folder}/in"), root, f"{folder}/checkpoint", **options)
    query.awaitTermination()


def seconds(t):
    return round((t - T0).total_seconds(), 3)


def means(spark, folder):
    rows = clocks.read_means(spark, f"file://{folder}/tables").collect()
    return sorted((r.highway_id, seconds(r.window_end), round(r.avg_speed, 9)) for r in rows)


def late(spark, folder):
    rows = clocks.read_late(spark, f"file://{folder}/tables").collect()
    return sorted((r.highway_id, seconds(r.timestamp)) for r in rows)


def in_batch(spark, rows):
    got = trailing_mean(table(spark, rows)).collect()
    return sorted((r.highway_id, seconds(r.window_end), round(r.avg_speed, 9)) for r in got)


def test_a_road_that_is_ahead_makes_none_late(spark, tmp_path):
    files = [
        [(0, 60 * k + j, 10 + k + j) for j in range(0, 60, 7)] + [(1, 3600 + 60 * k + j, 30 + j) for j in range(0, 60, 11)]
        for k in range(4)
    ]
    for number, rows in enumerate(files):
        add_file(spark, str(tmp_path), rows, number)
    run(spark, str(tmp_path))
    assert late(spark, str(tmp_path)) == []
    assert means(spark, str(tmp_path)) == in_batch(spark, [r for rows in files for r in rows])


def test_history_out_of_order_equals_batch(spark, tmp_path):
    folder, rng = str(tmp_path), np.random.default_rng(3)
    rows = [(int(r), int(s), int(v)) for r, s, v in zip(rng.integers(0, 3, 400), rng.integers(0, 20_000, 400), rng.integers(1, 90, 400))]
    files = [rows[k::4] for k in range(4)]  # each file spans all the time
    expected, clock = [], {}
    for number, part in enumerate(files):
        add_file(spark, folder, part, number)
        expected += [(r, s) for r, s, _ in part if s <= clock.get(r, -1)]
        for r, s, _ in part:
            clock[r] = max(clock.get(r, -1), s)
    run(spark, folder, fan_in=3)
    assert late(spark, folder) == sorted(expected) and len(expected) > 200
    assert means(spark, folder) == in_batch(spark, rows)
    assert len(snapshots.latest(spark, f"file://{folder}/tables/passages").parts) <= 2


def test_windows_wait_for_the_delay_and_not_for_silent_roads(spark, tmp_path):
    folder = str(tmp_path)
    add_file(spark, folder, [(0, 0, 10), (0, 900, 20), (2, 100, 5)], 0)
    add_file(spark, folder, [(0, 700, 40), (0, 1600, 30)], 1)  # 700 is within the delay
    run(spark, folder, delay="10 minutes", silent_after="2 hours")
    assert late(spark, folder) == []
    assert means(spark, folder) == [("0", 0.0, 10.0), ("0", 700.0, 25.0), ("0", 900.0, round(70 / 3, 9))]
    add_file(spark, folder, [(0, 7400, 50)], 2)
    add_file(spark, folder, [(2, 90, 7), (0, 300, 8)], 3)  # both roads' clocks have passed these
    run(spark, folder, delay="10 minutes", silent_after="2 hours")
    assert late(spark, folder) == [(0, 300.0), (2, 90.0)]
    everything = [(0, 0, 10), (0, 900, 20), (2, 100, 5), (0, 700, 40), (0, 1600, 30), (2, 90, 7), (0, 300, 8)]
    assert means(spark, folder) == in_batch(spark, everything)  # 7400 is still open


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    files = [[(0, 0, 10), (1, 5, 20)], [(0, 1800, 30), (0, 600, 40)], [(0, 300, 50), (1, 1000, 60)]]
    for number, rows in enumerate(files):
        add_file(spark, folder, rows, number)
    run(spark, folder)
    want = means(spark, folder), late(spark, folder)
    assert want == (in_batch(spark, [r for rows in files for r in rows]), [(0, 300.0)])
    last = max(int(os.path.basename(f)) for f in glob.glob(f"{folder}/checkpoint/commits/[0-9]*"))
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    run(spark, folder)
    assert (means(spark, folder), late(spark, folder)) == want
    # Another checkpoint would store the same rows once more.
    reader = spark.readStream.schema(PASSAGES).option("recursiveFileLookup", True).parquet(f"{folder}/in")
    query = clocks.start_clocked(reader, f"file://{folder}/tables", f"{folder}/other")
    with pytest.raises(Exception, match="another checkpoint"):
        query.awaitTermination()


def test_rows_without_road_or_time_and_empty_batches(spark, tmp_path):
    folder = str(tmp_path)
    bad = spark.createDataFrame([(None, 1, "x", 1.0, False), (T0, None, "x", 1.0, False)], PASSAGES)
    add_table(bad, folder, 0)
    run(spark, folder)
    add_file(spark, folder, [(0, 0, 10)], 1)
    run(spark, folder)
    assert means(spark, folder) == [("0", 0.0, 10.0)] and late(spark, folder) == []
