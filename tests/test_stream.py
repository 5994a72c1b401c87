"""The streamed operators: equal to batch, late rows, restarts, replays."""

import json
import os
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.operators.log_counts import counts_by_label
from kerbside.operators.trailing import trailing_mean
from kerbside.plans import views
from kerbside.schema import AVERAGES, LOGS, PASSAGES, RECORDS
from kerbside.sources.records import decode_records, read_record_files
from kerbside.sources.tables import batch_writer, read_table
from kerbside.streaming.counts import counts_by_label_stream
from kerbside.streaming.runs import finish, start_outputs, write_stream
from kerbside.streaming.trailing import trailing_mean_stream

SF_DIR = "/root/testdata/sf0.001"
T0 = datetime(2025, 1, 31, 12, 0, 0)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(autouse=True)
def few_state_stores(spark):
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", tasks)


def add_file(spark, folder, rows, number):
    """One more file of (road, seconds after T0, speed), in a fixed order of arrival."""
    full = [(T0 + timedelta(seconds=s), road, "A-B 001", speed, False) for road, s, speed in rows]
    path = f"{folder}/in/{number}"
    spark.createDataFrame(full, PASSAGES).coalesce(1).write.parquet(path)
    for name in os.listdir(path):
        os.utime(f"{path}/{name}", (1_700_000_000 + number, 1_700_000_000 + number))


def arriving(spark, folder):
    reader = spark.readStream.schema(PASSAGES).option("maxFilesPerTrigger", 1)
    return reader.option("recursiveFileLookup", True).parquet(f"{folder}/in")


def run(spark, folder, **options):
    means = trailing_mean_stream(arriving(spark, folder), **{"watermark_delay": "0 seconds"} | options)
    query = write_stream(means, f"{folder}/out", f"{folder}/checkpoint")
    finish([query])
    return query


def stored(spark, folder):
    rows = read_table(spark, f"{folder}/out", AVERAGES).collect()
    return sorted((r.highway_id, int((r.window_end - T0).total_seconds()), r.avg_speed) for r in rows)


def in_batch(spark, rows):
    full = [(T0 + timedelta(seconds=s), road, "A-B 001", speed, False) for road, s, speed in rows]
    got = trailing_mean(spark.createDataFrame(full, PASSAGES)).collect()
    return sorted((r.highway_id, int((r.window_end - T0).total_seconds()), r.avg_speed) for r in got)


SLICES = [
    [(0, 5, 10.0), (0, 0, 20.0), (12, 60, 30.0), (0, 900, 40.0)],
    [(0, 1000, 50.0), (12, 1700, 60.0), (0, 1801, 70.0)],
    [(0, 2700, 80.0), (12, 3500, 90.0), (0, 3599, 15.0), (0, 3600, 25.0)],
    [(0, 3601, 35.0), (0, 5399, 45.0), (12, 5400, 55.0), (0, 9000, 65.0)],
]


def test_state_is_carried_over_batches_and_restarts(spark, folder):
    for number, rows in enumerate(SLICES[:2]):
        add_file(spark, folder, rows, number)
    run(spark, folder)
    for number, rows in enumerate(SLICES[2:], start=2):
        add_file(spark, folder, rows, number)
    run(spark, folder)
    assert stored(spark, folder) == in_batch(spark, [row for rows in SLICES for row in rows])


def test_late_row_is_dropped_and_counted(spark, folder):
    add_file(spark, folder, [(0, 0, 10.0), (0, 7200, 20.0)], 0)
    add_file(spark, folder, [(0, 7300, 30.0)], 1)
    add_file(spark, folder, [(0, 3600, 99.0), (0, 7400, 40.0)], 2)
    query = run(spark, folder)
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    assert dropped == 1
    assert stored(spark, folder) == [
        ("0", 0, 10.0), ("0", 7200, 20.0), ("0", 7300, 25.0), ("0", 7400, 30.0)
    ]


def test_delay_admits_the_row_and_keeps_newest_windows_open(spark, folder):
    add_file(spark, folder, [(0, 0, 10.0), (0, 7200, 20.0)], 0)
    add_file(spark, folder, [(0, 6600, 40.0), (0, 20000, 30.0)], 1)
    run(spark, folder, watermark_delay="1 hour")
    assert stored(spark, folder) == [("0", 0, 10.0), ("0", 6600, 40.0), ("0", 7200, 30.0)]


def test_failed_batch_is_replayed_without_duplicates(spark, folder):
    for number, rows in enumerate(SLICES):
        add_file(spark, folder, rows, number)
    write = batch_writer(f"{folder}/out")

    def write_then_fail(df, batch_id):
        write(df, batch_id)
        if batch_id == 2:
            raise RuntimeError("sink lost after writing")

    def start(sink):
        means = trailing_mean_stream(arriving(spark, folder), watermark_delay="0 seconds")
        writer = means.writeStream.outputMode("append").foreachBatch(sink)
        return writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()

    with pytest.raises(Exception, match="sink lost"):
        start(write_then_fail).awaitTermination()
    start(write).awaitTermination()
    assert stored(spark, folder) == in_batch(spark, [row for rows in SLICES for row in rows])


def test_fork_writes_detail_averages_and_quarantine(spark, folder):
    def record(key, time, speed):
        body = {"timestamp": time, "highway_id": key, "plate": "A-B 001", "speed": speed, "ev": False}
        return str(key).encode(), json.dumps(body).encode()

    sent = [
        record(12, "2025-01-31 12:00:00", 10.0),
        record(12, "2025-01-31 12:10:00.5", 20.0),
        record(12, "junk", 99.0),
        record(1, "2025-01-31 12:00:00", 30.0),
    ]
    spark.createDataFrame(sent, RECORDS).write.parquet(f"{folder}/records")
    decoded = decode_records(read_record_files(spark, f"{folder}/records"))

    def faster(rows):
        return rows.withColumn("speed", rows.speed + 1).withColumn("lane", F.lit(2))

    tables = f"{folder}/tables"
    finish(start_outputs(decoded, tables, f"{folder}/checkpoints", watermark_delay="0 seconds", transform=faster))
    detail = read_table(spark, f"{tables}/traffic_detailed").collect()
    assert sorted((r.highway_id, r.speed, r.lane) for r in detail) == [(1, 31.0, 2), (12, 11.0, 2), (12, 21.0, 2)]
    assert read_table(spark, f"{tables}/traffic_detailed", days=("2025-01-30", "2025-01-30")).count() == 0
    means = read_table(spark, f"{tables}/traffic_averages", AVERAGES).collect()
    assert sorted((r.highway_id, r.avg_speed) for r in means) == [("1", 31.0), ("12", 11.0), ("12", 16.0)]
    bad = read_table(spark, f"{tables}/quarantine").collect()
    assert [(r.road, r.reason) for r in bad] == [("12", "malformed time")]

    taken = {"traffic_averages": [], "quarantine": []}
    sinks = {name: lambda df, _, rows=rows: rows.extend(df.collect()) for name, rows in taken.items()}
    other = f"{folder}/other"
    finish(start_outputs(decoded, other, f"{other}/checkpoints", watermark_delay="0 seconds", sinks=sinks))
    assert sorted((r.highway_id, r.avg_speed) for r in taken["traffic_averages"]) == [
        ("1", 30.0), ("12", 10.0), ("12", 15.0),
    ]
    assert [r.reason for r in taken["quarantine"]] == ["malformed time"]
    assert read_table(spark, f"{other}/traffic_detailed").count() == 3
    assert not os.path.exists(f"{other}/quarantine")
    with pytest.raises(ValueError):
        start_outputs(decoded, other, other, watermark_delay="0 seconds", sinks={"x": print})


def test_counts_close_bucket_by_bucket(spark, folder):
    events = views.events(spark, SF_DIR)
    logs = views.logs(events)
    path = f"{folder}/in"
    logs.repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(path)
    for number, name in enumerate(sorted(n for n in os.listdir(path) if n.endswith(".parquet"))):
        os.utime(f"{path}/{name}", (1_700_000_000 + number, 1_700_000_000 + number))
    stream = spark.readStream.schema(LOGS).option("maxFilesPerTrigger", 1).parquet(path)
    counted = counts_by_label_stream(stream, "level", "1 hour", watermark_delay="2 hours")
    finish([write_stream(counted, f"{folder}/out", f"{folder}/checkpoint")])
    got = {tuple(r) for r in read_table(spark, f"{folder}/out", counted.schema).collect()}
    whole = {tuple(r) for r in counts_by_label(logs, "level", "1 hour").collect()}
    newest = max(bucket for bucket, _, _ in whole)
    assert got == {row for row in whole if row[0] < newest - timedelta(hours=2)}


def test_late_rows_of_all_batches_are_counted(spark, folder):
    """More batches than Spark remembers the progress of; the late row comes early."""
    keep = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        files = [[(0, 7200, 1.0)], [(0, 7300, 1.0)], [(0, 0, 9.0), (0, 7400, 1.0)], *[[(0, 7500 + k, 1.0)] for k in range(5)]]
        for number, rows in enumerate(files):
            add_file(spark, folder, rows, number)
        means = trailing_mean_stream(arriving(spark, folder), watermark_delay="0 seconds")
        query = write_stream(means, f"{folder}/out", f"{folder}/checkpoint")
        assert finish([query]) == 1
        assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 0
        with pytest.raises(ValueError, match="1 rows"):
            finish([query], allow_late=False)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", keep)
