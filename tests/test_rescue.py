"""Unknown record members, and the largest values of a label."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kerbside.operators import log_counts, log_frequent
from kerbside.schema import LOGS, RECORDS
from kerbside.sources import rescue, snapshots
from kerbside.sources.records import decode_records, read_record_files
from kerbside.streaming.runs import finish, write_stream

T0 = datetime(2025, 1, 31)


def record(k, **more):
    body = {"timestamp": f"2025-01-31 00:00:{k:02d}", "highway_id": 1, "plate": "A-B 001", "speed": 1.5, "ev": False}
    return (b"1", json.dumps(body | more).encode())


def detail(decoded, members):
    rows = rescue.promote(rescue.with_rescued(decoded), members)
    return rows.select("timestamp", "speed", rescue.RESCUED, *members)


def test_new_members_are_kept_over_a_restart_and_promoted(spark, tmp_path):
    folder = f"file://{tmp_path}"

    def arrive(n, rows, members):
        spark.createDataFrame(rows, RECORDS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        out = detail(decode_records(read_record_files(spark, f"{folder}/in")), members)
        sink = snapshots.snapshot_writer(f"{folder}/t", "timestamp")
        finish([write_stream(out, "", f"{folder}/c", sink=sink)])

    arrive(0, [record(0), record(1, lane=2), record(2, lane="3", note={"a": 1}), record(3, speed=None, lane=None)], {})
    stored = snapshots.read(spark, f"{folder}/t")
    found = [tuple(r)[:3] for r in rescue.rescued_members(stored).collect()]
    assert found == [("lane", 2, "int"), ("note", 1, "string")]
    arrive(1, [record(4, lane=4), record(5, lane="left", other=True), (b"1", b"not json")], {"lane": "int"})
    stored = snapshots.read(spark, f"{folder}/t")
    assert stored.columns == ["timestamp", "speed", "rescued", "slot", "lane"]
    got = rescue.promote(stored, {"lane": "int"}).where("timestamp is not null")
    got = {r.timestamp.second: (r.lane, r.rescued) for r in got.collect()}
    assert got == {
        0: (None, None), 1: (2, None), 2: (3, {"note": '{"a":1}'}), 3: (None, None),
        4: (4, None), 5: (None, {"lane": "left", "other": "true"}),
    }


def logs_of(spark, values):
    rows = [(k, T0, {} if v is None else {"user": v}, "x" * (1 + k % 3)) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, LOGS)


def same_as_full(spark, logs, n, **options):
    got = log_frequent.top_values(logs, "user", n, **options)
    want = log_counts.label_volume(logs, "user", n)
    rows = got.collect()
    assert [(r.value, r.volume) for r in rows] == [tuple(r) for r in want.collect()]
    return {r.proof for r in rows}


@pytest.mark.parametrize("buckets", [1 << 16, 40, 3])
def test_largest_values(spark, buckets):
    values = [f"u{k % 9}" for k in range(300)] + [f"rare{k}" for k in range(500)] + [None, "", "é"]
    proof = same_as_full(spark, logs_of(spark, values), 5, buckets=buckets)
    assert proof == {"bound"} or buckets == 40


def test_values_that_no_bound_parts(spark, monkeypatch):
    logs = logs_of(spark, [f"u{k}" for k in range(400)])
    monkeypatch.setattr(log_frequent, "TRIES", 1)
    assert same_as_full(spark, logs, 3, buckets=64) == {"all values"}
    assert same_as_full(spark, logs, 1000, buckets=64) == {"bound"}  # all buckets were taken
    assert log_frequent.top_values(logs.limit(0), "user", 3).count() == 0
    by_rows = log_frequent.top_values(logs, "user", 2, F.lit(1)).collect()
    assert [(r.value, r.volume) for r in by_rows] == [("u0", 1), ("u1", 1)]
