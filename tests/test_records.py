"""Time text, record encoding and decoding, quarantine, CSV, source options."""

import json
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kerbside.functions.event_time import event_ms, format_event_time, parse_event_time
from kerbside.functions.road import encode_key, road_key, rounded_speed
from kerbside.operators.quality import plate_violations, split_bad_times, traffic_detailed
from kerbside.schema import PASSAGES, RECORDS
from kerbside.sources import passages as files
from kerbside.sources import records

GOOD = {"timestamp": "2025-01-31 00:00:01.5", "highway_id": 0, "plate": "B-A 001", "speed": 39.1, "ev": False}


def sent(spark, *messages):
    rows = [(key, value if value is None else value.encode()) for key, value in messages]
    return spark.createDataFrame(rows, RECORDS)


@pytest.mark.parametrize(
    "text, ms",
    [
        ("2025-01-31 00:00:01", 1738281601000),
        ("2025-01-31 00:00:01.5", 1738281601500),
        ("2025-01-31 00:00:01.123456", 1738281601123),
        ("2025-01-31 00:00:01.999999", 1738281601999),
        ("2025-1-3 1:2:3.25", 1735866123250),
        ("2025-01-31 00:00:01.123456789", None),
        ("2025-01-31 00:00:01.", None),
        ("2025-02-30 00:00:00", None),
        ("2025-01-31 24:00:00", None),
        ("2025-01-31 00:00:61", None),
        ("2025-01-31", None),
        ("2025-01-31T00:00:01", None),
        ("2025-01-31 00:00:01Z", None),
        (" 2025-01-31 00:00:01", None),
        ("12025-01-31 00:00:01", None),
        ("junk", None),
        (None, None),
    ],
)
def test_parse_event_time(spark, text, ms):
    row = spark.createDataFrame([(text,)], "t string").select(event_ms(parse_event_time(F.col("t"))))
    assert row.first()[0] == ms


@pytest.mark.parametrize("micros", [0, 1, 500_000, 123_456, 120_000])
def test_time_text_leaves_a_zero_fraction_out(spark, micros):
    time = datetime(2025, 1, 31, 0, 0, 1, micros)
    row = spark.createDataFrame([(time,)], "t timestamp").select(format_event_time(F.col("t"))).first()
    assert row[0] == str(time)


def test_round_trip(spark):
    rows = [
        (datetime(2025, 1, 31, 0, 0, 1), 12, "B-A 001E", 39.125, True),
        (datetime(2025, 1, 31, 0, 0, 1, 123000), 0, None, None, False),
    ]
    passages = spark.createDataFrame(rows, PASSAGES)
    encoded = records.encode_records(passages)
    assert json.loads(bytes(encoded.first().value)) == {
        "timestamp": "2025-01-31 00:00:01", "highway_id": 12, "plate": "B-A 001E", "speed": 39.125, "ev": True,
    }
    assert bytes(encoded.first().key) == b"12"
    decoded = records.decode_records(encoded)
    assert [tuple(r) for r in traffic_detailed(decoded).collect()] == rows
    assert [r.road for r in decoded.collect()] == ["12", "0"]


def test_road_key_is_whole_unless_asked(spark):
    row = spark.createDataFrame([(12,)], "n int").select(
        road_key(encode_key(F.col("n"))), road_key(encode_key(F.col("n")), first_digit_only=True)
    )
    assert tuple(row.first()) == ("12", "1")


def test_bad_rows_are_set_aside_with_their_value(spark):
    def body(**change):
        return json.dumps({k: v for k, v in {**GOOD, **change}.items() if v != "drop"})

    records_in = sent(
        spark,
        (b"0", body()),
        (b"1", body(timestamp="junk")),
        (b"2", body(timestamp=None)),
        (b"3", body(timestamp="drop")),
        (b"4", body(timestamp="2025-01-31 00:00:01.123456789")),
        (b"5", "{not json"),
        (b"6", None),
        (None, body()),
    )
    good, bad = split_bad_times(records.decode_records(records_in))
    assert [r.road for r in good.collect()] == ["0"]
    reasons = {r.road: r.reason for r in bad.collect()}
    assert reasons == {
        "1": "malformed time", "2": "no time", "3": "no time", "4": "malformed time",
        "5": "no time", "6": "no time", None: "no key",
    }
    assert {r.value for r in bad.collect() if r.road == "5"} == {"{not json"}


def test_value_is_parsed_once(spark):
    good, _ = split_bad_times(records.decode_records(sent(spark, (b"0", json.dumps(GOOD)))))
    plan = traffic_detailed(good)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_csv_round_trip_and_order(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/csv"
    rows = [
        (datetime(2025, 1, 31, 0, 0, 2, 5), 1, "B-A 002", 2.5, False),
        (datetime(2025, 1, 31, 0, 0, 1), 0, "B-A 001E", 1.5, True),
    ]
    files.write_csv(spark.createDataFrame(rows, PASSAGES), path)
    text = [r.value for r in spark.read.text(path).collect()]
    assert text[0] == "timestamp,highway_id,plate,speed,ev"
    assert text[1] == "2025-01-31 00:00:01,0,B-A 001E,1.5,true"
    assert sorted(tuple(r) for r in files.scan_csv(spark, path).collect()) == sorted(rows)


def test_csv_as_a_stream(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/csv"
    rows = [(datetime(2025, 1, 31, 0, 0, 1), 0, "B-A 001", 1.5, False)]
    files.write_csv(spark.createDataFrame(rows, PASSAGES), path)
    stream = files.scan_csv(spark, path, streaming=True)
    assert stream.isStreaming and stream.schema == files.scan_csv(spark, path).schema


def test_kafka_options():
    assert records.kafka_source_options("broker:9092", max_per_trigger=1000) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "traffic-events",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
    }
    assert records.kafka_sink_options("broker:9092", "other") == {
        "kafka.bootstrap.servers": "broker:9092", "topic": "other",
    }


def test_plate_rules(spark):
    plates = [
        ("A-B 001", False), ("AB-CD 1234E", True), ("A-B 001E", False), ("A-B 001", True),
        ("W-B 001", False), ("A-B 01", False), ("A-B 12345", False), ("ABC-B 001", False),
        (None, False), ("a-B 001", False),
    ]
    rows = spark.createDataFrame(plates, "plate string, ev boolean")
    counts = {r.rule: r.violations for r in plate_violations(rows).collect()}
    assert counts == {"malformed_plate": 6, "suffix_disagrees_with_ev": 3, "any_rule": 8}


def test_rounded_speed(spark):
    assert spark.range(1).select(rounded_speed(F.lit(38.12349))).first()[0] == 38.123


def test_event_time_can_come_from_elsewhere(spark):
    epoch = json.dumps({**GOOD, "timestamp": "1738281601500"})
    time = F.timestamp_millis(F.col("timestamp").cast("bigint"))
    row = records.decode_records(sent(spark, (b"0", epoch)), event_time=time).first()
    assert row.timestamp == datetime(2025, 1, 31, 0, 0, 1, 500000)
