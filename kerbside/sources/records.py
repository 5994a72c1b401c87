"""Keyed JSON records: encoding, decoding, and the places they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.event_time import format_event_time, parse_event_time, truncate_to_ms
from kerbside.functions.road import encode_key, road_key
from kerbside.schema import DETAIL_COLUMNS, RAW_PASSAGES, RECORDS

# Fixed value: the topic both ends agree on.
TOPIC = "traffic-events"


def encode_records(passages: DataFrame, **members: Column) -> DataFrame:
    """One record per passage: the road number as key, the whole row as JSON.

    ``members`` are further members by name.
    """
    text = passages.withColumn("timestamp", format_event_time(F.col("timestamp")))
    more = [column.alias(name) for name, column in members.items()]
    value = F.to_json(F.struct(*DETAIL_COLUMNS, *more), {"ignoreNullFields": "false"})
    return text.select(
        encode_key(F.col("highway_id")).alias("key"),
        value.cast("binary").alias("value"),
    )


def decode_records(
    records: DataFrame, first_digit_only: bool = False, event_time: Column | None = None
) -> DataFrame:
    """Passages of a record stream plus the key and the untouched value.

    ``timestamp`` is parsed to a time cut to milliseconds; the text it came
    from stays in ``time_text``. Nothing is dropped here: malformed rows have a
    NULL ``timestamp`` and go to :func:`kerbside.operators.quality.split_bad_times`.
    ``event_time`` is a timestamp expression over the record's members, for
    records that carry their time in another way.
    """
    if event_time is None:
        event_time = parse_event_time(F.col("timestamp"))
    body = F.from_json(F.col("value").cast("string"), RAW_PASSAGES, {"mode": "PERMISSIVE"})
    # Unfolding the one-element array makes the parsed members columns of their
    # own, so that filters on them do not parse the value again.
    members = records.select("key", "value", F.inline(F.array(body)))
    return members.select(
        road_key(F.col("key"), first_digit_only).alias("road"),
        truncate_to_ms(event_time).alias("timestamp"),
        F.col("timestamp").alias("time_text"),
        *DETAIL_COLUMNS[1:],
        F.col("value").cast("string").alias("value"),
    )


def kafka_source_options(
    servers: str, topic: str = TOPIC, starting: str = "latest", max_per_trigger: int | None = None
) -> dict[str, str]:
    """Options of the Kafka source. Progress is kept in the query's checkpoint,
    so there is no consumer group to name."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_sink_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load().select("key", "value")


def write_kafka(records: DataFrame, options: dict[str, str]) -> None:
    """Send a bounded table of records; every task writes its own partition."""
    records.select("key", "value").write.format("kafka").options(**options).save()


def read_record_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Record stream from a folder of Parquet files with the topic's two columns."""
    reader = spark.readStream.schema(RECORDS)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
