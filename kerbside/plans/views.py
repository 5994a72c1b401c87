"""Passages, records and log rows as views over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions.event_time import truncate_to_ms

# Reading ``ts`` as a zoned timestamp keeps time predicates pushable.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The bracket makes the path a glob, which a stream needs where the table
    # is one file instead of a folder.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def passages_at_source(events: DataFrame, letters: int = 22) -> DataFrame:
    """Passages with the time as it is sent, in microseconds."""
    ev = F.col("event_type") == "purchase"

    def letter(n):
        return F.char(F.lit(65) + n % letters)

    plate = F.concat(
        letter(F.col("event_id")),
        F.lit("-"),
        letter(F.floor(F.col("event_id") / 22)),
        F.lit(" "),
        F.format_string("%03d", F.col("event_id") % 9999 + 1),
        F.when(ev, "E").otherwise(""),
    )
    return events.select(
        F.col("ts").alias("timestamp"),
        (F.col("user_id") % 4).cast("int").alias("highway_id"),
        plate.alias("plate"),
        F.col("value").alias("speed"),
        ev.alias("ev"),
    )


def passages(events: DataFrame) -> DataFrame:
    """Passages as they are stored, the time cut to milliseconds."""
    return passages_at_source(events).withColumn("timestamp", truncate_to_ms(F.col("timestamp")))


def logs(events: DataFrame, line: Column | None = None) -> DataFrame:
    """Log rows, by default with the JSON line of the event."""
    labels = F.create_map(
        F.lit("service"),
        F.concat(F.lit("s"), F.col("user_id") % 4),
        F.lit("level"),
        F.col("event_type"),
    )
    return events.select(
        F.col("event_id").alias("id"),
        "ts",
        labels.alias("labels"),
        (F.col("props") if line is None else line).alias("line"),
    )


def logfmt_logs(events: DataFrame) -> DataFrame:
    """Log rows with a logfmt line, values in cents so that no float is formatted."""
    cents = F.floor(F.col("value") * 100 + 0.5)
    line = F.concat(
        F.lit("level="),
        F.col("event_type"),
        F.lit(" cents="),
        cents,
        F.lit(" took="),
        cents,
        F.lit("ms size="),
        cents,
        F.lit('KiB user="u '),
        F.col("user_id"),
        F.lit('"'),
    )
    return logs(events, line)


def document_logs(documents: DataFrame) -> DataFrame:
    """Log rows without a time: the text as line, language and source as labels."""
    return documents.select(
        F.col("doc_id").alias("id"),
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("labels"),
        F.col("text").alias("line"),
    )
