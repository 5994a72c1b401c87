"""Passage files: CSV in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.event_time import format_event_time, parse_event_time
from kerbside.schema import DETAIL_COLUMNS, RAW_PASSAGES


def scan_raw_csv(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Passages from CSV with a header row, the time still as text.

    The schema is given, so no pass over the files is spent on inferring it.
    """
    reader = spark.readStream if streaming else spark.read
    return reader.schema(RAW_PASSAGES).option("header", True).csv(path)


def scan_csv(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Passages from CSV with the time parsed; a malformed time becomes NULL."""
    raw = scan_raw_csv(spark, path, streaming)
    return raw.withColumn("timestamp", parse_event_time(F.col("timestamp")))


def write_csv(passages: DataFrame, path: str) -> None:
    """Passages as CSV in time order: each part file covers one time range."""
    (
        passages.select(*DETAIL_COLUMNS)
        .sort("timestamp", "plate")
        .withColumn("timestamp", format_event_time(F.col("timestamp")))
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
