"""Counting and averaging log rows over time.

Buckets are tumbling windows as long as the step. Every aggregate is partial
before its shuffle and its key includes the bucket, so a label that holds a
large share of all rows costs no task more than its own partial results.
The functions work on bounded tables and on streams alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.matching import match_pattern
from kerbside.functions.units import READERS
from kerbside.operators.log_filters import label


def _bucketed(rows: DataFrame, step: str, *keys: Column) -> DataFrame:
    return rows.groupBy(F.window("ts", step).alias("w"), *keys)


def log_count(logs: DataFrame) -> DataFrame:
    return logs.agg(F.count(F.lit(1)).alias("count"))


def counts_by_label(
    logs: DataFrame, name: str, step: str, require_label: bool = False
) -> DataFrame:
    """Rows per bucket and label value; rows without the label count under ``''``."""
    value = F.coalesce(label(name), F.lit(""))
    rows = logs.where(value != "") if require_label else logs
    counted = _bucketed(rows, step, value.alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(F.col("w.start").alias("bucket"), "value", "count")


def counts_by_field(parsed: DataFrame, field: str, step: str) -> DataFrame:
    """Rows per bucket and value of a parsed field, rows without it left out.

    The absent field is left out by its count, after the aggregation: a filter
    before it would make the scan parse every line twice.
    """
    rows = parsed.select("ts", F.col("fields")[field].alias("value"))
    counted = _bucketed(rows, step, F.col("value")).agg(F.count("value").alias("count"))
    return counted.where(F.col("count") > 0).select(F.col("w.start").alias("bucket"), "value", "count")


def avg_field(parsed: DataFrame, field: str, step: str, unit: str = "float") -> DataFrame:
    """Mean of a numeric field per bucket; text that is no such number is left out.

    ``unit`` is ``float``, ``duration`` (to seconds) or ``bytes``.
    """
    text = parsed.select("ts", F.col("fields")[field].alias("text"))
    rows = text.select("ts", READERS[unit](F.col("text")).alias("number"))
    averaged = _bucketed(rows, step).agg(F.avg("number").alias("avg"), F.count("number").alias("count"))
    return averaged.where(F.col("count") > 0).select(F.col("w.start").alias("bucket"), "avg", "count")


def label_volume(logs: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """Bytes of lines per label value, largest first; all of them, or the first ``limit``."""
    volumes = (
        logs.where(label(name).isNotNull())
        .groupBy(label(name).alias("value"))
        .agg(F.sum(F.octet_length("line")).alias("volume"))
        .orderBy(F.col("volume").desc(), F.col("value"))
    )
    return volumes if limit is None else volumes.limit(limit)


def build_rollup(logs: DataFrame, step: str = "1 hour") -> DataFrame:
    """Pre-aggregated rows: count per bucket, service and level."""
    counted = _bucketed(
        logs,
        step,
        F.coalesce(label("service"), F.lit("")).alias("service"),
        F.coalesce(label("level"), F.lit("")).alias("level"),
    ).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(F.col("w.start").alias("bucket"), "service", "level", "count")


def step_us(spark: SparkSession, step: str) -> int:
    """Microseconds of a bucket length such as ``1 hour``."""
    moved = F.lit("1970-01-01 00:00:00").cast("timestamp") + F.expr(f"interval {step}")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp")
    length = F.unix_micros(moved) - F.unix_micros(start)
    return spark.range(1).select(length).first()[0]


def rollup_counts(rollup: DataFrame, step: str, rollup_step: str = "1 hour") -> DataFrame:
    """Rows per bucket and level from a roll-up built with ``rollup_step``.

    Equals :func:`counts_by_label` on the raw rows for the level label. The
    roll-up's step must divide ``step``, or its buckets would straddle two.
    """
    if step_us(rollup.sparkSession, step) % step_us(rollup.sparkSession, rollup_step):
        raise ValueError(f"a roll-up by {rollup_step} cannot be read by {step}")
    summed = rollup.groupBy(F.window("bucket", step).alias("w"), "level").agg(
        F.sum("count").alias("count")
    )
    return summed.select(F.col("w.start").alias("bucket"), "level", "count")


def pattern_series(logs: DataFrame, patterns: list[str], step: str) -> DataFrame:
    """Rows per bucket for every given pattern, with the pattern's total.

    The patterns of one row are found in place, so there is no join; rows meet
    only as partial counts per (pattern, bucket). Patterns with the largest
    total come first.
    """
    hits = F.array_compact(
        F.array(*[F.when(match_pattern(F.col("line"), p), F.lit(p)) for p in patterns])
    )
    series = (
        logs.select("ts", F.explode(hits).alias("pattern"))
        .groupBy("pattern", F.window("ts", step).alias("w"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select("pattern", F.col("w.start").alias("bucket"), "count")
    )
    totals = series.groupBy("pattern").agg(F.sum("count").alias("total"))
    return series.join(totals, "pattern").orderBy(F.col("total").desc(), "pattern", "bucket")


REDUCERS = {
    "stddev": lambda v: F.stddev_pop(v),
    "sum": lambda v: F.sum(v),
    "max": lambda v: F.max(v),
    "min": lambda v: F.min(v),
}


def rank_series(series: DataFrame, by: str = "stddev", ascending: bool | None = None) -> DataFrame:
    """One row per series (``series, bucket, value`` in), in rank order.

    ``by`` is stddev, sum, max, min or name. Numbers run from large to small
    and names from A to Z unless ``ascending`` says otherwise.
    """
    value = F.col("value").cast("double")
    reduced = series.groupBy("series").agg(*[f(value).alias(n) for n, f in REDUCERS.items()])
    if by == "name":
        key = F.col("series")
        return reduced.orderBy(key.desc() if ascending is False else key.asc())
    key = F.col(by)
    return reduced.orderBy(key.asc() if ascending else key.desc(), F.col("series"))
