"""Counts over any time range from roll-ups of several bucket lengths and, at its ends, raw rows.

A range is covered by the longest aligned buckets that fit, then by shorter ones
on both sides; only what is left at the two ends is counted from raw rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.log_counts import step_us
from kerbside.operators.log_filters import label
from kerbside.sources.snapshots import SLOT, SLOT_FORMS

Piece = tuple[int | None, int, int]


def cover(start: int, end: int, steps: list[int]) -> list[Piece]:
    """[start, end) as pieces (step, from, to), in order; step None is for raw rows.

    There are at most two pieces of each step, longest steps in the middle.
    """
    if start >= end:
        return []
    if not steps:
        return [(None, start, end)]
    step, *shorter = sorted(steps, reverse=True)
    first, last = -(-start // step) * step, end // step * step
    if first >= last:
        return cover(start, end, shorter)
    return cover(start, first, shorter) + [(step, first, last)] + cover(last, end, shorter)


def _within(time: Column, pieces: list[Piece]) -> Column:
    inside = [
        (time >= F.timestamp_micros(F.lit(a))) & (time < F.timestamp_micros(F.lit(b))) for _, a, b in pieces
    ]
    return reduce(lambda x, y: x | y, inside, F.lit(False))


def _in_slots(rows: DataFrame, pieces: list[Piece], unit: str) -> DataFrame:
    """Rows in the slots that the pieces touch, so that no other folder is opened."""
    form = SLOT_FORMS[unit]
    ends = [
        F.col(SLOT).between(
            F.date_format(F.timestamp_micros(F.lit(a)), form),
            F.date_format(F.timestamp_micros(F.lit(b - 1)), form),
        )
        for _, a, b in pieces
    ]
    return rows.where(reduce(lambda x, y: x | y, ends, F.lit(False)))


def range_pieces(logs: DataFrame, start: str, end: str, steps: list[str], step: str | None) -> list[Piece]:
    """How [start, end) is covered: by those steps that divide the output's ``step``."""
    spark = logs.sparkSession
    times = [F.unix_micros(F.lit(t).cast("timestamp")) for t in (start, end)]
    first, last = spark.range(1).select(*times).first()
    lengths = [step_us(spark, s) for s in steps]
    if step is not None:
        lengths = [us for us in lengths if step_us(spark, step) % us == 0]
    return cover(first, last, lengths)


def range_counts(
    rollup: DataFrame,
    logs: DataFrame,
    start: str,
    end: str,
    steps: list[str],
    step: str | None = None,
    slots: str | None = None,
) -> DataFrame:
    """Rows per level with ``start <= ts < end``, per bucket of ``step`` if one is given.

    ``rollup`` has ``step, bucket, service, level, count`` (and may hold several
    deltas of a bucket), ``steps`` are its bucket lengths. ``logs`` are the raw rows;
    where their table is split by :func:`kerbside.sources.snapshots.slot_of`, ``slots``
    names the unit, and only the slots at the two ends of the range are opened. Equals
    counting the raw rows, whatever the range.
    """
    spark = logs.sparkSession
    pieces = range_pieces(logs, start, end, steps, step)
    raw = [p for p in pieces if p[0] is None]
    rows = _in_slots(logs, raw, slots) if slots else logs
    rows = rows.where(_within(F.col("ts"), raw))
    level = F.coalesce(label("level"), F.lit("")).alias("level")
    counted = rows.select(F.col("ts").alias("at"), level, F.lit(1).cast("long").alias("count"))
    for name in steps:
        mine = [p for p in pieces if p[0] == step_us(spark, name)]
        if mine:
            held = rollup.where((F.col("step") == name) & _within(F.col("bucket"), mine))
            held = _in_slots(held, mine, "day") if SLOT in rollup.columns else held
            counted = counted.unionByName(held.select(F.col("bucket").alias("at"), "level", "count"))
    if step is None:
        return counted.groupBy("level").agg(F.sum("count").alias("count"))
    summed = counted.groupBy(F.window("at", step).alias("w"), "level").agg(F.sum("count").alias("count"))
    return summed.select(F.col("w.start").alias("bucket"), "level", "count")
