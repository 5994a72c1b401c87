"""When each passage is due in a sped-up replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: replay speed, event seconds per wall-clock second.
SPEED_FACTOR = 720


def replay_schedule(passages: DataFrame, speed_factor: float = SPEED_FACTOR) -> DataFrame:
    """Adds ``offset_s``: seconds after the start of the replay.

    The origin is the earliest time of the whole table, taken as a scalar
    subquery, so the rows themselves are neither sorted nor shuffled. Summing
    the gaps of consecutive rows in time order gives the same number.
    """
    origin = passages.agg(F.min("timestamp").alias("origin")).scalar()
    offset_us = F.unix_micros("timestamp") - F.unix_micros(origin)
    return passages.withColumn("offset_s", offset_us / F.lit(1e6) / F.lit(float(speed_factor)))


def event_gap(passages: DataFrame, speed_factor: float = SPEED_FACTOR) -> DataFrame:
    """Wall-clock seconds since the previous passage of the same road.

    One row per (road, instant) with the number of passages due then; a road's
    first instant has gap 0. Passages of one instant are counted before the
    shuffle. Inside an hour the gap is a ``lag``, so one road spreads over many
    tasks; each hour's first instant takes its predecessor from the small table
    of last instants per (road, hour).
    """
    # A road that is never NULL, so that the window and the join share one shuffle.
    road = F.when(F.col("highway_id").isNull(), "").otherwise(
        F.concat(F.lit("="), F.col("highway_id").cast("string"))
    )
    instants = (
        passages.where(F.col("timestamp").isNotNull())
        .groupBy("highway_id", "timestamp")
        .agg(F.count(F.lit(1)).alias("passages"))
        .withColumns({"road": road, "hour": F.date_trunc("hour", "timestamp")})
    )
    inside = Window.partitionBy("road", "hour").orderBy("timestamp")
    # The count travels along, so that both uses of the instants are one scan and shuffle.
    hours = instants.groupBy("road", "hour").agg(F.max(F.struct("timestamp", "passages")).alias("last"))
    carried = hours.select(
        "road",
        "hour",
        F.lag("last").over(Window.partitionBy("road").orderBy("hour"))["timestamp"].alias("carried"),
    )
    previous = F.coalesce(F.col("lagged"), F.col("carried"), F.col("timestamp"))
    gap_us = F.unix_micros("timestamp") - F.unix_micros(previous)
    return (
        instants.withColumn("lagged", F.lag("timestamp").over(inside))
        .join(carried, ["road", "hour"], "left")
        .select(
            "highway_id",
            "timestamp",
            "passages",
            (gap_us / F.lit(1e6) / F.lit(float(speed_factor))).alias("gap_s"),
        )
    )
