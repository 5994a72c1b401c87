"""Passages per minute against the expected daily profile of each road."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Road, name, share of electric vehicles, then the hour rules in
# order of priority as (from hour, to hour, cars per minute, speed). A rule
# whose first hour is after its second wraps over midnight; the last rule of a
# road holds at any hour.
ROADS = [
    (0, "Frankfurter Allee", 0.20, [(22, 5, 20, 40), (7, 10, 80, 32), (17, 19, 70, 35), (0, 24, 40, 38)]),
    (1, "Kaiserdamm", 0.18, [(23, 6, 15, 42), (8, 10, 60, 35), (16, 18, 55, 38), (0, 24, 30, 39)]),
    (2, "Tempelhofer Damm", 0.12, [(21, 7, 10, 45), (9, 11, 40, 37), (15, 17, 35, 40), (0, 24, 20, 43)]),
    (3, "Leipziger Straße", 0.21, [(20, 4, 25, 42), (5, 8, 70, 40), (14, 16, 60, 38), (0, 24, 45, 41)]),
]

# First and last day of a profile.
Span = tuple[date | str, date | str]

RULES = T.StructType(
    [
        T.StructField("highway_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("ev_rate", T.DoubleType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("from_h", T.IntegerType()),
        T.StructField("to_h", T.IntegerType()),
        T.StructField("base_rate", T.IntegerType()),
        T.StructField("speed", T.IntegerType()),
    ]
)


def rule_table(spark: SparkSession) -> DataFrame:
    """The hour rules of all roads, one row per rule."""
    rows = [
        (road, name, ev_rate, priority, *rule)
        for road, name, ev_rate, rules in ROADS
        for priority, rule in enumerate(rules, start=1)
    ]
    return spark.createDataFrame(rows, RULES)


def hourly_profile(rules: DataFrame) -> DataFrame:
    """Expected rate and speed per road and hour of day: the first rule that holds.

    Rules are spelled out to the hours they cover: 24 rows per road.
    """
    hour = F.col("hour")
    ordinary = (F.col("from_h") <= hour) & (hour < F.col("to_h"))
    wrapped = (F.col("from_h") > F.col("to_h")) & ((hour >= F.col("from_h")) | (hour < F.col("to_h")))
    first = F.min_by(F.struct("name", "ev_rate", "base_rate", "speed"), "priority").alias("rule")
    return (
        rules.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
        .where(ordinary | wrapped)
        .groupBy("highway_id", "hour")
        .agg(first)
        .select(
            "highway_id",
            "hour",
            "rule.name",
            "rule.ev_rate",
            "rule.base_rate",
            F.col("rule.speed").alias("expected_speed"),
        )
    )


def _on_every_day(rows: DataFrame, passages: DataFrame, span: Span | None) -> DataFrame:
    """Each row once for every day of ``span``, as ``day``.

    Without it, for every day the passages span: a scalar subquery, which scans
    their times once more. What follows unfolds a day to its minutes, so the rows
    are dealt out by (road, day) first; the number of partitions is given, because
    adaptive execution would judge by the small size before the unfolding.
    """
    if span is None:
        ends = F.struct(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
        ends = passages.agg(ends.alias("ends")).scalar()
        first, last = F.to_date(ends["first"]), F.to_date(ends["last"])
    else:
        first, last = (F.lit(day).cast("date") for day in span)
    days = F.explode(F.sequence(first, last, F.expr("interval 1 day")))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn("day", days).repartition(tasks, "highway_id", "day")


def _minutes(start: Column, count: int) -> Column:
    last = start + F.expr(f"interval {count - 1} minutes")
    return F.explode(F.sequence(start, last, F.expr("interval 1 minute")))


def minute_spine(roads: DataFrame, passages: DataFrame, span: Span | None = None) -> DataFrame:
    """Every minute of every day of ``span``, or that the passages span, for every road.

    One wrong time makes the passages' own span long: give ``span`` where times
    are not checked.
    """
    days = _on_every_day(roads.select("highway_id").distinct(), passages, span)
    return days.select("highway_id", _minutes(F.col("day").cast("timestamp"), 1440).alias("minute"))


def expected_profile(rules: DataFrame, passages: DataFrame, span: Span | None = None) -> DataFrame:
    """Expected cars per minute and speed for every road and minute of the spine.

    Each hour's rule is unfolded to the 60 minutes it holds for, which gives
    the rows of the spine with their rule, without a join.
    """
    hours = _on_every_day(hourly_profile(rules), passages, span)
    start = F.col("day").cast("timestamp") + F.make_dt_interval(hours=F.col("hour"))
    return hours.select(
        "highway_id",
        _minutes(start, 60).alias("minute"),
        "name",
        "ev_rate",
        "base_rate",
        "expected_speed",
    )


def minute_totals(passages: DataFrame) -> DataFrame:
    """Passages, mean speed and share of electric vehicles per road and minute."""
    timed = passages.where(F.col("timestamp").isNotNull())
    return timed.groupBy("highway_id", F.date_trunc("minute", "timestamp").alias("minute")).agg(
        F.count(F.lit(1)).alias("cars"),
        F.avg("speed").alias("avg_speed"),
        F.avg(F.col("ev").cast("double")).alias("ev_share"),
    )


def volume_per_minute(passages: DataFrame, spine: DataFrame) -> DataFrame:
    """Cars per road and minute, 0 where none passed.

    Passages outside the spine, as on a road without rules, keep their rows.
    """
    counts = minute_totals(passages).select("highway_id", "minute", "cars")
    return spine.join(counts, ["highway_id", "minute"], "full").select(
        "highway_id", "minute", F.coalesce("cars", F.lit(0)).alias("cars")
    )


def profile_deviation(passages: DataFrame, rules: DataFrame, span: Span | None = None) -> DataFrame:
    """Observed against expected per road and minute.

    Deviations are observed minus expected. A minute without passages counts
    as 0 cars and has no speed or share to compare; a road without rules has
    its observed values and nothing expected, and so has a minute outside ``span``.
    """
    expected = expected_profile(rules, passages, span)
    observed = minute_totals(passages)
    cars = F.coalesce("cars", F.lit(0))
    return expected.join(observed, ["highway_id", "minute"], "full").select(
        "highway_id",
        "minute",
        cars.alias("cars"),
        "base_rate",
        (cars - F.col("base_rate")).alias("cars_deviation"),
        "avg_speed",
        "expected_speed",
        (F.col("avg_speed") - F.col("expected_speed")).alias("speed_deviation"),
        "ev_share",
        "ev_rate",
        (F.col("ev_share") - F.col("ev_rate")).alias("ev_deviation"),
    )
