"""Hour rules, minute spine, volumes, replay times."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.operators import profile, replay
from kerbside.schema import PASSAGES

T0 = datetime(2025, 1, 31)


def passages(spark, *rows):
    full = [(T0 + timedelta(seconds=s), road, f"A-B {n:03d}", speed, ev)
            for n, (road, s, speed, ev) in enumerate(rows)]
    return spark.createDataFrame(full, PASSAGES)


@pytest.mark.parametrize(
    "road, hour, rate, speed",
    [(0, 23, 20, 40), (0, 4, 20, 40), (0, 5, 40, 38), (0, 7, 80, 32), (0, 10, 40, 38),
     (0, 18, 70, 35), (1, 23, 15, 42), (1, 22, 30, 39), (2, 15, 35, 40), (3, 4, 45, 41), (3, 7, 70, 40)],
)
def test_first_rule_that_holds(spark, road, hour, rate, speed):
    hourly = profile.hourly_profile(profile.rule_table(spark))
    row = hourly.where((F.col("highway_id") == road) & (F.col("hour") == hour)).first()
    assert (row.base_rate, row.expected_speed) == (rate, speed)


def test_every_hour_has_one_rule_and_the_day_its_total(spark):
    hourly = profile.hourly_profile(profile.rule_table(spark))
    assert hourly.count() == 4 * 24
    per_day = {r.highway_id: r.n for r in
               hourly.groupBy("highway_id").agg((F.sum("base_rate") * 60).alias("n")).collect()}
    assert sum(per_day.values()) == 192_000
    assert per_day == {0: 60_000, 1: 43_500, 2: 27_000, 3: 61_500}


def test_spine_and_volume(spark):
    rows = passages(spark, (0, 30, 10.0, True), (0, 59, 30.0, False), (0, 86400 + 60, 50.0, False))
    spine = profile.minute_spine(profile.rule_table(spark), rows)
    assert spine.count() == 4 * 2 * 1440
    volume = profile.volume_per_minute(rows, spine)
    assert volume.count() == spine.count()
    busy = {(r.highway_id, r.minute): r.cars for r in volume.where("cars > 0").collect()}
    assert busy == {(0, T0): 2, (0, T0 + timedelta(days=1, minutes=1)): 1}


def test_deviation(spark):
    rows = passages(spark, (0, 30, 10.0, True), (0, 59, 30.0, False))
    rules = profile.rule_table(spark)
    compared = profile.profile_deviation(rows, rules)
    row = compared.where((F.col("highway_id") == 0) & (F.col("minute") == T0)).first()
    assert (row.cars, row.cars_deviation, row.avg_speed, row.speed_deviation) == (2, -18, 20.0, -20.0)
    assert row.ev_share == 0.5 and row.ev_deviation == pytest.approx(0.3)
    empty = compared.where((F.col("highway_id") == 1) & (F.col("minute") == T0)).first()
    assert (empty.cars, empty.cars_deviation, empty.avg_speed) == (0, -15, None)


def test_offset_is_the_running_sum_of_gaps(spark):
    rows = passages(spark, (0, 7200, 1.0, False), (0, 0, 1.0, False), (0, 0, 2.0, False),
                    (0, 3599, 1.0, False), (0, 200_000, 1.0, False), (0, 7201, 1.0, False))
    offsets = {r.timestamp: r.offset_s for r in replay.replay_schedule(rows).collect()}
    gaps = sorted((r.timestamp, r.passages, r.gap_s) for r in replay.event_gap(rows).collect())
    assert sum(n for _, n, _ in gaps) == 6
    total = 0.0
    for time, _, gap in gaps:
        total += gap
        assert total == pytest.approx(offsets[time])
    assert max(offsets.values()) == pytest.approx(200_000 / 720)


def test_gaps_are_per_road(spark):
    rows = passages(spark, (0, 0, 1.0, False), (1, 360, 1.0, False), (0, 720, 1.0, False))
    gaps = {(r.highway_id, r.timestamp): r.gap_s for r in replay.event_gap(rows).collect()}
    assert gaps == {(0, T0): 0.0, (1, T0 + timedelta(seconds=360)): 0.0, (0, T0 + timedelta(seconds=720)): 1.0}


def test_origin_needs_no_join_and_no_sort(spark):
    plan = replay.replay_schedule(passages(spark, (0, 0, 1.0, False)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Sort" not in text and "Window" not in text


def test_expected_rows_are_those_of_the_spine(spark):
    rows = passages(spark, (0, 30, 10.0, True), (0, 90_000, 30.0, False))
    rules = profile.rule_table(spark)
    keys = profile.expected_profile(rules, rows).select("highway_id", "minute")
    spine = profile.minute_spine(rules, rows)
    assert keys.count() == spine.count() == 4 * 2 * 1440
    assert keys.exceptAll(spine).count() == 0


def test_spine_is_never_broadcast(spark):
    rows = passages(spark, (0, 30, 10.0, True))
    plan = profile.profile_deviation(rows, profile.rule_table(spark))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_given_span_bounds_the_profile_and_keeps_what_lies_outside(spark):
    rows = passages(spark, (0, 0, 10.0, False), (0, -50 * 365 * 86_400, 20.0, False))
    rules = profile.rule_table(spark)
    spine = profile.minute_spine(rules, rows, ("2025-01-31", "2025-01-31"))
    assert spine.count() == 4 * 1440
    compared = profile.profile_deviation(rows, rules, ("2025-01-31", "2025-01-31"))
    assert compared.count() == 4 * 1440 + 1
    outside = compared.where(F.col("base_rate").isNull()).first()
    assert (outside.cars, outside.avg_speed) == (1, 20.0)
