"""Inputs that the given tables do not hold: one case each."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.functions import event_time, matching, units
from kerbside.operators import log_counts, log_discover, log_filters, log_parse
from kerbside.operators import profile, quality, replay, trailing
from kerbside.sources import tables

T0 = datetime(2025, 1, 31, 8)


def one(spark, text, expression):
    row = spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("v"))
    return row.first().v


@pytest.mark.parametrize("text", ["NaN", "Infinity", "95d", "95f", "0x7f", "", "9 5", "95\n"])
def test_text_that_is_no_number_never_matches(spark, text):
    assert one(spark, text, lambda c: matching.match_number(c, ">", 1.0)) is None
    assert one(spark, text, units.plain_number) is None


def test_numbers_match(spark):
    assert one(spark, "1.5e2", lambda c: matching.match_number(c, ">", 90.0)) is True


def test_large_sizes(spark):
    assert one(spark, "2EiB", units.size_bytes) == 2.0 * 2**60
    assert one(spark, "3 YB", units.size_bytes) == 3e24


def test_the_end_of_a_value_is_its_last_character(spark):
    assert one(spark, "error\n", lambda c: matching.full_match(c, "error")) is False
    assert one(spark, "2025-01-31 00:00:01\n", event_time.parse_event_time) is None


def logs(spark, *rows):
    return spark.createDataFrame(list(rows), "ts timestamp, labels map<string,string>, line string")


def test_flags_of_one_regex_do_not_leak(spark):
    rows = logs(spark, *[(T0, {"a": v}, "") for v in ("ERR", "warn", "WARN")])
    found = log_filters.label_multi_filter(rows, [("a", "=~", "(?i)err"), ("a", "=~", "warn")])
    assert sorted(r.labels["a"] for r in found.collect()) == ["ERR", "warn"]


@pytest.mark.parametrize(
    ("line", "value"),
    [(r'a="x\ny"', "x\ny"), (r'a="\té\""', '\té"'), (r'a="\q"', "q"), ('a="p q"', "p q"), ("a=x", "x")],
)
def test_logfmt_escapes(spark, line, value):
    assert one(spark, line, lambda c: log_parse.logfmt_fields(c)["a"]) == value


def test_rollup_step_has_to_divide(spark):
    rows = logs(spark, (T0 + timedelta(minutes=50), {"level": "a"}, ""), (T0 + timedelta(minutes=95), {"level": "a"}, ""))
    rollup = log_counts.build_rollup(rows)
    with pytest.raises(ValueError, match="roll-up"):
        log_counts.rollup_counts(rollup, "90 minutes")
    assert log_counts.rollup_counts(rollup, "2 hours").agg(F.sum("count")).first()[0] == 2


def test_lists_are_whole_by_default(spark):
    rows = spark.range(6000).select(
        F.lit(T0).alias("ts"), F.create_map(F.lit("a"), F.col("id").cast("string")).alias("labels"), F.lit("x").alias("line")
    )
    assert log_counts.label_volume(rows, "a").count() == 6000
    assert log_discover.label_values(rows, "a").count() == 6000
    assert log_counts.label_volume(rows, "a", 5).count() == log_discover.label_values(rows, "a", 5).count() == 5


def test_a_whole_log_query(spark):
    rows = logs(
        spark,
        (T0, {"service": "s", "level": "info"}, '{"k": 7}'),
        (T0, {"service": "s", "level": "warn"}, '{"k": 9}'),
        (T0, {"service": "t", "level": "info"}, '{"k": 9}'),
        (T0 + timedelta(days=1), {"service": "s", "level": "info"}, '{"k": 9}'),
        (T0, {"service": "s", "level": "info"}, '{"k": 9, "skip": 1}'),
        (T0, {"service": "s", "level": "info"}, '{"k": 9}'),
    )
    found = log_filters.restrict(
        rows, span=(T0, T0 + timedelta(hours=1)), labels=[("service", "=", "s")], levels=["info"],
        lines=[("!=", "SKIP", True)], include=["k<_>}"], parser="json", numbers=[("k", ">", 8.0)],
    ).collect()
    assert [r.fields["k"] for r in found] == ["9"]
    with pytest.raises(ValueError, match="parser"):
        log_filters.restrict(rows, numbers=[("k", ">", 8.0)])


def passages(spark, *rows):
    kinds = "highway_id int, timestamp timestamp, plate string, speed double, ev boolean"
    return spark.createDataFrame(list(rows), kinds)


def test_rows_without_a_time_have_no_window(spark):
    rows = passages(spark, (1, None, "A", 90.0, False), (1, T0, "A", 30.0, False))
    assert [r.avg_speed for r in trailing.trailing_mean(rows).collect()] == [30.0]
    assert replay.event_gap(rows).count() == 1 and profile.minute_totals(rows).count() == 1


def test_closed_windows_per_road(spark):
    rows = passages(spark, *[(r, T0 + timedelta(seconds=s), "A", 1.0, False) for r in (1, None) for s in (0, 5, 9)])
    closed = trailing.trailing_mean(rows, closed_only=True).collect()
    assert sorted((str(r.highway_id), r.window_end) for r in closed) == [
        (k, T0 + timedelta(seconds=s)) for k in ("1", "None") for s in (0, 5)
    ]


def test_no_shuffle_by_road_alone(spark):
    rows = passages(spark, (1, T0, "A", 1.0, False))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        closed = trailing.trailing_mean(rows, closed_only=True)
        plan = closed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = [x for x in plan.splitlines() if "SortMergeJoin" in x]
    assert joined and all("newest_ms" in x for x in joined)


def test_roads_without_rules_are_kept(spark):
    rows = passages(spark, (77, T0, "A", 50.0, True))
    found = profile.profile_deviation(rows, profile.rule_table(spark))
    roads = spark.createDataFrame([(0,)], "highway_id int")
    spine = profile.minute_spine(roads, rows)
    volume = profile.volume_per_minute(rows, spine)
    assert volume.where("highway_id = 77").first().cars == 1 and volume.count() == 1441
    assert found.where("highway_id = 77").first().base_rate is None


def test_a_speed_that_is_text_is_set_aside(spark):
    kinds = "road string, timestamp timestamp, time_text string, value binary, speed double"
    rows = [("1", T0, "t", b'{"speed": "fast"}', None), ("1", T0, "t", b'{"speed": null}', None), ("1", T0, "t", b'{"speed": 3}', 3.0)]
    good, bad = quality.split_bad_times(spark.createDataFrame(rows, kinds))
    assert good.count() == 2 and [r.reason for r in bad.collect()] == ["malformed speed"]


def test_a_second_run_replaces_nothing(spark, tmp_path):
    for run, value in (("a", 1), ("b", 2), ("b", 2)):
        tables.write_batch(spark.createDataFrame([(value,)], "x int"), str(tmp_path), 0, run=run)
    assert sorted(r.x for r in tables.read_table(spark, str(tmp_path)).collect()) == [1, 2]
    again = spark.createDataFrame([(1,)], "x int")
    tables.write_batch(again, str(tmp_path), 0, run="c")
    assert tables.read_table(spark, str(tmp_path)).count() == 3
    assert tables.read_table(spark, str(tmp_path), keys=["x"]).count() == 2
