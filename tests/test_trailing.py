"""Trailing mean on hand-written rows and against brute force."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kerbside.operators.trailing import trailing_mean, trailing_mean_direct
from kerbside.schema import PASSAGES

T0 = datetime(2025, 1, 31, 12, 0, 0)
HALF_HOUR = 30 * 60 * 1000


def passages(spark, rows):
    """Rows of (road, milliseconds after T0, speed)."""
    full = [
        (T0 + timedelta(milliseconds=ms), road, "A-B 001", speed, False) for road, ms, speed in rows
    ]
    return spark.createDataFrame(full, PASSAGES)


def means(df):
    return {
        (r.highway_id, round((r.window_end - T0).total_seconds() * 1000)): r.avg_speed
        for r in df.collect()
    }


def brute(rows, include_start=True):
    out = {}
    for road, t, _ in rows:
        inside = [
            s
            for r, ms, s in rows
            if r == road and s is not None
            and (t - HALF_HOUR <= ms if include_start else t - HALF_HOUR < ms)
            and ms <= t
        ]
        out[(str(road), t)] = sum(inside) / len(inside) if inside else None
    return out


def assert_same(got, want):
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (None if value is None else pytest.approx(value, abs=1e-9))


def test_row_at_the_early_edge_counts(spark):
    rows = [(0, 0, 10.0), (0, HALF_HOUR, 30.0)]
    assert means(trailing_mean(passages(spark, rows)))[("0", HALF_HOUR)] == 20.0
    open_start = trailing_mean(passages(spark, rows), include_start=False)
    assert means(open_start)[("0", HALF_HOUR)] == 30.0


def test_row_before_the_early_edge_does_not_count(spark):
    rows = [(0, 0, 10.0), (0, HALF_HOUR + 1, 30.0)]
    assert means(trailing_mean(passages(spark, rows)))[("0", HALF_HOUR + 1)] == 30.0


def test_equal_milliseconds_share_a_window(spark):
    rows = [
        (T0 + timedelta(microseconds=123100), 0, "A-B 001", 10.0, False),
        (T0 + timedelta(microseconds=123900), 0, "A-B 002", 20.0, False),
    ]
    assert means(trailing_mean(spark.createDataFrame(rows, PASSAGES))) == {("0", 123): 15.0}


def test_window_crosses_midnight(spark):
    late = 11 * 3600 * 1000 + 50 * 60 * 1000
    rows = [(0, late, 10.0), (0, late + 20 * 60 * 1000, 20.0)]
    assert means(trailing_mean(passages(spark, rows)))[("0", late + 20 * 60 * 1000)] == 15.0


def test_window_start_and_roads(spark):
    rows = [(1, 5, 10.0), (12, 0, 40.0)]
    got = trailing_mean(passages(spark, rows)).collect()
    assert {r.highway_id: r.avg_speed for r in got} == {"1": 10.0, "12": 40.0}
    assert all(r.window_end - r.window_start == timedelta(minutes=30) for r in got)


def test_closed_only_leaves_the_newest_window_out(spark):
    rows = [(0, 0, 10.0), (0, 5, 20.0), (1, 3, 30.0)]
    assert means(trailing_mean(passages(spark, rows), closed_only=True)) == {("0", 0): 10.0}


def test_missing_speed_counts_for_nothing(spark):
    rows = [(0, 0, None), (0, 5, 20.0), (0, 6, None)]
    got = means(trailing_mean(passages(spark, rows)))
    assert got == {("0", 0): None, ("0", 5): 20.0, ("0", 6): 20.0}


def test_times_before_1970(spark):
    old = -int(T0.timestamp() * 1000) - 45 * 60 * 1000
    rows = [(0, old, 1.0), (0, old + HALF_HOUR, 2.0), (0, old + HALF_HOUR + 1, 4.0)]
    assert_same(means(trailing_mean(passages(spark, rows))), brute(rows))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.integers(0, 2),
            st.integers(0, 40).map(lambda n: n * HALF_HOUR // 8) | st.integers(0, 5 * HALF_HOUR),
            st.integers(0, 400_000).map(lambda n: n / 1000),
        ),
        min_size=1,
        max_size=60,
    ),
    st.booleans(),
)
def test_equals_brute_force(spark, rows, include_start):
    df = passages(spark, rows)
    want = brute(rows, include_start)
    assert_same(means(trailing_mean(df, include_start=include_start)), want)
    assert_same(means(trailing_mean_direct(df, include_start=include_start)), want)


def test_one_road_spreads_over_blocks(spark):
    plan = trailing_mean(passages(spark, [(0, 0, 1.0)]))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(highway_id" in plan and "block" in plan
    assert plan.count("Exchange hashpartitioning") == 2
