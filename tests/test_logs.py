"""Log filters, parsing, counts, discovery on hand-written rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.functions.units import duration_seconds, size_bytes
from kerbside.operators import log_counts as counts
from kerbside.operators import log_discover as discover
from kerbside.operators import log_filters as filters
from kerbside.operators import log_parse as parse
from kerbside.plans import views
from kerbside.schema import LOGS

T0 = datetime(2025, 1, 31)
SF_DIR = "/root/testdata/sf0.001"


def logs(spark, *rows):
    full = [(i, T0 + timedelta(minutes=m), labels, line) for i, (m, labels, line) in enumerate(rows)]
    return spark.createDataFrame(full, LOGS)


def labelled(spark, *values):
    return logs(spark, *[(0, {} if v is None else {"l": v}, "x") for v in values])


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize(
    "op, value, want",
    [("=", "a", [0]), ("!=", "a", [1, 2, 3]), ("=", "", [2, 3]), ("!=", "", [0, 1]),
     ("=~", "a|b", [0]), ("=~", "a.*", [0, 1]), ("!~", "a", [1, 2, 3]), ("=~", ".*", [0, 1, 2, 3]),
     ("=~", ".+", [0, 1]), ("=~", "b", [])],
)
def test_label_operators(spark, op, value, want):
    assert ids(filters.label_filter(labelled(spark, "a", "ab", "", None), "l", op, value)) == want


@pytest.mark.parametrize(
    "given, want",
    [([("l", "=", "a"), ("l", "=", "b")], [0, 1]),
     ([("l", "=", "a"), ("l", "=", "b"), ("l", "=~", "c.*")], [0, 1, 2]),
     ([("l", "=", "a"), ("l", "=~", "c.*")], []),
     ([("l", "!=", "a"), ("l", "!=", "b")], [2, 3, 4]),
     ([("l", "!~", "a"), ("l", "!~", "c.*")], [1, 3, 4]),
     ([("l", "=", ""), ("l", "=", "a")], [0, 3, 4]),
     ([("l", "=", "a"), ("m", "=", "")], [0]),
     ([("l", "=~", ".+"), ("l", "!=", "b")], [0, 2]),
     ([], [0, 1, 2, 3, 4])],
)
def test_several_label_filters(spark, given, want):
    assert ids(filters.label_multi_filter(labelled(spark, "a", "b", "cc", "", None), given)) == want


def test_levels(spark):
    rows = logs(spark, (0, {"level": "error"}, ""), (0, {}, ""), (0, {"level": ""}, ""), (0, {"level": "info"}, ""))
    assert ids(filters.level_filter(rows, ["error", "logs"])) == [0, 1, 2]
    assert ids(filters.level_filter(rows, ["info"])) == [3]
    assert ids(filters.level_filter(rows, [])) == [0, 1, 2, 3]


@pytest.mark.parametrize(
    "op, text, ignore_case, want",
    [("|=", "Error.", False, [0]), ("|=", "error.", True, [0, 1]), ("!=", "rror", False, [2]),
     ("|~", "^e", False, [1]), ("|~", "^e", True, [0, 1]), ("!~", "rr.r", False, [2]), ("!=", "ERROR", True, [2])],
)
def test_line_operators(spark, op, text, ignore_case, want):
    rows = logs(spark, (0, {}, "Error. x"), (0, {}, "error."), (0, {}, "fine"))
    assert ids(filters.line_filter(rows, op, text, ignore_case)) == want


@pytest.mark.parametrize(
    "pattern, want",
    [("a<_>c", [0, 1, 3]), ("<_>b<_>", [0, 2]), ("a.c", [3]), ("c<_>a", [2]), ("<_>", [0, 1, 2, 3]),
     ("a<_>b<_>c", [0]), ("aa", []), ("a<_>a", [])],
)
def test_patterns(spark, pattern, want):
    rows = logs(spark, (0, {}, "abc"), (0, {}, "xa\nc"), (0, {}, "cba"), (0, {}, "a.c"))
    assert ids(filters.pattern_filter(rows, include=[pattern])) == want


def test_patterns_include_and_exclude(spark):
    rows = logs(spark, (0, {}, "get /a 200"), (0, {}, "get /b 500"), (0, {}, "put /a 200"))
    assert ids(filters.pattern_filter(rows, include=["get <_>", "put <_>"], exclude=["<_> 500"])) == [0, 2]
    assert ids(filters.pattern_filter(rows, exclude=["get", "/b"])) == [2]
    assert ids(filters.pattern_filter(rows)) == [0, 1, 2]


def test_time_range_is_half_open_and_pushed_down(spark):
    rows = logs(spark, (0, {}, ""), (1, {}, ""), (2, {}, ""))
    assert ids(filters.time_range(rows, T0, T0 + timedelta(minutes=2))) == [0, 1]
    scanned = filters.time_range(views.logs(views.events(spark, SF_DIR)), "2024-01-02", "2024-01-03")
    plan = scanned.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_label_filter_reaches_the_scan(spark):
    rows = views.logs(views.events(spark, SF_DIR))
    plan = filters.label_filter(rows, "level", "=", "error").select("id")
    assert "EqualTo(event_type,error)" in plan._jdf.queryExecution().executedPlan().toString()


def test_log_lines_order(spark):
    rows = logs(spark, (0, {}, ""), (5, {}, ""), (5, {}, ""), (1, {}, ""))
    assert [r.id for r in filters.log_lines(rows, 3).collect()] == [2, 1, 3]
    assert [r.id for r in filters.log_lines(rows, 3, newest_first=False).collect()] == [0, 3, 1]


JSON_AND_LOGFMT = [
    ('{"a":1,"b":{"c":2},"a":3}', {"a": "1", "b": '{"c":2}'}, {}, {"a": "1", "b": '{"c":2}'}),
    ('  {"x":null,"t":true}', {"t": "true"}, {}, {"t": "true"}),
    ("a=1 b=\"x y\\\" z\" a=2 c=", {}, {"a": "1", "b": 'x y" z', "c": ""}, {"a": "1", "b": 'x y" z', "c": ""}),
    ("plain words", {}, {}, {}),
    ("[1,2]", {}, {}, {}),
    ("{broken", {}, {}, {}),
    (None, {}, {}, {}),
]


@pytest.mark.parametrize("line, as_json, as_logfmt, as_mixed", JSON_AND_LOGFMT)
def test_parsers(spark, line, as_json, as_logfmt, as_mixed):
    rows = logs(spark, (0, {}, line))
    got = [parse.parse_fields(rows, p).first().fields for p in ("json", "logfmt", "mixed")]
    assert got == [as_json, as_logfmt, as_mixed]


@pytest.mark.parametrize(
    "text, seconds, size",
    [("1h2m3.5s", 3723.5, None), ("250ms", 0.25, None), ("-2s", -2.0, None), ("1.5µs", 1.5e-6, None),
     ("1KiB", None, 1024.0), ("20 MB", None, 2e7), ("512b", None, 512.0), ("12", None, 12.0),
     ("3", None, 3.0), ("s", None, None), ("x", None, None), ("", None, None), (None, None, None)],
)
def test_units(spark, text, seconds, size):
    row = spark.createDataFrame([(text,)], "t string").select(duration_seconds(F.col("t")), size_bytes(F.col("t")))
    got = row.first()
    assert got[0] == (None if seconds is None else pytest.approx(seconds))
    assert got[1] == size


def test_counts_by_label_with_and_without_rows_lacking_it(spark):
    rows = logs(spark, (0, {"l": "a"}, ""), (1, {"l": "a"}, ""), (2, {}, ""), (61, {"l": "a"}, ""))
    got = {(r.bucket, r.value): r["count"] for r in counts.counts_by_label(rows, "l", "1 hour").collect()}
    hour = T0 + timedelta(hours=1)
    assert got == {(T0, "a"): 2, (T0, ""): 1, (hour, "a"): 1}
    required = counts.counts_by_label(rows, "l", "1 hour", require_label=True).collect()
    assert sorted((r.bucket, r.value) for r in required) == [(T0, "a"), (hour, "a")]


def test_field_counts_and_means_leave_other_lines_out(spark):
    rows = logs(spark, (0, {}, '{"v":"2s"}'), (1, {}, '{"v":"4s"}'), (2, {}, '{"v":"x"}'), (3, {}, "no"),
                (70, {}, "no"), (130, {}, '{"v":"x"}'))
    parsed = parse.parse_fields(rows, "json")
    mean = counts.avg_field(parsed, "v", "1 hour", "duration").collect()
    assert [(r.bucket, r.avg, r["count"]) for r in mean] == [(T0, 3.0, 2)]
    per_value = counts.counts_by_field(parsed, "v", "1 hour").collect()
    assert sorted((r.bucket.hour, r.value, r["count"]) for r in per_value) == [
        (0, "2s", 1), (0, "4s", 1), (0, "x", 1), (2, "x", 1)
    ]


def test_line_is_parsed_once_for_means_and_counts(spark):
    parsed = parse.parse_fields(views.logs(views.events(spark, SF_DIR)), "json")
    for df in (
        counts.counts_by_field(parsed, "k", "1 day"),
        counts.avg_field(parsed, "k", "1 day"),
        parse.explode_fields(parsed, "id"),
    ):
        assert df._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_volume_is_in_bytes_and_ranked(spark):
    rows = logs(spark, (0, {"l": "a"}, "ä"), (0, {"l": "b"}, "xyz"), (0, {"l": "a"}, "ö"), (0, {}, "none"))
    assert [tuple(r) for r in counts.label_volume(rows, "l").collect()] == [("a", 4), ("b", 3)]
    assert [tuple(r) for r in counts.label_volume(rows, "l", 1).collect()] == [("a", 4)]


def test_rollup_equals_raw(spark):
    rows = views.logs(views.events(spark, SF_DIR))
    raw = {tuple(r) for r in counts.counts_by_label(rows, "level", "1 day").collect()}
    rolled = {tuple(r) for r in counts.rollup_counts(counts.build_rollup(rows), "1 day").collect()}
    assert rolled == raw


def test_pattern_series_order_and_totals(spark):
    rows = logs(spark, (0, {}, "ab"), (61, {}, "ab"), (62, {}, "b"))
    got = [(r.pattern, r.bucket.hour, r["count"], r.total)
           for r in counts.pattern_series(rows, ["a<_>b", "b", "z"], "1 hour").collect()]
    assert got == [("b", 0, 1, 3), ("b", 1, 2, 3), ("a<_>b", 0, 1, 2), ("a<_>b", 1, 1, 2)]


def test_rank_series_orders(spark):
    rows = spark.createDataFrame(
        [("a", T0, 1), ("a", T0 + timedelta(hours=1), 9), ("b", T0, 6), ("b", T0 + timedelta(hours=1), 6)],
        "series string, bucket timestamp, value long",
    )

    def order(*args):
        return [r.series for r in counts.rank_series(rows, *args).collect()]

    assert order("stddev") == ["a", "b"] and order("stddev", True) == ["b", "a"]
    assert order("sum") == ["b", "a"] and order("max") == ["a", "b"] and order("min") == ["b", "a"]
    assert order("name") == ["a", "b"] and order("name", False) == ["b", "a"]
    assert counts.rank_series(rows).first().stddev == 4.0


def test_detected_fields(spark):
    rows = logs(
        spark,
        (0, {}, '{"n":1,"d":"3s","level":"x","f":1.5,"both":1}'),
        (0, {}, '{"n":2,"d":"4ms","f":2,"both":1,"ok":true}'),
        (0, {}, 'both=2 size=3KiB word=abc detected_level=x'),
        (0, {}, "nothing"),
    )
    want = {
        "n": (2, "json", "int"), "d": (2, "json", "duration"), "f": (2, "json", "float"),
        "both": (2, "mixed", "int"), "ok": (1, "json", "boolean"),
        "size": (1, "logfmt", "bytes"), "word": (1, "logfmt", "string"),
    }
    for approximate in (False, True):
        got = {r.field: (r.cardinality, r.parser, r.kind)
               for r in discover.detected_fields(rows, approximate).collect()}
        assert got == want


def test_detected_labels_order_and_hidden_ones(spark):
    rows = logs(
        spark,
        (0, {"one": "x", "two": "a", "many": "1", "__stream_shard__": "1"}, ""),
        (0, {"one": "x", "two": "b", "many": "2", "__aggregated_metric__": "y"}, ""),
        (0, {"one": "x", "two": "b", "many": "3"}, ""),
    )
    for approximate in (False, True):
        got = [tuple(r) for r in discover.detected_labels(rows, approximate).collect()]
        assert got == [("two", 2), ("many", 3), ("one", 1)]


def test_label_names_values_and_coverage(spark):
    rows = logs(spark, (0, {"a": "x", "b": "yy"}, ""), (0, {"a": "z"}, ""), (0, {"a": "x"}, ""))
    assert [r.label for r in discover.label_names(rows).collect()] == ["a", "b"]
    assert [r.value for r in discover.label_values(rows, "a").collect()] == ["x", "z"]
    assert [r.value for r in discover.label_values(rows, "a", 1).collect()] == ["x"]
    got = {r.label: tuple(r)[1:] for r in discover.label_coverage(rows).collect()}
    assert got == {"a": (100, 2, 1), "b": (34, 1, 2)}


def test_which_parser(spark):
    flags = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)], "j boolean, l boolean")
    got = [r[0] for r in flags.select(parse.which_parser(F.col("j"), F.col("l"))).collect()]
    assert got == ["mixed", "json", "logfmt", "structuredMetadata"]
