"""Parsed bodies, pattern tables, and the detail table with merged parts."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.functions.matching import match_pattern
from kerbside.operators import log_bodies, log_counts, log_filters, log_parse, log_patterns
from kerbside.plans import views
from kerbside.schema import LOGS, PASSAGES
from kerbside.sources import snapshots
from kerbside.sources.records import decode_records, encode_records, read_record_files
from kerbside.streaming.runs import finish, start_outputs

T0 = datetime(2025, 1, 31)


def logs_of(spark, lines):
    rows = [(k, T0 + timedelta(minutes=7 * k), {"level": "x"}, line) for k, line in enumerate(lines)]
    return spark.createDataFrame(rows, LOGS)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    lines = [f'{{"k": {k % 9}, "name": "n{k % 4}", "a.b": {k}, "text": "{"x" * 200}"}}' for k in range(400)]
    lines += ["not json", "", None, "[1]", '"k"', '{"k": null}', '{"other": 1}', '{"k": "7"}', '{"k": "seven"}', '{"k": 1, "k": 2']
    logs = logs_of(spark, lines)
    path = f"file://{tmp_path_factory.mktemp('bodies')}/t"
    snapshots.append_batch(log_bodies.with_body(logs), path, 0, run="a")
    return logs, snapshots.read(spark, path)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("name", ["k", "name", "a.b", "absent"])
def test_fields_of_bodies_equal_those_of_text(stored, name):
    logs, bodies = stored
    text, body = log_parse.parse_fields(logs, "json"), log_bodies.body_fields(bodies, name)
    assert rows_of(log_counts.counts_by_field(body, name, "1 hour")) == rows_of(log_counts.counts_by_field(text, name, "1 hour"))
    assert rows_of(log_counts.avg_field(body, name, "1 hour")) == rows_of(log_counts.avg_field(text, name, "1 hour"))
    found = [log_filters.numeric_filter(rows, name, ">=", 5).select("id") for rows in (body, text)]
    assert rows_of(found[0]) == rows_of(found[1])


def test_only_the_asked_field_is_read(stored, capsys):
    counted = log_counts.counts_by_field(log_bodies.body_fields(stored[1], "k"), "k", "1 hour")
    counted.explain("formatted")
    [schema] = [line for line in capsys.readouterr().out.splitlines() if "ReadSchema" in line]
    assert schema.endswith("struct<ts:timestamp,body:struct<0:string>>")


PATTERNS = [
    "level=<_> user 1", " user 12 ", "<_>", "", "err", "a.b<_>c(d", "x <_> y <_> z", " y ", "absent word here",
    "=e<_>", "user <_> end", "é word é", "line\nbreak two", None,
]


def test_a_pattern_table_equals_one_expression_per_pattern(spark):
    lines = [f"level=e{k % 3} user {k % 15} end" for k in range(60)]
    lines += ["a.b c(d", "aXb c(d", "x 1 y 2 z", "x y z", "first line\nbreak two", "é word é", "éword", "word", "", None]
    logs = logs_of(spark, lines)
    table = spark.createDataFrame([(p,) for p in [*PATTERNS, PATTERNS[0]]], "pattern string")
    got = log_patterns.pattern_matches(logs, table)
    assert got.columns == [*logs.columns, "pattern"]
    want = [
        (r.id, p)
        for p in set(PATTERNS) - {None}
        for r in logs.where(match_pattern(F.col("line"), p)).select("id").collect()
    ]
    assert sorted((r.id, r.pattern) for r in got.collect()) == sorted(want) and len(want) > 150
    keys = {r.pattern: r.word for r in log_patterns.keyed_patterns(logs, table).collect()}
    assert keys[" user 12 "] == "12" and keys["x <_> y <_> z"] == "y" and keys["err"] == keys["<_>"] == ""
    assert log_patterns.pattern_matches(logs, table.limit(0)).count() == 0
    series = log_patterns.pattern_series_of(logs, table, "1 hour").where("pattern = 'err'")
    assert rows_of(series) == rows_of(log_counts.pattern_series(logs, ["err"], "1 hour"))


def test_no_lines_or_words_of_lines_go_through_the_driver(spark, capsys):
    """A small file is no measure of the rows that its lines are exploded to."""
    logs = views.logfmt_logs(views.events(spark, "/root/testdata/sf0.001"))
    table = logs.select(F.concat(F.lit(' user="u '), F.col("id"), F.lit('"')).alias("pattern"))
    log_patterns.pattern_matches(logs, table).explain("formatted")
    parts = capsys.readouterr().out.split("\n\n")
    sent = [part for part in parts if re.match(r"\s*\(\d+\) BroadcastExchange", part)]
    assert len(parts) > 20
    assert not any(name in part for part in sent for name in ("line#", "word#", "pattern#"))


def test_detail_table_of_merged_batches(spark, tmp_path):
    folder = f"file://{tmp_path}"
    rows = views.passages_at_source(views.events(spark, "/root/testdata/sf0.001"))
    encode_records(rows).repartition(7).write.parquet(f"{folder}/in")
    decoded = decode_records(read_record_files(spark, f"{folder}/in", max_files_per_trigger=1))
    sink = snapshots.snapshot_writer(f"{folder}/detail", "timestamp", fan_in=3)
    nothing = lambda df, batch_id: df.write.format("noop").mode("overwrite").save()
    sinks = {"traffic_detailed": sink, "traffic_averages": nothing, "quarantine": nothing}
    started = start_outputs(decoded, folder, f"{folder}/c", watermark_delay="40 days", sinks=sinks)
    finish(started)
    snapshot = snapshots.latest(spark, f"{folder}/detail")
    assert len(snapshot.parts) <= 4 and snapshot.split == ["slot"]
    got = snapshots.read(spark, f"{folder}/detail").select(*PASSAGES.names)
    assert rows_of(got) == rows_of(views.passages(views.events(spark, "/root/testdata/sf0.001")))
