"""Registered queries: each operator applied to whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import event_time, road
from kerbside.operators import basics, profile, quality, replay, trailing
from kerbside.operators import log_bodies, log_counts, log_discover, log_filters, log_parse
from kerbside.operators import log_frequent, log_patterns, log_ranges
from kerbside.plans import views
from kerbside.schema import AVERAGES, PASSAGES, RAW_PASSAGES
from kerbside.session import configure, shared_dir
from kerbside.sources import passages as passage_files
from kerbside.sources import records, rescue, snapshots, tables
from kerbside.streaming import clocks, rollup, runs
from kerbside.streaming import counts as stream_counts
from kerbside.streaming import trailing as stream_trailing

Query = Callable[[SparkSession, str], DataFrame]

# Digits kept of means: both engines add doubles in an order of their own.
DIGITS = 9

# These streams read files whose rows are in time order, so nothing can be late.
IN_ORDER = "0 seconds"

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its own name, with the session settings it needs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.passages(views.events(spark, sf_dir))


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.logs(views.events(spark, sf_dir))


def _logfmt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.logfmt_logs(views.events(spark, sf_dir))


def _document_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.document_logs(views.documents(spark, sf_dir))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


# --- sources and sinks -------------------------------------------------------


@query
def scan_passages(spark, sf_dir):
    path = shared_dir(spark, "csv")
    passage_files.write_csv(views.passages_at_source(views.events(spark, sf_dir)), path)
    return passage_files.scan_csv(spark, path)


@query
def encode_records(spark, sf_dir):
    sent = records.encode_records(views.passages_at_source(views.events(spark, sf_dir)))
    body = F.from_json(F.col("value").cast("string"), RAW_PASSAGES)
    return sent.select(F.col("key").cast("string").alias("key"), F.inline(F.array(body)))


@query
def decode_records(spark, sf_dir):
    sent = records.encode_records(views.passages_at_source(views.events(spark, sf_dir)))
    return records.decode_records(sent).drop("value", "time_text")


def _sent_records(spark, sf_dir, name):
    """Records of all passages as files, the stand-in for a topic."""
    path = shared_dir(spark, name)
    sent = records.encode_records(views.passages_at_source(views.events(spark, sf_dir)))
    sent.write.parquet(f"{path}/records")
    return path


@query
def stream_ingest(spark, sf_dir):
    path = _sent_records(spark, sf_dir, "ingest")
    decoded = records.decode_records(records.read_record_files(spark, f"{path}/records"))
    good, _ = quality.split_bad_times(decoded)
    out = quality.traffic_detailed(good)
    runs.finish([runs.write_stream(out, f"{path}/out", f"{path}/checkpoint")])
    return tables.read_table(spark, f"{path}/out", PASSAGES)


@query
def stream_ingest_merged(spark, sf_dir):
    """The detail table from small batches, whose parts are merged as they come."""
    path = shared_dir(spark, "ingest-merged")
    sent = records.encode_records(views.passages_at_source(views.events(spark, sf_dir)))
    sent.repartition(6).write.parquet(f"{path}/records")
    decoded = records.decode_records(records.read_record_files(spark, f"{path}/records", max_files_per_trigger=2))
    out = quality.traffic_detailed(quality.split_bad_times(decoded)[0])
    sink = snapshots.snapshot_writer(f"{path}/out", "timestamp", fan_in=2)
    runs.finish([runs.write_stream(out, f"{path}/out", f"{path}/checkpoint", sink=sink)])
    return snapshots.read(spark, f"{path}/out").select(*PASSAGES.names)


def _with_more_members(spark, sf_dir):
    """Decoded records that have one member or two more than the schema, depending on their kind."""
    rows = views.passages_at_source(views.events(spark, sf_dir))
    lane = F.when(F.col("ev"), F.col("highway_id") + 1)
    sent = records.encode_records(rows, lane=lane, note=F.when(F.col("speed") > 50, F.lit("fast")))
    return records.decode_records(sent)


@query
def rescued_members(spark, sf_dir):
    return rescue.rescued_members(rescue.with_rescued(_with_more_members(spark, sf_dir))).drop("share")


@query
def promoted_members(spark, sf_dir):
    rows = rescue.promote(rescue.with_rescued(_with_more_members(spark, sf_dir)), {"lane": "int"})
    rows = rows.withColumn("note", F.col(rescue.RESCUED)["note"])
    return quality.traffic_detailed(rows, "lane", "note")


@query
def fork_outputs(spark, sf_dir):
    path = _sent_records(spark, sf_dir, "fork")
    decoded = records.decode_records(records.read_record_files(spark, f"{path}/records"))
    started = runs.start_outputs(decoded, f"{path}/tables", f"{path}/checkpoints", watermark_delay=IN_ORDER)
    runs.finish(started, allow_late=False)
    detail = tables.read_table(spark, f"{path}/tables/{tables.DETAIL_TABLE}", PASSAGES)
    means = tables.read_table(spark, f"{path}/tables/{tables.AVERAGES_TABLE}", AVERAGES)
    detail_road = detail.select(
        F.lit(tables.DETAIL_TABLE).alias("table_name"), F.col("highway_id").cast("string")
    )
    means_road = means.select(F.lit(tables.AVERAGES_TABLE).alias("table_name"), "highway_id")
    both = detail_road.unionByName(means_road)
    return both.groupBy("table_name", "highway_id").agg(F.count(F.lit(1)).alias("rows"))


@query
def sink_averages(spark, sf_dir):
    path = shared_dir(spark, "averages")
    means = trailing.trailing_mean(_passages(spark, sf_dir))
    tables.write_batch(means, path, 0, run="first")
    tables.write_batch(means, path, 0, run="first")
    tables.write_batch(means, path, 0, run="second")
    stored = tables.read_table(spark, path, AVERAGES, keys=["highway_id", "window_end"])
    return _rounded(stored, "avg_speed")


@query
def schema_evolve(spark, sf_dir):
    path = shared_dir(spark, "evolve")
    rows = _passages(spark, sf_dir)
    change = "2024-01-16"
    before, after = F.col("timestamp") < change, F.col("timestamp") >= change
    tables.write_batch(rows.where(before).drop("ev"), path, 0, run="first")
    tables.write_batch(rows.where(after), path, 1, run="first")
    return tables.read_table(spark, path)


@query
def traffic_averages(spark, sf_dir):
    """The deployed table: keyed by the first digit of the road, under its own names.

    Roads have two digits here, so that several become one.
    """
    rows = views.passages_at_source(views.events(spark, sf_dir))
    tens = (F.dayofmonth("timestamp") % 3 + 1) * 10
    sent = records.encode_records(rows.withColumn("highway_id", F.col("highway_id") + tens))
    good, _ = quality.split_bad_times(records.decode_records(sent, first_digit_only=True))
    means = trailing.trailing_mean(good, key="road")
    return _rounded(tables.source_names(means), "avg_speed")


@query
def summary_table(spark, sf_dir):
    means = trailing.trailing_mean(_passages(spark, sf_dir))
    return _rounded(tables.summary_table(means), "avg_speed")


# --- projections, order, time ------------------------------------------------


@query
def traffic_detailed(spark, sf_dir):
    return quality.traffic_detailed(_passages(spark, sf_dir))


@query
def road_key(spark, sf_dir):
    key = road.encode_key(F.col("user_id"))
    return views.events(spark, sf_dir).select(
        "event_id",
        road.road_key(key).alias("road_key"),
        road.road_key(key, first_digit_only=True).alias("first_digit"),
    )


@query
def sorted_passages(spark, sf_dir):
    return basics.sorted_passages(_passages(spark, sf_dir))


@query
def head_passages(spark, sf_dir):
    return basics.head_passages(_passages(spark, sf_dir))


@query
def passage_count(spark, sf_dir):
    return basics.passage_count(_passages(spark, sf_dir))


def _time_texts(spark, sf_dir):
    """Events with a time text that is whole, cut to seconds, too long, junk or absent."""
    kind, ts = F.col("event_type"), F.col("ts")
    full = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = (
        F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "signup", F.concat(full, F.lit("000")))
        .when(kind == "error", F.concat(F.lit("at "), full))
        .when(kind != "view", full)
    )
    return views.events(spark, sf_dir).withColumn("time_text", text)


@query
def parse_event_time(spark, sf_dir):
    parsed = event_time.parse_event_time(F.col("time_text"))
    return _time_texts(spark, sf_dir).select(
        "event_id", parsed.alias("event_time"), F.unix_millis(parsed).alias("event_ms")
    )


@query
def quarantine(spark, sf_dir):
    value = F.to_json(F.struct(F.col("time_text").alias("timestamp"), F.lit(1).alias("highway_id")))
    sent = _time_texts(spark, sf_dir).select(
        F.encode(F.col("event_id").cast("string"), "UTF-8").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
    )
    _, bad = quality.split_bad_times(records.decode_records(sent))
    return bad


# --- trailing mean -----------------------------------------------------------


@query
def avg_speed_30m(spark, sf_dir):
    return _rounded(trailing.trailing_mean(_passages(spark, sf_dir)), "avg_speed")


@query
def avg_speed_30m_closed(spark, sf_dir):
    means = trailing.trailing_mean(_passages(spark, sf_dir), closed_only=True)
    return _rounded(means, "avg_speed")


@query
def avg_speed_30m_open_start(spark, sf_dir):
    means = trailing.trailing_mean(_passages(spark, sf_dir), include_start=False)
    return _rounded(means, "avg_speed")


@query
def avg_speed_30m_stream(spark, sf_dir):
    path = shared_dir(spark, "trailing")
    rows = views.passages(views.events_stream(spark, sf_dir))
    means = stream_trailing.trailing_mean_stream(rows, watermark_delay=IN_ORDER)
    runs.finish([runs.write_stream(means, f"{path}/out", f"{path}/checkpoint")], allow_late=False)
    return _rounded(tables.read_table(spark, f"{path}/out", AVERAGES), "avg_speed")


@query
def late_rows(spark, sf_dir):
    """The second half of the month first, then the first half: all of it late."""
    path = shared_dir(spark, "late")
    rows = _passages(spark, sf_dir)
    change = "2024-01-16"
    for part in (F.col("timestamp") >= change, F.col("timestamp") < change):
        rows.where(part).write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(PASSAGES).parquet(f"{path}/in")
        means = stream_trailing.trailing_mean_stream(arriving, watermark_delay=IN_ORDER)
        runs.finish([runs.write_stream(means, f"{path}/out", f"{path}/checkpoint")])
    return _rounded(tables.read_table(spark, f"{path}/out", AVERAGES), "avg_speed")


def _clocked(spark, sf_dir, name):
    """Tables kept by one clock per road; passages of electric cars come after all others."""
    path = shared_dir(spark, name)
    rows = _passages(spark, sf_dir)
    for part in (~F.col("ev"), F.col("ev")):
        rows.where(part).write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(PASSAGES).parquet(f"{path}/in")
        clocks.start_clocked(arriving, f"{path}/tables", f"{path}/checkpoint").awaitTermination()
    return f"{path}/tables"


@query
def avg_speed_30m_repaired(spark, sf_dir):
    """Means of a stream out of order, the windows of late rows repaired."""
    return _rounded(clocks.read_means(spark, _clocked(spark, sf_dir, "repaired")), "avg_speed")


@query
def late_rows_kept(spark, sf_dir):
    """The late rows of that stream themselves."""
    return clocks.read_late(spark, _clocked(spark, sf_dir, "late-kept")).select(*PASSAGES.names)


# --- replay, profile, plates -------------------------------------------------


@query
def replay_schedule(spark, sf_dir):
    rows = views.passages_at_source(views.events(spark, sf_dir))
    return replay.replay_schedule(rows).select("timestamp", "plate", "offset_s")


@query
def event_gap(spark, sf_dir):
    rows = views.passages_at_source(views.events(spark, sf_dir))
    return replay.event_gap(rows)


def _spine(spark, sf_dir):
    return profile.minute_spine(profile.rule_table(spark), _passages(spark, sf_dir))


@query
def minute_spine(spark, sf_dir):
    return _spine(spark, sf_dir)


@query
def expected_profile(spark, sf_dir):
    return profile.expected_profile(profile.rule_table(spark), _passages(spark, sf_dir))


@query
def volume_per_minute(spark, sf_dir):
    return profile.volume_per_minute(_passages(spark, sf_dir), _spine(spark, sf_dir))


@query
def profile_deviation(spark, sf_dir):
    compared = profile.profile_deviation(_passages(spark, sf_dir), profile.rule_table(spark))
    return _rounded(compared, "avg_speed", "speed_deviation", "ev_share", "ev_deviation")


@query
def plate_violations(spark, sf_dir):
    return quality.plate_violations(_passages(spark, sf_dir))


@query
def plate_violations_found(spark, sf_dir):
    """Plates over all 26 letters, the flag set for errors as well."""
    rows = views.passages_at_source(views.events(spark, sf_dir), letters=26)
    return quality.plate_violations(rows.withColumn("ev", F.col("ev") | (F.col("speed") > 100)))


# --- log filters -------------------------------------------------------------


def _shown(logs: DataFrame) -> DataFrame:
    return logs.select("id", "ts", F.col("labels")["level"].alias("level"), "line")


def _label_query(name: str, op: str, value: str) -> None:
    def run(spark, sf_dir):
        return _shown(log_filters.label_filter(_logs(spark, sf_dir), "level", op, value))

    run.__name__ = name
    query(run)


_label_query("label_filter", "=", "error")
_label_query("label_filter_not", "!=", "error")
_label_query("label_filter_regex", "=~", "e.*|view")
_label_query("label_filter_not_regex", "!~", "e|.*c.*")


@query
def label_multi_filter(spark, sf_dir):
    filters = [
        ("level", "=", "error"),
        ("level", "=", "view"),
        ("level", "=~", "sign.*"),
        ("service", "!=", "s0"),
        ("service", "!=", "s3"),
    ]
    return _shown(log_filters.label_multi_filter(_logs(spark, sf_dir), filters))


@query
def level_filter(spark, sf_dir):
    rows = _logs(spark, sf_dir)
    without = F.map_filter("labels", lambda k, v: ~((k == "level") & (v == "signup")))
    bare = rows.withColumn("labels", without)
    return _shown(log_filters.level_filter(bare, ["error", "logs"]))


def _numeric_query(name: str, op: str, bound: float) -> None:
    def run(spark, sf_dir):
        parsed = log_parse.parse_fields(_logs(spark, sf_dir), "json")
        return _shown(log_filters.numeric_filter(parsed, "k", op, bound))

    run.__name__ = name
    query(run)


_numeric_query("numeric_filter", ">", 90)
_numeric_query("numeric_filter_at_least", ">=", 90)
_numeric_query("numeric_filter_below", "<", 9.5)
_numeric_query("numeric_filter_at_most", "<=", 9)


def _line_query(name: str, op: str, text: str, ignore_case: bool = False) -> None:
    def run(spark, sf_dir):
        found = log_filters.line_filter(_document_logs(spark, sf_dir), op, text, ignore_case)
        return found.select("id", F.col("labels")["source"].alias("source"))

    run.__name__ = name
    query(run)


_line_query("line_filter", "|=", "The")
_line_query("line_filter_not", "!=", "a")
_line_query("line_filter_regex", "|~", "[0-9]{3}")
_line_query("line_filter_not_regex", "!~", "[0-9]")
_line_query("line_filter_any_case", "|=", "LICENSE", ignore_case=True)
_line_query("line_filter_regex_any_case", "|~", "the [a-d]+ ", ignore_case=True)


@query
def pattern_filter(spark, sf_dir):
    rows = _logfmt(spark, sf_dir)
    return _shown(
        log_filters.pattern_filter(
            rows,
            include=["level=error <_> size=1<_>KiB", "level=view <_>user=\"u 2<_>"],
            exclude=["cents=<_>7 took="],
        )
    )


@query
def time_range(spark, sf_dir):
    return _shown(
        log_filters.time_range(_logs(spark, sf_dir), "2024-01-05 00:00:00", "2024-01-09 12:00:00")
    )


@query
def log_lines(spark, sf_dir):
    return _shown(log_filters.log_lines(_logs(spark, sf_dir), 100))


@query
def log_lines_oldest(spark, sf_dir):
    return _shown(log_filters.log_lines(_logs(spark, sf_dir), 100, newest_first=False))


# --- log parsing -------------------------------------------------------------


@query
def parse_json_fields(spark, sf_dir):
    return log_parse.explode_fields(log_parse.parse_fields(_logs(spark, sf_dir), "json"), "id")


@query
def parse_logfmt_fields(spark, sf_dir):
    return log_parse.explode_fields(log_parse.parse_fields(_logfmt(spark, sf_dir), "logfmt"), "id")


def _both_kinds(spark, sf_dir):
    """Errors and clicks log JSON, the other levels log logfmt."""
    events = views.events(spark, sf_dir)
    as_json = views.logs(events.where(F.col("event_type").isin("error", "click")))
    as_logfmt = views.logfmt_logs(events.where(~F.col("event_type").isin("error", "click")))
    return as_json.unionByName(as_logfmt)


@query
def parse_mixed_fields(spark, sf_dir):
    return log_parse.explode_fields(log_parse.parse_fields(_both_kinds(spark, sf_dir), "mixed"), "id")


# --- log counts --------------------------------------------------------------


@query
def log_count(spark, sf_dir):
    return log_counts.log_count(log_filters.label_filter(_logs(spark, sf_dir), "level", "=", "error"))


@query
def counts_by_label(spark, sf_dir):
    return log_counts.counts_by_label(_logs(spark, sf_dir), "level", "1 hour")


@query
def counts_by_label_stream(spark, sf_dir):
    path = shared_dir(spark, "counts")
    rows = views.logs(views.events_stream(spark, sf_dir))
    counted = stream_counts.counts_by_label_stream(rows, "level", "1 hour", watermark_delay=IN_ORDER)
    runs.finish([runs.write_stream(counted, f"{path}/out", f"{path}/checkpoint")], allow_late=False)
    return tables.read_table(spark, f"{path}/out", counted.schema)


@query
def counts_by_field(spark, sf_dir):
    parsed = log_parse.parse_fields(_logs(spark, sf_dir), "json")
    return log_counts.counts_by_field(parsed, "k", "1 day")


def _bodies(spark, sf_dir, name):
    """Log rows stored with their lines parsed and shredded."""
    path = shared_dir(spark, name)
    snapshots.append_batch(log_bodies.with_body(_logs(spark, sf_dir)), path, 0, run="first")
    return snapshots.read(spark, path)


@query
def counts_by_field_body(spark, sf_dir):
    fields = log_bodies.body_fields(_bodies(spark, sf_dir, "counts-body"), "k")
    return log_counts.counts_by_field(fields, "k", "1 day")


@query
def avg_field_body(spark, sf_dir):
    fields = log_bodies.body_fields(_bodies(spark, sf_dir, "avg-body"), "k")
    return log_counts.avg_field(fields, "k", "1 hour")


def _avg_query(name: str, field: str, unit: str) -> None:
    def run(spark, sf_dir):
        parsed = log_parse.parse_fields(_logfmt(spark, sf_dir), "logfmt")
        means = log_counts.avg_field(parsed, field, "1 hour", unit)
        # Sums of whole numbers are exact and need no rounding.
        return _rounded(means, "avg") if unit == "duration" else means

    run.__name__ = name
    query(run)


_avg_query("avg_field", "cents", "float")
_avg_query("avg_field_duration", "took", "duration")
_avg_query("avg_field_bytes", "size", "bytes")


@query
def label_volume(spark, sf_dir):
    return log_counts.label_volume(_document_logs(spark, sf_dir), "source")


@query
def label_volume_top(spark, sf_dir):
    """The largest users by bytes, the buckets left out being the proof."""
    user = F.create_map(F.lit("user"), F.concat(F.lit("u"), F.col("user_id")))
    logs = views.events(spark, sf_dir).select(user.alias("labels"), F.col("props").alias("line"))
    return log_frequent.top_values(logs, "user", 20).select("value", "volume")


@query
def rollup_counts(spark, sf_dir):
    path = shared_dir(spark, "rollup")
    log_counts.build_rollup(_logs(spark, sf_dir)).write.parquet(path)
    return log_counts.rollup_counts(spark.read.parquet(path), "1 day")


ROLLUP_STEPS = ("1 hour", "1 day")


def _maintained_rollup(spark, sf_dir, name):
    """A roll-up kept up by a stream that is started again for each part; the middle part comes last."""
    path = shared_dir(spark, name)
    rows = views.events(spark, sf_dir)
    first, second = F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-20").cast("timestamp")
    ts = F.col("ts")
    for part in (ts < first, ts >= second, (ts >= first) & (ts < second)):
        rows.where(part).write.mode("append").parquet(f"{path}/in")
        logs = views.logs(spark.readStream.schema(views.EVENTS).parquet(f"{path}/in"))
        started = rollup.maintain_rollup(logs, f"{path}/rollup", f"{path}/checkpoint", ROLLUP_STEPS, fan_in=2)
        started.awaitTermination()
    return f"{path}/rollup"


@query
def rollup_counts_stream(spark, sf_dir):
    return rollup.read_rollup(spark, _maintained_rollup(spark, sf_dir, "rollup-stream"))


def _range_query(name: str, step: str | None) -> None:
    """Counts of a range that begins and ends within a bucket, raw rows only at its ends."""

    def run(spark, sf_dir):
        rolled = rollup.read_rollup(spark, _maintained_rollup(spark, sf_dir, name))
        raw = _logs(spark, sf_dir)
        return log_ranges.range_counts(rolled, raw, *RANGE, list(ROLLUP_STEPS), step)

    run.__name__ = name
    query(run)


RANGE = ("2024-01-03 07:41:13", "2024-01-24 16:05:59.5")
_range_query("range_counts", None)
_range_query("range_counts_by_day", "1 day")


@query
def pattern_series(spark, sf_dir):
    patterns = ["level=<_> cents=1<_> took", "level=error <_>", "<_>KiB user=\"u 1<_>\"", "absent"]
    return log_counts.pattern_series(_logfmt(spark, sf_dir), patterns, "6 hours")


@query
def pattern_series_many(spark, sf_dir):
    """A pattern for every level and user that the lines hold."""
    rows = _logfmt(spark, sf_dir)
    user = F.regexp_extract("line", 'user="(.*)"', 1)
    pattern = F.concat(F.lit("level="), F.col("labels")["level"], F.lit(' cents=<_> user="'), user, F.lit('"'))
    return log_patterns.pattern_series_of(rows, rows.select(pattern.alias("pattern")), "1 day")


def _rank_query(name: str, by: str, ascending: bool | None = None) -> None:
    def run(spark, sf_dir):
        counted = log_counts.counts_by_label(_logs(spark, sf_dir), "level", "1 hour")
        series = counted.select(F.col("value").alias("series"), "bucket", F.col("count").alias("value"))
        return _rounded(log_counts.rank_series(series, by, ascending), "stddev")

    run.__name__ = name
    query(run)


_rank_query("rank_series", "stddev")
_rank_query("rank_series_by_name", "name")
_rank_query("rank_series_by_sum", "sum", ascending=True)


# --- log discovery -----------------------------------------------------------


@query
def detected_fields(spark, sf_dir):
    return log_discover.detected_fields(_both_kinds(spark, sf_dir))


@query
def detected_labels(spark, sf_dir):
    return log_discover.detected_labels(_document_logs(spark, sf_dir))


@query
def label_names(spark, sf_dir):
    """Errors carry a label of their own, and views have no service."""
    rows, level = _logs(spark, sf_dir), F.col("labels")["level"]
    code = F.map_concat("labels", F.create_map(F.lit("code"), F.col("line")))
    bare = F.map_filter("labels", lambda k, _: k != "service")
    labels = F.when(level == "error", code).when(level == "view", bare).otherwise(F.col("labels"))
    return log_discover.label_names(rows.withColumn("labels", labels))


@query
def label_values(spark, sf_dir):
    return log_discover.label_values(_document_logs(spark, sf_dir), "source")


@query
def label_coverage(spark, sf_dir):
    """Coverage of service, level and of a label that only errors carry."""
    rows = _logs(spark, sf_dir)
    code = F.when(
        F.col("labels")["level"] == "error", F.create_map(F.lit("code"), F.col("line"))
    ).otherwise(F.create_map().cast("map<string,string>"))
    return log_discover.label_coverage(rows.withColumn("labels", F.map_concat("labels", code)))
