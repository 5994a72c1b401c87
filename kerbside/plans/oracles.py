"""For each registered query, the same result as plain SQL over the given tables."""

from __future__ import annotations

from kerbside.operators.profile import ROADS
from kerbside.plans.queries import DIGITS

_PASSAGE_COLUMNS = """
    CAST(user_id % 4 AS INTEGER) AS highway_id,
    chr(CAST(65 + event_id % 22 AS INTEGER)) || '-'
      || chr(CAST(65 + (event_id // 22) % 22 AS INTEGER)) || ' '
      || printf('%03d', event_id % 9999 + 1)
      || CASE WHEN event_type = 'purchase' THEN 'E' ELSE '' END AS plate,
    value AS speed,
    event_type = 'purchase' AS ev
  FROM events"""

SENT = f"""sent AS (
  SELECT ts AS "timestamp", {_PASSAGE_COLUMNS}
)"""

PASSAGES = f"""passages AS (
  SELECT make_timestamp(epoch_us(ts) // 1000 * 1000) AS "timestamp", {_PASSAGE_COLUMNS}
)"""


def _means(start: str = "30 minutes", where: str = "true") -> str:
    """Trailing means by a range frame over sums per road and millisecond."""
    return f"""means AS (
  SELECT CAST(highway_id AS VARCHAR) AS highway_id,
    round(sum(s) OVER w / sum(c) OVER w, {DIGITS}) AS avg_speed,
    "timestamp" - INTERVAL 30 minutes AS window_start,
    "timestamp" AS window_end,
    max("timestamp") OVER (PARTITION BY highway_id) AS newest
  FROM (
    SELECT highway_id, "timestamp", sum(speed) AS s, count(speed) AS c
    FROM passages WHERE {where} GROUP BY ALL
  )
  WINDOW w AS (
    PARTITION BY highway_id ORDER BY "timestamp"
    RANGE BETWEEN INTERVAL {start} PRECEDING AND CURRENT ROW
  )
)"""


_MEAN_COLUMNS = "highway_id, avg_speed, window_start, window_end"
_ALL_MEANS = f"WITH {PASSAGES}, {_means()} SELECT {_MEAN_COLUMNS} FROM means"

TIME_TEXTS = """texts AS (
  SELECT event_id, event_type, ts,
    CASE event_type
      WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 'signup' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '000'
      WHEN 'error' THEN 'at ' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
      WHEN 'view' THEN NULL
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
    END AS time_text
  FROM events
)"""

_RULE_ROWS = ",\n    ".join(
    f"({road}, '{name}', {ev_rate}, {priority}, {from_h}, {to_h}, {rate}, {speed})"
    for road, name, ev_rate, rules in ROADS
    for priority, (from_h, to_h, rate, speed) in enumerate(rules, start=1)
)

SPINE = f"""rules(highway_id, name, ev_rate, priority, from_h, to_h, base_rate, speed) AS (
  VALUES
    {_RULE_ROWS}
), days AS (
  SELECT min(CAST(ts AS DATE)) AS low, max(CAST(ts AS DATE)) AS high FROM events
), spine AS (
  SELECT highway_id, minute
  FROM (SELECT DISTINCT highway_id FROM rules),
    (SELECT unnest(generate_series(CAST(low AS TIMESTAMP),
       CAST(high AS TIMESTAMP) + INTERVAL 1439 minutes, INTERVAL 1 minute)) AS minute FROM days)
)"""

EXPECTED = """expected AS (
  SELECT s.highway_id, s.minute,
    arg_min(r.name, r.priority) AS name,
    CAST(arg_min(r.ev_rate, r.priority) AS DOUBLE) AS ev_rate,
    arg_min(r.base_rate, r.priority) AS base_rate,
    arg_min(r.speed, r.priority) AS expected_speed
  FROM spine s JOIN rules r ON s.highway_id = r.highway_id
    AND ((r.from_h <= hour(s.minute) AND hour(s.minute) < r.to_h)
      OR (r.from_h > r.to_h AND (hour(s.minute) >= r.from_h OR hour(s.minute) < r.to_h)))
  GROUP BY s.highway_id, s.minute
)"""

LOGS = """logs AS (
  SELECT event_id AS id, ts, 's' || (user_id % 4) AS service, event_type AS level, props AS line
  FROM events
)"""

_CENTS = "CAST(floor(value * 100 + 0.5) AS BIGINT)"
LOGFMT = f"""logfmt AS (
  SELECT event_id AS id, ts, event_type AS level, {_CENTS} AS cents, user_id,
    'level=' || event_type || ' cents=' || {_CENTS} || ' took=' || {_CENTS} || 'ms size='
      || {_CENTS} || 'KiB user="u ' || user_id || '"' AS line
  FROM events
)"""

_JSON_PAIRS = "SELECT event_id AS id, 'k' AS field, json_extract_string(props, '$.k') AS value FROM events"
_LOGFMT_PAIRS = " UNION ALL ".join(
    f"SELECT id, '{field}' AS field, {value} AS value FROM logfmt"
    for field, value in [
        ("level", "level"),
        ("cents", "CAST(cents AS VARCHAR)"),
        ("took", "cents || 'ms'"),
        ("size", "cents || 'KiB'"),
        ("user", "'u ' || user_id"),
    ]
)


def _shown(where: str, source: str = "logs", cte: str = LOGS) -> str:
    return f"WITH {cte} SELECT id, ts, level, line FROM {source} WHERE {where}"


def _document_lines(where: str) -> str:
    return f"SELECT doc_id AS id, source FROM documents WHERE {where}"


def _avg(mean: str) -> str:
    return f"""WITH {LOGFMT}
SELECT date_trunc('hour', ts) AS bucket, {mean} AS avg, count(*) AS count
FROM logfmt GROUP BY 1"""


_COUNTS = """SELECT date_trunc('hour', ts) AS bucket, event_type AS value, count(*) AS count
FROM events GROUP BY 1, 2"""

_RANKS = f"""SELECT value AS series, round(stddev_pop(count), {DIGITS}) AS stddev,
  CAST(sum(count) AS DOUBLE) AS sum, CAST(max(count) AS DOUBLE) AS max,
  CAST(min(count) AS DOUBLE) AS min
FROM ({_COUNTS}) GROUP BY 1"""


def _plate_rules(cte: str) -> str:
    malformed = "NOT regexp_full_match(plate, '[A-VYZ]{1,2}-[A-VYZ]{1,2} [0-9]{3,4}E?')"
    suffix = "(right(plate, 1) = 'E') != ev"
    parts = [
        ("malformed_plate", malformed),
        ("suffix_disagrees_with_ev", suffix),
        ("any_rule", f"({malformed}) OR ({suffix})"),
    ]
    return f"WITH {cte} " + " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {test}) AS violations FROM passages"
        for rule, test in parts
    )


_OTHER_PLATES = """passages AS (
  SELECT chr(CAST(65 + event_id % 26 AS INTEGER)) || '-'
      || chr(CAST(65 + (event_id // 22) % 26 AS INTEGER)) || ' '
      || printf('%03d', event_id % 9999 + 1)
      || CASE WHEN event_type = 'purchase' THEN 'E' ELSE '' END AS plate,
    (event_type = 'purchase' OR value > 100) AS ev
  FROM events
)"""

_ROLLED = """SELECT date_trunc('day', ts) AS bucket, event_type AS level, count(*) AS count
FROM events GROUP BY 1, 2"""

_IN_RANGE = "ts >= TIMESTAMP '2024-01-03 07:41:13' AND ts < TIMESTAMP '2024-01-24 16:05:59.5'"

_PATTERNS = [
    ('level=<_> cents=1<_> took', "regexp_matches(line, 'level=.* cents=1.* took')"),
    ('level=error <_>', "contains(line, 'level=error ')"),
    ('<_>KiB user="u 1<_>"', "regexp_matches(line, 'KiB user=\"u 1.*\"')"),
    ('absent', "contains(line, 'absent')"),
]
_SIX_HOURS = "time_bucket(INTERVAL 6 hours, ts, TIMESTAMP '1970-01-01')"
_PATTERN_HITS = " UNION ALL ".join(
    f"SELECT '{pattern}' AS pattern, {_SIX_HOURS} AS bucket FROM logfmt WHERE {test}"
    for pattern, test in _PATTERNS
)

ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_passages": f"WITH {SENT} SELECT * FROM sent",
    "encode_records": f"""WITH {SENT}
SELECT CAST(highway_id AS VARCHAR) AS key,
  CASE WHEN epoch_us("timestamp") % 1000000 = 0 THEN strftime("timestamp", '%Y-%m-%d %H:%M:%S')
    ELSE strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') END AS "timestamp",
  highway_id, plate, speed, ev FROM sent""",
    "decode_records": f"WITH {PASSAGES} SELECT CAST(highway_id AS VARCHAR) AS road, * FROM passages",
    "stream_ingest": f"WITH {PASSAGES} SELECT * FROM passages",
    "stream_ingest_merged": f"WITH {PASSAGES} SELECT * FROM passages",
    "rescued_members": f"""WITH {PASSAGES}
SELECT 'lane' AS member, CAST(count(*) AS BIGINT) AS rows, 'int' AS kind FROM passages WHERE ev
UNION ALL SELECT 'note', CAST(count(*) AS BIGINT), 'string' FROM passages WHERE speed > 50""",
    "promoted_members": f"""WITH {PASSAGES}
SELECT *, CASE WHEN ev THEN highway_id + 1 END AS lane, CASE WHEN speed > 50 THEN 'fast' END AS note FROM passages""",
    "fork_outputs": f"""WITH {PASSAGES}
SELECT 'traffic_detailed' AS table_name, CAST(highway_id AS VARCHAR) AS highway_id, count(*) AS rows
FROM passages GROUP BY 2
UNION ALL
SELECT 'traffic_averages', CAST(highway_id AS VARCHAR), count(DISTINCT "timestamp")
FROM passages GROUP BY 2""",
    "sink_averages": _ALL_MEANS,
    "schema_evolve": f"""WITH {PASSAGES}
SELECT "timestamp", highway_id, plate, speed,
  CASE WHEN "timestamp" >= TIMESTAMP '2024-01-16' THEN ev END AS ev FROM passages""",
    "traffic_averages": f"""WITH {PASSAGES.replace("passages AS", "own AS")}, passages AS (
  SELECT "timestamp", speed,
    left(CAST(highway_id + (day("timestamp") % 3 + 1) * 10 AS VARCHAR), 1) AS highway_id FROM own
), {_means()}
SELECT avg_speed, window_start AS window_start_ms, window_end AS window_end_ms,
  left(highway_id, 1) AS new_keys FROM means""",
    "summary_table": f"""WITH {PASSAGES}, {_means()}
SELECT window_start AS "start", window_end AS "end", avg_speed FROM means""",
    # projections, order, time
    "traffic_detailed": f"WITH {PASSAGES} SELECT * FROM passages",
    "road_key": """SELECT event_id, CAST(user_id AS VARCHAR) AS road_key,
  left(CAST(user_id AS VARCHAR), 1) AS first_digit FROM events""",
    "sorted_passages": f'WITH {PASSAGES} SELECT * FROM passages ORDER BY "timestamp", highway_id, plate',
    "head_passages": f"""WITH {PASSAGES}
SELECT * FROM passages ORDER BY "timestamp", highway_id, plate LIMIT 5""",
    "passage_count": "SELECT count(*) AS passages FROM events",
    "parse_event_time": f"""WITH {TIME_TEXTS}
SELECT event_id, event_time, epoch_us(event_time) // 1000 AS event_ms FROM (
  SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('second', ts)
    WHEN 'purchase' THEN ts END AS event_time FROM texts)""",
    "quarantine": f"""WITH {TIME_TEXTS}
SELECT CAST(event_id AS VARCHAR) AS road,
  CASE WHEN time_text IS NULL THEN '{{"highway_id":1}}'
    ELSE '{{"timestamp":"' || time_text || '","highway_id":1}}' END AS value,
  CASE WHEN time_text IS NULL THEN 'no time' ELSE 'malformed time' END AS reason
FROM texts WHERE event_type IN ('signup', 'error', 'view')""",
    # trailing mean
    "avg_speed_30m": _ALL_MEANS,
    "avg_speed_30m_closed": f"""WITH {PASSAGES}, {_means()}
SELECT {_MEAN_COLUMNS} FROM means WHERE window_end < newest""",
    "avg_speed_30m_open_start": f"""WITH {PASSAGES}, {_means("1799999 milliseconds")}
SELECT {_MEAN_COLUMNS} FROM means""",
    "avg_speed_30m_stream": _ALL_MEANS,
    "late_rows": f"""WITH {PASSAGES}, {_means(where="\"timestamp\" >= TIMESTAMP '2024-01-16'")}
SELECT {_MEAN_COLUMNS} FROM means""",
    "avg_speed_30m_repaired": _ALL_MEANS,
    # Electric cars' rows come last: late is what is not newer than the road's other rows.
    "late_rows_kept": f"""WITH {PASSAGES}, clocks AS (
  SELECT highway_id, max("timestamp") AS closed FROM passages WHERE NOT ev GROUP BY 1
)
SELECT p."timestamp", highway_id, plate, speed, ev FROM passages p JOIN clocks USING (highway_id)
WHERE ev AND p."timestamp" <= closed""",
    # replay, profile, plates
    "replay_schedule": f"""WITH {SENT}
SELECT "timestamp", plate,
  (epoch_us("timestamp") - (SELECT min(epoch_us("timestamp")) FROM sent)) / 1e6 / 720 AS offset_s
FROM sent""",
    "event_gap": f"""WITH {SENT}, instants AS (
  SELECT highway_id, "timestamp", count(*) AS passages FROM sent GROUP BY ALL
)
SELECT highway_id, "timestamp", passages,
  coalesce(epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER (
    PARTITION BY highway_id ORDER BY "timestamp"), 0) / 1e6 / 720 AS gap_s
FROM instants""",
    "minute_spine": f"WITH {SPINE} SELECT highway_id, minute FROM spine",
    "expected_profile": f"WITH {SPINE}, {EXPECTED} SELECT * FROM expected",
    "volume_per_minute": f"""WITH {PASSAGES}, {SPINE}, counts AS (
  SELECT highway_id, date_trunc('minute', "timestamp") AS minute, count(*) AS cars
  FROM passages GROUP BY ALL
)
SELECT highway_id, minute, coalesce(cars, 0) AS cars
FROM spine LEFT JOIN counts USING (highway_id, minute)""",
    "profile_deviation": f"""WITH {PASSAGES}, {SPINE}, {EXPECTED}, totals AS (
  SELECT highway_id, date_trunc('minute', "timestamp") AS minute, count(*) AS cars,
    avg(speed) AS avg_speed, avg(CAST(ev AS DOUBLE)) AS ev_share
  FROM passages GROUP BY 1, 2
)
SELECT highway_id, minute, coalesce(cars, 0) AS cars, base_rate,
  coalesce(cars, 0) - base_rate AS cars_deviation,
  round(avg_speed, {DIGITS}) AS avg_speed, expected_speed,
  round(avg_speed - expected_speed, {DIGITS}) AS speed_deviation,
  round(ev_share, {DIGITS}) AS ev_share, ev_rate,
  round(ev_share - ev_rate, {DIGITS}) AS ev_deviation
FROM expected LEFT JOIN totals USING (highway_id, minute)""",
    "plate_violations": _plate_rules(PASSAGES),
    "plate_violations_found": _plate_rules(_OTHER_PLATES),
    # log filters
    "label_filter": _shown("level = 'error'"),
    "label_filter_not": _shown("level != 'error'"),
    "label_filter_regex": _shown("regexp_full_match(level, 'e.*|view')"),
    "label_filter_not_regex": _shown("NOT regexp_full_match(level, 'e|.*c.*')"),
    "label_multi_filter": _shown(
        "(level IN ('error', 'view') OR level LIKE 'sign%') AND service NOT IN ('s0', 's3')"
    ),
    "level_filter": f"""WITH {LOGS}
SELECT id, ts, nullif(level, 'signup') AS level, line FROM logs WHERE level IN ('error', 'signup')""",
    "numeric_filter": _shown("CAST(json_extract_string(line, '$.k') AS DOUBLE) > 90"),
    "numeric_filter_at_least": _shown("CAST(json_extract_string(line, '$.k') AS DOUBLE) >= 90"),
    "numeric_filter_below": _shown("CAST(json_extract_string(line, '$.k') AS DOUBLE) < 9.5"),
    "numeric_filter_at_most": _shown("CAST(json_extract_string(line, '$.k') AS DOUBLE) <= 9"),
    "line_filter": _document_lines("contains(text, 'The')"),
    "line_filter_not": _document_lines("NOT contains(text, 'a')"),
    "line_filter_regex": _document_lines("regexp_matches(text, '[0-9]{3}')"),
    "line_filter_not_regex": _document_lines("NOT regexp_matches(text, '[0-9]')"),
    "line_filter_any_case": _document_lines("contains(lower(text), 'license')"),
    "line_filter_regex_any_case": _document_lines("regexp_matches(text, 'the [a-d]+ ', 'i')"),
    "pattern_filter": _shown(
        """(regexp_matches(line, 'level=error .* size=1.*KiB')
  OR regexp_matches(line, 'level=view .*user="u 2.*'))
  AND NOT regexp_matches(line, 'cents=.*7 took=')""",
        "logfmt",
        LOGFMT,
    ),
    "time_range": _shown("ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-09 12:00:00'"),
    "log_lines": _shown("true ORDER BY ts DESC, id DESC LIMIT 100"),
    "log_lines_oldest": _shown("true ORDER BY ts, id LIMIT 100"),
    # log parsing
    "parse_json_fields": _JSON_PAIRS,
    "parse_logfmt_fields": f"WITH {LOGFMT} {_LOGFMT_PAIRS}",
    "parse_mixed_fields": f"""WITH {LOGFMT}, pairs AS ({_LOGFMT_PAIRS}), json_rows AS (
  SELECT event_id AS id FROM events WHERE event_type IN ('error', 'click')
)
SELECT * FROM ({_JSON_PAIRS}) WHERE id IN (SELECT id FROM json_rows)
UNION ALL
SELECT * FROM pairs WHERE id NOT IN (SELECT id FROM json_rows)""",
    # log counts
    "log_count": "SELECT count(*) AS count FROM events WHERE event_type = 'error'",
    "counts_by_label": _COUNTS,
    "counts_by_label_stream": f"""SELECT * FROM ({_COUNTS})
WHERE bucket + INTERVAL 1 hour <= (SELECT date_trunc('millisecond', max(ts)) FROM events)""",
    "counts_by_field": """SELECT date_trunc('day', ts) AS bucket,
  json_extract_string(props, '$.k') AS value, count(*) AS count FROM events GROUP BY 1, 2""",
    "counts_by_field_body": """SELECT date_trunc('day', ts) AS bucket,
  json_extract_string(props, '$.k') AS value, count(*) AS count FROM events GROUP BY 1, 2""",
    "avg_field_body": """SELECT date_trunc('hour', ts) AS bucket,
  avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS avg, count(*) AS count FROM events GROUP BY 1""",
    "avg_field": _avg("avg(cents)"),
    "avg_field_duration": _avg(f"round(avg(cents / 1000.0::DOUBLE), {DIGITS})"),
    "avg_field_bytes": _avg("avg(cents * 1024)"),
    "label_volume": """SELECT source AS value, CAST(sum(strlen(text)) AS BIGINT) AS volume FROM documents
GROUP BY 1 ORDER BY 2 DESC, 1""",
    "label_volume_top": """SELECT 'u' || user_id AS value, CAST(sum(strlen(props)) AS BIGINT) AS volume FROM events
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "rollup_counts": _ROLLED,
    "rollup_counts_stream": """SELECT step, bucket, service, level, count(*) AS count FROM (
  SELECT '1 hour' AS step, date_trunc('hour', ts) AS bucket, 's' || (user_id % 4) AS service,
    event_type AS level FROM events
  UNION ALL
  SELECT '1 day', date_trunc('day', ts), 's' || (user_id % 4), event_type FROM events
) GROUP BY ALL""",
    "range_counts": f"SELECT event_type AS level, count(*) AS count FROM events WHERE {_IN_RANGE} GROUP BY 1",
    "range_counts_by_day": f"""SELECT date_trunc('day', ts) AS bucket, event_type AS level, count(*) AS count
FROM events WHERE {_IN_RANGE} GROUP BY 1, 2""",
    "pattern_series": f"""WITH {LOGFMT}, series AS (
  SELECT pattern, bucket, count(*) AS count FROM ({_PATTERN_HITS}) GROUP BY 1, 2
)
SELECT pattern, bucket, count, CAST(sum(count) OVER (PARTITION BY pattern) AS BIGINT) AS total
FROM series""",
    "pattern_series_many": """SELECT pattern, bucket, count(*) AS count,
  CAST(sum(count(*)) OVER (PARTITION BY pattern) AS BIGINT) AS total
FROM (SELECT 'level=' || event_type || ' cents=<_> user="u ' || user_id || '"' AS pattern,
  date_trunc('day', ts) AS bucket FROM events) GROUP BY pattern, bucket""",
    "rank_series": _RANKS,
    "rank_series_by_name": _RANKS,
    "rank_series_by_sum": _RANKS,
    # log discovery
    "detected_fields": f"""WITH {LOGFMT}, pairs AS (
  SELECT l.id, l.level, p.field, p.value FROM ({_LOGFMT_PAIRS}) p JOIN logfmt l USING (id)
), seen AS (
  SELECT field, value, 'logfmt' AS parser FROM pairs WHERE level NOT IN ('error', 'click')
  UNION ALL
  SELECT 'k', json_extract_string(props, '$.k'), 'json' FROM events
  WHERE event_type IN ('error', 'click')
)
SELECT field, count(DISTINCT value) AS cardinality, min(parser) AS parser,
  CASE field WHEN 'cents' THEN 'int' WHEN 'k' THEN 'int' WHEN 'took' THEN 'duration'
    WHEN 'size' THEN 'bytes' ELSE 'string' END AS kind
FROM seen WHERE field != 'level' GROUP BY field""",
    "detected_labels": """SELECT 'lang' AS label, count(DISTINCT lang) AS cardinality FROM documents
UNION ALL SELECT 'source', count(DISTINCT source) FROM documents""",
    "label_names": """SELECT 'level' AS label FROM events
UNION SELECT 'service' FROM events WHERE event_type <> 'view'
UNION SELECT 'code' FROM events WHERE event_type = 'error' ORDER BY 1""",
    "label_values": "SELECT DISTINCT source AS value FROM documents ORDER BY 1",
    "label_coverage": f"""WITH {LOGS}, pairs AS (
  SELECT 'service' AS label, service AS value FROM logs
  UNION ALL SELECT 'level', level FROM logs
  UNION ALL SELECT 'code', line FROM logs WHERE level = 'error'
)
SELECT label, CAST(ceil(100 * count(*) / (SELECT count(*) FROM logs)) AS BIGINT) AS percent,
  count(DISTINCT value) AS cardinality, CAST(max(length(value)) AS INTEGER) AS longest
FROM pairs GROUP BY label""",
}
