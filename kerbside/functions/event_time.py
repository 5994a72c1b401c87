"""Event time: text to timestamp, timestamp to text, millisecond truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted forms of the time text, with one to six fraction
# digits or with none.
TIME_TEXT = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?\z"


def parse_event_time(text: Column) -> Column:
    """Timestamp of ``text``, NULL where it has neither accepted form.

    One pattern stands for trying the form with a fraction and then the one
    without; the cast alone would accept dates, zones and longer fractions too.
    NULL rows belong to :func:`kerbside.operators.quality.split_bad_times`.
    """
    return F.when(text.rlike(TIME_TEXT), text.try_cast("timestamp"))


def event_ms(time: Column) -> Column:
    """Epoch milliseconds, microseconds cut off."""
    return F.unix_millis(time)


def truncate_to_ms(time: Column) -> Column:
    return F.timestamp_millis(F.unix_millis(time))


def format_event_time(time: Column) -> Column:
    """Text form of a time: six fraction digits, or none where they are all zero."""
    text = time.cast("string")
    return F.when(F.unix_micros(time) % 1_000_000 == 0, text).otherwise(F.rpad(text, 26, "0"))
