"""Counts over time on a stream of log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kerbside.operators.log_counts import counts_by_label


def counts_by_label_stream(
    logs: DataFrame,
    name: str,
    step: str,
    require_label: bool = False,
    *,
    watermark_delay: str,
) -> DataFrame:
    """Rows per bucket and label value, each bucket once it is closed.

    A bucket closes when the watermark reaches its end, so the newest bucket
    stays out until later rows arrive.
    """
    return counts_by_label(logs.withWatermark("ts", watermark_delay), name, step, require_label)
