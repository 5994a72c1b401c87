"""Orders, heads and counts of the passage table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sorted_passages(passages: DataFrame) -> DataFrame:
    """All passages in time order; ties by road and plate make the order total."""
    return passages.orderBy("timestamp", "highway_id", "plate")


def head_passages(passages: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` passages in time order, kept per task before they meet."""
    return sorted_passages(passages).limit(n)


def passage_count(passages: DataFrame) -> DataFrame:
    return passages.agg(F.count(F.lit(1)).alias("passages"))
