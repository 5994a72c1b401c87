"""What labels and fields the log rows have.

Maps are exploded once and counted per (name, value) before anything is
gathered per name: the first aggregation is partial and spreads even a single
dominant name over all tasks by its values. What a name needs is then derived
from its distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.units import duration_seconds, size_bytes
from kerbside.functions.units import FLOAT
from kerbside.operators.log_filters import label
from kerbside.operators.log_parse import fields_and_parser, which_parser

# Level fields hidden from the field list, and internal labels
# hidden from the label list.
LEVEL_FIELDS = ["level_extracted", "detected_level", "level"]
INTERNAL_LABELS = ["__aggregated_metric__", "__stream_shard__"]




def value_kind(value: Column) -> Column:
    """Kind of one text value: int, float, boolean, duration, bytes or string."""
    return (
        F.when(value.rlike(r"^[+-]?\d+\z"), "int")
        .when(value.rlike(FLOAT), "float")
        .when(F.lower(value).isin("true", "false"), "boolean")
        .when(duration_seconds(value).isNotNull(), "duration")
        .when(size_bytes(value).isNotNull(), "bytes")
        .otherwise("string")
    )


def kind_of_all(kinds: str) -> Column:
    """Kind of a field from the set of its values' kinds; int widens to float."""
    held = F.col(kinds)
    return (
        F.when(F.size(held) == 1, held[0])
        .when(F.size(F.array_except(held, F.array(F.lit("int"), F.lit("float")))) == 0, "float")
        .otherwise("string")
    )


def detected_fields(logs: DataFrame, approximate: bool = False) -> DataFrame:
    """Fields found in the lines: number of distinct values, parser and kind.

    Every line is tried as JSON, else as logfmt. ``approximate`` estimates the
    number of values in one aggregation per name instead of counting exactly.
    """
    found = fields_and_parser(F.col("line"))
    rows = (
        logs.select(found.alias("found"))
        .select("found.is_json", F.explode("found.fields").alias("field", "value"))
        .where(~F.col("field").isin(LEVEL_FIELDS))
    )
    if approximate:
        per_name = rows.groupBy("field").agg(
            F.approx_count_distinct("value").alias("cardinality"),
            F.bool_or("is_json").alias("in_json"),
            F.bool_or(~F.col("is_json")).alias("in_logfmt"),
            F.collect_set(value_kind(F.col("value"))).alias("kinds"),
        )
    else:
        per_value = rows.groupBy("field", "value").agg(
            F.bool_or("is_json").alias("in_json"), F.bool_or(~F.col("is_json")).alias("in_logfmt")
        )
        # At most six kinds exist, so the set per field stays small.
        per_name = per_value.groupBy("field").agg(
            F.count(F.lit(1)).alias("cardinality"),
            F.bool_or("in_json").alias("in_json"),
            F.bool_or("in_logfmt").alias("in_logfmt"),
            F.collect_set(value_kind(F.col("value"))).alias("kinds"),
        )
    return per_name.select(
        "field",
        "cardinality",
        which_parser(F.col("in_json"), F.col("in_logfmt")).alias("parser"),
        kind_of_all("kinds").alias("kind"),
    )


def _label_pairs(logs: DataFrame) -> DataFrame:
    return logs.select(F.explode("labels").alias("label", "value")).where(F.col("value").isNotNull())


def detected_labels(logs: DataFrame, approximate: bool = False) -> DataFrame:
    """Labels and their number of values: fewest first, single-valued ones last."""
    pairs = _label_pairs(logs).where(~F.col("label").isin(INTERNAL_LABELS))
    if approximate:
        counted = pairs.groupBy("label").agg(F.approx_count_distinct("value").alias("cardinality"))
    else:
        counted = pairs.distinct().groupBy("label").agg(F.count(F.lit(1)).alias("cardinality"))
    return counted.orderBy(F.col("cardinality") == 1, "cardinality", "label")


def label_names(logs: DataFrame) -> DataFrame:
    return logs.select(F.explode(F.map_keys("labels")).alias("label")).distinct().orderBy("label")


def label_values(logs: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """All values of one label in order, or the first ``limit``."""
    held = label(name)
    values = logs.where(held.isNotNull()).select(held.alias("value")).distinct().orderBy("value")
    return values if limit is None else values.limit(limit)


def label_coverage(logs: DataFrame) -> DataFrame:
    """Per label: share of rows that have it in whole percent rounded up,
    number of distinct values and length of the longest value."""
    total = logs.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_value = _label_pairs(logs).groupBy("label", "value").agg(F.count(F.lit(1)).alias("rows"))
    per_name = per_value.groupBy("label").agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("cardinality"),
        F.max(F.length("value")).alias("longest"),
    )
    return per_name.select(
        "label",
        F.ceil(F.lit(100) * F.col("rows") / total).alias("percent"),
        "cardinality",
        "longest",
    )
