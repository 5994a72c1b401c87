"""Setting malformed rows aside, and checks of the data contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the form of a number plate. Letters leave out W and X.
PLATE = r"^[A-VYZ]{1,2}-[A-VYZ]{1,2} [0-9]{3,4}E?\z"


def bad_row_reason() -> Column:
    """Why a decoded record cannot be used; NULL for a good one."""
    return (
        F.when(F.col("timestamp").isNull() & F.col("time_text").isNull(), "no time")
        .when(F.col("timestamp").isNull(), "malformed time")
        .when(F.col("road").isNull(), "no key")
        .when(_bad_speed(), "malformed speed")
    )


def _bad_speed() -> Column:
    """The record has a speed that is no number; a missing or null one is not an error."""
    held = F.get_json_object(F.col("value").cast("string"), "$.speed")
    return F.col("speed").isNull() & held.isNotNull()


def split_bad_times(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, quarantined rows with their reason and raw value)."""
    bad_row = F.col("timestamp").isNull() | F.col("road").isNull() | _bad_speed()
    good = decoded.where(~bad_row)
    bad = decoded.where(bad_row).select("road", "value", bad_row_reason().alias("reason"))
    return good, bad


def traffic_detailed(decoded: DataFrame, *added: str) -> DataFrame:
    """The five columns of the detail table, and any others that are asked for."""
    return decoded.select("timestamp", "highway_id", "plate", "speed", "ev", *added)


def plate_violations(passages: DataFrame) -> DataFrame:
    """Rows per broken plate rule, one output row per rule, zero counts included."""
    # A NULL plate or flag breaks the rule it cannot satisfy.
    malformed = ~F.coalesce(F.col("plate").rlike(PLATE), F.lit(False))
    suffix = F.coalesce(F.col("plate").endswith("E") != F.col("ev"), F.lit(True))
    counts = passages.agg(
        F.count_if(malformed).alias("malformed_plate"),
        F.count_if(suffix).alias("suffix_disagrees_with_ev"),
        F.count_if(malformed | suffix).alias("any_rule"),
    )
    return counts.unpivot(
        [], ["malformed_plate", "suffix_disagrees_with_ev", "any_rule"], "rule", "violations"
    )
