"""Road keys carried by records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_key(highway_id: Column) -> Column:
    """UTF-8 bytes of the road number's text form."""
    return highway_id.cast("string").cast("binary")


def road_key(key: Column, first_digit_only: bool = False) -> Column:
    """Text of a record key.

    ``first_digit_only`` keeps just the first character, which merges road 12
    into road 1; it exists for tables that were filled that way.
    """
    text = key.cast("string")
    return F.substring(text, 1, 1) if first_digit_only else text


def rounded_speed(speed: Column) -> Column:
    """Speed to the three places that passages carry."""
    return F.round(speed, 3)
