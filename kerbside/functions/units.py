"""Numbers with units inside log fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds per duration unit.
DURATION_SECONDS = {
    "ns": 1e-9,
    "us": 1e-6,
    "µs": 1e-6,
    "ms": 1e-3,
    "s": 1.0,
    "m": 60.0,
    "h": 3600.0,
}

# Bytes per size unit, lower case.
SIZE_BYTES = {
    "": 1,
    "b": 1,
    "kb": 10**3,
    "mb": 10**6,
    "gb": 10**9,
    "tb": 10**12,
    "pb": 10**15,
    "kib": 2**10,
    "mib": 2**20,
    "gib": 2**30,
    "tib": 2**40,
    "pib": 2**50,
    "eb": 10**18,
    "zb": 10**21,
    "yb": 10**24,
    "eib": 2**60,
    "zib": 2**70,
    "yib": 2**80,
}

_NUMBER = r"\d+(?:\.\d+)?"
_DURATION_UNIT = "ns|us|µs|ms|s|m|h"
_DURATION = rf"^-?(?:{_NUMBER}(?:{_DURATION_UNIT}))+\z"
_SIZE = rf"^({_NUMBER})\s*([kmgtpezy]?i?b|)\z"

# Fixed value: decimal and exponent forms of a number. A cast alone would also take
# NaN, Infinity and a trailing d or f.
FLOAT = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\z"


def _lookup(unit: Column, table: dict) -> Column:
    start = F.when(F.lit(False), F.lit(None).cast("double"))
    return reduce(lambda c, kv: c.when(unit == kv[0], F.lit(float(kv[1]))), table.items(), start)


def duration_seconds(text: Column) -> Column:
    """Seconds of a duration such as ``1h2m3.5s``; NULL where it is not one."""
    amount = F.regexp_extract_all(text, F.lit(rf"({_NUMBER})({_DURATION_UNIT})"), F.lit(1))
    unit = F.regexp_extract_all(text, F.lit(rf"({_NUMBER})({_DURATION_UNIT})"), F.lit(2))
    parts = F.zip_with(
        amount, unit, lambda a, u: a.cast("double") * _lookup(u, DURATION_SECONDS)
    )
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    sign = F.when(text.startswith("-"), -1.0).otherwise(1.0)
    return F.when(text.rlike(_DURATION), sign * total)


def size_bytes(text: Column) -> Column:
    """Bytes of a size such as ``1.5KiB`` or ``20 MB``; NULL where it is not one."""
    low = F.lower(F.trim(text))
    amount = F.regexp_extract(low, _SIZE, 1).try_cast("double")
    return amount * _lookup(F.regexp_extract(low, _SIZE, 2), SIZE_BYTES)


def plain_number(text: Column) -> Column:
    """The number a text stands for; NULL where it is not a plain one."""
    # One use of the text: a filter would compute it again for a second one.
    return F.regexp_extract(text, FLOAT, 0).try_cast("double")


READERS = {"float": plain_number, "duration": duration_seconds, "bytes": size_bytes}
