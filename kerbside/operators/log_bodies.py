"""Log lines stored parsed, so that a query on one field reads that field only.

A line that is JSON is parsed once, when it is stored, to a VARIANT column. The
Parquet writer shreds it: members that most lines have become columns of the
file. A query on some fields then opens these columns and no other part of the
line, whatever its length, and parses nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_body(logs: DataFrame) -> DataFrame:
    """Adds ``body``, the line as a VARIANT; NULL where it is not JSON or names a member twice."""
    return logs.withColumn("body", F.try_parse_json("line"))


def _path(name: str) -> str:
    return f"$[{json.dumps(name, ensure_ascii=False)}]"


def body_fields(stored: DataFrame, *names: str) -> DataFrame:
    """Adds ``fields`` with the members ``names`` of each body, as text.

    What :func:`kerbside.operators.log_parse.parse_fields` gives for these names,
    but that numbers are written in their shortest form (1.50 as 1.5).
    """
    pairs = [x for n in names for x in (F.lit(n), F.try_variant_get("body", F.lit(_path(n)), "string"))]
    return stored.withColumn("fields", F.create_map(*pairs))
