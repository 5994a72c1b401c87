"""Parsing log lines to a map of text fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = "map<string,string>"

# Fixed value: one ``key=value`` or ``key="quoted value"`` of a logfmt line.
PAIR = r'([^\s="]+)=("(?:[^"\\]|\\.)*+"|[^\s"]*+)'


def _no_fields() -> Column:
    return F.create_map().cast(FIELDS)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _first_of_each_name(names: Column, values: Column) -> Column:
    """Map from two parallel arrays; of equal names the first is kept."""

    def is_first(pair: Column, i: Column) -> Column:
        return F.array_position(names, pair["name"]) == i + 1

    pairs = F.arrays_zip(names.alias("name"), values.alias("value"))
    return F.map_from_entries(F.filter(pairs, is_first))


def _json_or_null(line: Column) -> Column:
    def tidy(parsed: Column) -> Column:
        names = F.map_keys(parsed)
        plain = F.size(F.array_distinct(names)) == F.size(names)
        once = F.when(plain, parsed).otherwise(_first_of_each_name(names, F.map_values(parsed)))
        return F.map_filter(once, lambda _, value: value.isNotNull())

    # Lines that cannot be an object are not worth a failed parse.
    parsed = F.when(line.rlike(r"^\s*\{"), F.from_json(line, FIELDS))
    return _with(parsed, tidy)


def json_fields(line: Column) -> Column:
    """Top-level members of a JSON object; no fields where the line is not one.

    Members that are ``null`` are left out and of equal names the first is kept.
    """
    return F.coalesce(_json_or_null(line), _no_fields())


def _unquoted(value: Column) -> Column:
    inside = F.substring(value, F.lit(2), F.length(value) - 2)
    # A quoted value has the escapes of a JSON string; other escapes stand for their letter.
    as_json = F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")
    plain = F.regexp_replace(inside, r"\\(.)", "$1")
    quoted = F.when(value.contains("\\"), F.coalesce(as_json, plain)).otherwise(inside)
    return F.when(value.startswith('"'), quoted).otherwise(value)


def logfmt_fields(line: Column) -> Column:
    """Pairs of a logfmt line, quotes and backslash escapes resolved."""

    def to_map(found: Column) -> Column:
        names, values = found["names"], found["values"]
        plain = F.size(F.array_distinct(names)) == F.size(names)
        return F.when(plain, F.map_from_arrays(names, values)).otherwise(
            _first_of_each_name(names, values)
        )

    found = F.struct(
        F.regexp_extract_all(line, F.lit(PAIR), F.lit(1)).alias("names"),
        F.transform(F.regexp_extract_all(line, F.lit(PAIR), F.lit(2)), _unquoted).alias("values"),
    )
    return F.coalesce(_with(found, to_map), _no_fields())


def mixed_fields(line: Column) -> Column:
    """JSON members where the line is JSON, logfmt pairs otherwise."""
    return F.coalesce(_json_or_null(line), logfmt_fields(line))


PARSERS = {"json": json_fields, "logfmt": logfmt_fields, "mixed": mixed_fields}


def parse_fields(logs: DataFrame, parser: str) -> DataFrame:
    """Adds ``fields``. Lines that do not parse stay, with no fields."""
    return logs.withColumn("fields", PARSERS[parser](F.col("line")))


def explode_fields(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per field and value, with the columns ``keep``.

    The outer form is used and emptied afterwards, because the plain form makes
    the optimizer test the map's size below, which parses every line twice.
    """
    pairs = parsed.select(*keep, F.explode_outer("fields").alias("field", "value"))
    return pairs.where(F.col("field").isNotNull())


def fields_and_parser(line: Column) -> Column:
    """Struct of the fields and whether JSON gave them; NULL for a line without fields."""

    def held(is_json: bool) -> Callable[[Column], Column]:
        return lambda fields: F.when(
            F.size(fields) > 0, F.struct(F.lit(is_json).alias("is_json"), fields.alias("fields"))
        )

    return F.coalesce(_with(_json_or_null(line), held(True)), _with(logfmt_fields(line), held(False)))


def which_parser(is_json: Column, is_logfmt: Column) -> Column:
    """Parser to use for a field seen through these parsers: neither means the
    field comes with the row (``structuredMetadata``), both means ``mixed``."""
    return (
        F.when(is_json & is_logfmt, "mixed")
        .when(is_json, "json")
        .when(is_logfmt, "logfmt")
        .otherwise("structuredMetadata")
    )
