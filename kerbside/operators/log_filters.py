"""Restricting log rows: time range, labels, levels, numbers, text, patterns.

Every filter is a deterministic predicate of built-in functions, so filters may
be applied in any order and still be combined and pushed to the scan. Time and
label filters come first in :func:`restrict` and parsing of lines comes after.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.matching import (
    full_match,
    match_any_of,
    match_label,
    match_line,
    match_none_of,
    match_number,
    match_pattern,
)
from kerbside.operators.log_parse import parse_fields


def time_range(logs: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Rows with ``start <= ts < end``."""
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return logs.where((F.col("ts") >= low) & (F.col("ts") < high))


def label(name: str) -> Column:
    return F.col("labels")[name]


def label_filter(logs: DataFrame, name: str, op: str, value: str) -> DataFrame:
    return logs.where(match_label(label(name), op, value))


def label_multi_filter(logs: DataFrame, filters: list[tuple[str, str, str]]) -> DataFrame:
    """Several label filters at once, as (name, operator, value).

    Different labels are combined with AND. For one label, several ``=`` values
    join its ``=~`` values in one alternation, and all ``!=`` and ``!~`` values
    exclude. A single ``=`` beside ``=~`` stays a condition of its own.
    """
    condition = reduce(
        lambda a, b: a & b,
        [_one_label(name, filters) for name in dict.fromkeys(n for n, _, _ in filters)],
        F.lit(True),
    )
    return logs.where(condition)


def _any_regex(values: list[str]) -> str:
    """One alternation; flags inside a value hold for that value alone."""
    return "|".join(f"(?:{v})" for v in values)


def _one_label(name: str, filters: list[tuple[str, str, str]]) -> Column:
    values = {
        op: [v for n, o, v in filters if n == name and o == op] for op in ("=", "=~", "!=", "!~")
    }
    held, text = label(name), F.coalesce(label(name), F.lit(""))
    conditions = []
    regex = full_match(text, _any_regex(values["=~"])) if values["=~"] else None
    if values["="]:
        exact = match_any_of(held, values["="])
        if regex is not None and len(values["="]) > 1:
            regex = F.coalesce(exact, F.lit(False)) | regex
        else:
            conditions.append(exact)
    if regex is not None:
        conditions.append(regex)
    if values["!="]:
        conditions.append(match_none_of(held, values["!="]))
    if values["!~"]:
        conditions.append(~full_match(text, _any_regex(values["!~"])))
    return reduce(lambda a, b: a & b, conditions)


def level_filter(logs: DataFrame, levels: list[str], name: str = "level") -> DataFrame:
    """Rows of any of the chosen levels; ``logs`` stands for rows without one."""
    if not levels:
        return logs
    return logs.where(match_any_of(label(name), ["" if v == "logs" else v for v in levels]))


def numeric_filter(parsed: DataFrame, field: str, op: str, bound: float) -> DataFrame:
    return parsed.where(match_number(F.col("fields")[field], op, bound))


def line_filter(logs: DataFrame, op: str, text: str, ignore_case: bool = False) -> DataFrame:
    return logs.where(match_line(F.col("line"), op, text, ignore_case))


def pattern_filter(logs: DataFrame, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """Rows that fit any included pattern and no excluded one."""
    keep = [~match_pattern(F.col("line"), p) for p in exclude]
    if include:
        keep.append(reduce(lambda a, b: a | b, [match_pattern(F.col("line"), p) for p in include]))
    return logs.where(reduce(lambda a, b: a & b, keep, F.lit(True)))


def restrict(
    logs: DataFrame,
    *,
    span: tuple[datetime | str, datetime | str] | None = None,
    labels: list[tuple[str, str, str]] = (),
    levels: list[str] = (),
    lines: list[tuple[str, str, bool]] = (),
    include: list[str] = (),
    exclude: list[str] = (),
    parser: str | None = None,
    numbers: list[tuple[str, str, float]] = (),
) -> DataFrame:
    """A whole log query: time range, labels, levels, lines, patterns, then parsed fields.

    ``labels`` are (name, operator, value), ``lines`` (operator, text, ignore
    case) and ``numbers`` (field, operator, bound), which need a ``parser``.
    What reads no line comes first and reaches the scan; lines are parsed last.
    """
    rows = logs if span is None else time_range(logs, *span)
    rows = label_multi_filter(rows, list(labels)) if labels else rows
    rows = level_filter(rows, list(levels))
    for op, text, ignore_case in lines:
        rows = line_filter(rows, op, text, ignore_case)
    if include or exclude:
        rows = pattern_filter(rows, list(include), list(exclude))
    if parser is None:
        if numbers:
            raise ValueError("filters by number need a parser")
        return rows
    rows = parse_fields(rows, parser)
    for field, op, bound in numbers:
        rows = numeric_filter(rows, field, op, bound)
    return rows


def log_lines(logs: DataFrame, limit: int, newest_first: bool = True) -> DataFrame:
    """The preview of log rows: the newest (or oldest) ``limit`` rows.

    Each task keeps its own ``limit`` rows before they are merged.
    """
    order = [F.col("ts"), F.col("id")]
    return logs.orderBy(*[c.desc() if newest_first else c.asc() for c in order]).limit(limit)
