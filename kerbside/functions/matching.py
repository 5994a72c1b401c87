"""Label, line and pattern matching as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions.units import plain_number

WILDCARD = "<_>"


def _quote(text: str) -> str:
    """``text`` as a regular expression that matches just itself."""
    return re.sub(r"([\\.\[\]{}()*+?^$|&~#\-])", r"\\\1", text)


def full_match(value: Column, regex: str) -> Column:
    """Regular expression match over the whole value."""
    return value.rlike(rf"^(?:{regex})\z")


def match_label(label: Column, op: str, value: str) -> Column:
    """``label op value`` for the operators ``=  !=  =~  !~``.

    An absent label counts as the empty string. The plain forms avoid
    ``coalesce`` where they can, so that they still reach a Parquet scan as
    pushed filters.
    """
    if op == "=":
        return F.coalesce(label, F.lit("")) == "" if value == "" else label == value
    if op == "!=":
        if value == "":
            return label.isNotNull() & (label != "")
        return label.isNull() | (label != value)
    if op == "=~":
        return full_match(F.coalesce(label, F.lit("")), value)
    if op == "!~":
        return ~full_match(F.coalesce(label, F.lit("")), value)
    raise ValueError(f"unknown label operator {op!r}")


def match_any_of(label: Column, values: list[str]) -> Column:
    """The label equals one of ``values``; an absent label is the empty string."""
    held = label.isin(*[v for v in values if v != ""])
    if "" in values:
        return label.isNull() | (label == "") | held
    return held


def match_none_of(label: Column, values: list[str]) -> Column:
    return ~F.coalesce(match_any_of(label, values), F.lit(False))


def match_number(field: Column, op: str, bound: float) -> Column:
    """Compare a text field as a number; text that is not a number never matches."""
    number = plain_number(field)
    if op == ">":
        return number > bound
    if op == ">=":
        return number >= bound
    if op == "<":
        return number < bound
    if op == "<=":
        return number <= bound
    raise ValueError(f"unknown numeric operator {op!r}")


def match_line(line: Column, op: str, text: str, ignore_case: bool = False) -> Column:
    """Line filters: ``|=`` contains, ``!=`` does not, ``|~`` and ``!~`` by regex."""
    if op in ("|=", "!="):
        if ignore_case:
            hit = F.lower(line).contains(text.lower())
        else:
            hit = line.contains(text)
        return hit if op == "|=" else ~hit
    if op in ("|~", "!~"):
        hit = line.rlike(("(?i)" if ignore_case else "") + text)
        return hit if op == "|~" else ~hit
    raise ValueError(f"unknown line operator {op!r}")


def match_pattern(line: Column, pattern: str) -> Column:
    """The line holds the pattern, in which ``<_>`` spans any text.

    The literal parts have to occur in order. Taking the first occurrence of
    each is enough, so the groups are atomic and one pass decides.
    """
    parts = [part for part in pattern.split(WILDCARD) if part]
    if not parts:
        return line.isNotNull()
    if len(parts) == 1:
        return line.contains(parts[0])
    return line.rlike("(?s)^" + "".join(f"(?>.*?{_quote(part)})" for part in parts))
