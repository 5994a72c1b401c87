"""URL filters: a sort-merge range join of URLs with host and path rules.

A host becomes a key of its labels in reverse, each closed by a dot:
``blog.example.org`` is ``org.example.blog.``. All subdomains of a host then
lie in one interval of keys, and intervals of different rules are nested or
apart. Both sides are cut into the same ranges of keys; a rule goes to every
range that its interval meets. In a range the rows are swept in key order,
with a stack of the rules whose intervals are open; a URL is tested against
the stack, at most one level for each label of its host.

The cut points come from a bounded sample of keys and only decide where rows
go. A key that fills several ranges is dealt over all of them, so a host may
hold any share of the pages.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import UPPER, shuffle_partitions

# Keys that the cut points are chosen from; this many reach the driver at most.
SAMPLE_ROWS = 20_000

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot; empty for an empty host."""
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ".")
    return F.when(host == "", "").otherwise(F.concat(labels, F.lit(".")))


def rules_frame(spark, rules: list[Rule]) -> DataFrame:
    """A small rule list as a table of ``host, path, verdict``."""
    rows = F.array(*[
        F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
        for h, p, v in rules
    ])
    none = spark.createDataFrame([], "host string, path string, verdict string")
    return spark.range(1).select(F.inline(rows)) if rules else none


def _cuts(keys: DataFrame, ranges: int) -> list[str]:
    """Ascending keys that cut the table into ranges; equal ones where a key is frequent.

    About ``SAMPLE_ROWS`` keys reach the driver, whatever the number of rows or
    tasks. They only place the cuts; no verdict depends on them.
    """
    rows = keys.count()
    sample = keys.sample(SAMPLE_ROWS / rows, seed=0) if rows > SAMPLE_ROWS else keys
    found = sorted(r.key for r in sample.collect())
    return [found[len(found) * i // ranges] for i in range(1, ranges)] if found else []


def _deal_pages(cuts: list[str]):
    """Add ``part``: the range of a key, or one of those that a frequent key fills."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in filter(len, batches):
            first = [bisect_left(cuts, k) for k in rows["key"]]
            last = [bisect_right(cuts, k) for k in rows["key"]]
            part = [a + s % (b - a + 1) for a, b, s in zip(first, last, rows["salt"], strict=True)]
            yield rows.assign(part=part).drop(columns="salt")

    return deal


def _deal_rules(cuts: list[str]):
    """A row for each range that the interval of a rule meets."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in filter(len, batches):
            # All keys below a rule start with its key, whose last character is a dot.
            ends = [k[:-1] + "/" for k in rows["key"]]
            parts = [
                list(range(bisect_left(cuts, k), bisect_left(cuts, e) + 1))
                for k, e in zip(rows["key"], ends, strict=True)
            ]
            yield rows.assign(part=parts).explode("part").astype({"part": "int64"})

    return deal


class _Level:
    """Rules of one host: paths by length, to test a path's prefixes."""

    def __init__(self, key: str):
        self.key = key
        self.paths: dict[int, dict[str, tuple[int, str, str]]] = {}

    def add(self, path: str, rank: int, rule: str, verdict: str) -> None:
        self.paths.setdefault(len(path), {}).setdefault(path, (rank, rule, verdict))

    def best(self, path: str) -> tuple[int, str, str] | None:
        for size in sorted(self.paths, reverse=True):
            if size <= len(path) and (found := self.paths[size].get(path[:size])):
                return found
        return None


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of (part, key, rules first): judge pages by the open rules."""
    part, stack = None, []
    for rows in filter(len, batches):
        rules, verdicts = [], []
        columns = (rows[c] for c in ("part", "key", "is_page", "path", "rule", "verdict"))
        for at, key, is_page, path, rule, verdict in zip(*columns, strict=True):
            if at != part:
                part, stack = at, []
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if not is_page:
                if not stack or stack[-1].key != key:
                    stack.append(_Level(key))
                stack[-1].add(path, len(rule), rule, verdict)
                continue
            found = [b for level in reversed(stack) if (b := level.best(path))]
            # Longest rule text; the deeper host where two are as long.
            best = max(found, key=lambda b: b[0], default=(0, None, None))
            rules.append(best[1])
            verdicts.append(best[2])
        if rules:
            pages = rows.loc[rows["is_page"], ["page_id", "host", "path"]]
            yield pages.assign(rule=rules, verdict=verdicts)


def judge_urls(
    pages: DataFrame, rules: DataFrame, *, default="allow", ranges: int | None = None
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host, path, verdict``; hosts are lower case without a
    trailing dot. A rule fits its host and all subdomains where the URL's path
    starts with the rule's; the longest (host and path together) wins. URLs that
    no rule fits get ``default``. Null URLs and those without ``://`` have an
    empty host and path, which no rule fits; rules without a host are left out;
    of rules that are equal in host and path the first by verdict holds; equal
    pages are judged alike; other columns are ignored.
    """
    spark = pages.sparkSession
    ranges = ranges or 2 * shuffle_partitions(spark)
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("key", host_key(F.col("host")))
    cuts = _cuts(rows.select("key"), ranges)

    salt = F.pmod(F.xxhash64("page_id", "path"), F.lit(1 << 20)).alias("salt")
    dealt = rows.select("page_id", "host", "path", "key", salt).mapInPandas(
        _deal_pages(cuts), "page_id long, host string, path string, key string, part long"
    )
    usable = rules.where("coalesce(host, '') != ''").select(
        "host", F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    usable = usable.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    keyed = usable.select(
        host_key(F.col("host")).alias("key"),
        "path",
        F.concat("host", "path").alias("rule"),
        "verdict",
    ).mapInPandas(
        _deal_rules(cuts), "key string, path string, rule string, verdict string, part long"
    )
    none = F.lit(None).cast("string")
    both = dealt.select(
        "part", "key", F.lit(True).alias("is_page"), "page_id", "host", "path",
        none.alias("rule"), none.alias("verdict"),
    ).unionByName(
        keyed.select(
            "part", "key", F.lit(False).alias("is_page"), F.lit(None).cast("long").alias("page_id"),
            none.alias("host"), "path", "rule", "verdict",
        )
    )
    swept = (
        both.repartition("part")
        .sortWithinPartitions("part", "key", "is_page")
        .mapInPandas(
            _sweep, "page_id long, host string, path string, rule string, verdict string"
        )
    )
    return swept.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
