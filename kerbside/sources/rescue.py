"""Members of records that the schema lacks: kept, looked at, and made columns.

A record may gain members while a stream runs. Decoding by a fixed schema would
drop them, and a restart with a wider schema cannot bring back what is stored
without them. Here they go to the table in one map column; which of them have
become regular is a query on it; and a promoted member is a column of its own for
new rows at once and, on reading, for the rows stored before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.log_discover import kind_of_all, value_kind
from kerbside.schema import RAW_PASSAGES

RESCUED = "rescued"
_MAP = "map<string,string>"


def unknown_members(value: Column, known: list[str] | None = None) -> Column:
    """Top-level members of a JSON record that are not ``known``, as text; NULL if there are none."""
    names = RAW_PASSAGES.names if known is None else known
    others = F.map_filter(F.from_json(value.cast("string"), _MAP), lambda k, v: ~k.isin(*names) & v.isNotNull())
    return F.transform(F.array(others), lambda m: F.when(F.size(m) > 0, m))[0]


def with_rescued(decoded: DataFrame) -> DataFrame:
    """Adds the unknown members of decoded records (see ``decode_records``), for ``transform`` hooks."""
    return decoded.withColumn(RESCUED, unknown_members(F.col("value")))


def rescued_members(rows: DataFrame) -> DataFrame:
    """Unknown members by name: ``member, rows, kind`` and ``share`` of all rows, most frequent first."""
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    each = rows.select(F.explode(RESCUED).alias("member", "value"))
    each = each.groupBy("member", value_kind(F.col("value")).alias("kind")).agg(F.count(F.lit(1)).alias("rows"))
    found = each.groupBy("member").agg(F.sum("rows").alias("rows"), F.collect_set("kind").alias("kinds"))
    share = F.col("rows") / total
    found = found.select("member", "rows", kind_of_all("kinds").alias("kind"), share.alias("share"))
    return found.orderBy(F.col("rows").desc(), "member")


def promote(rows: DataFrame, members: dict[str, str]) -> DataFrame:
    """Makes members columns of the given types, for new rows and for stored ones alike.

    A row that has the column already keeps its value. Text that is not of the type
    stays in the map, so nothing is lost; what became a column leaves it.
    """
    for name, kind in members.items():
        text = F.col(RESCUED)[name]
        held = F.col(name) if name in rows.columns else F.lit(None)
        rows = rows.withColumn(name, F.coalesce(held.cast(kind), text.try_cast(kind)))
    gone = lambda k, v: reduce(
        lambda a, b: a | b,
        [(k == name) & v.try_cast(kind).isNotNull() for name, kind in members.items()],
        F.lit(False),
    )
    left = F.map_filter(RESCUED, lambda k, v: ~gone(k, v))
    return rows.withColumn(RESCUED, F.transform(F.array(left), lambda m: F.when(F.size(m) > 0, m))[0])
