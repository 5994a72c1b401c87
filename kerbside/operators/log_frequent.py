"""The largest values of a label that has very many, without counting every value.

A first pass adds volumes up by hash bucket, a table of fixed size however many
values there are. A bucket's sum is at least the volume of any value in it. Only
values of the largest buckets are counted exactly, in a second pass; if the last
one wanted is above the sum of every bucket left out, no value elsewhere can
belong among them, and the result is exact. Otherwise more buckets are taken, and
at the end every value is counted. A column says which it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.log_filters import label

BUCKETS = 1 << 16
# Buckets per wanted value at first, by how much they grow, and how often.
PER_VALUE, GROWTH, TRIES = 4, 8, 3


def _ranked(volumes: DataFrame, n: int) -> DataFrame:
    return volumes.orderBy(F.col("volume").desc(), F.col("value")).limit(n)


def _volumes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("value").agg(F.sum("size").alias("volume"))


def top_values(
    logs: DataFrame,
    name: str,
    n: int,
    size: Column | None = None,
    *,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The ``n`` largest values of a label: ``value, volume, proof``, largest first, ties by value.

    ``size`` is what a row adds, by default the bytes of its line; it must not be
    negative. ``proof`` is ``bound`` where the buckets left out prove the result, and
    ``all values`` where every value had to be counted. Rows without the label are
    left out. Equals the first ``n`` rows of ``label_volume``.
    """
    held = label(name)
    size = F.octet_length("line") if size is None else size
    rows = logs.where(held.isNotNull()).select(held.alias("value"), F.coalesce(size, F.lit(0)).alias("size"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    sums = rows.groupBy("bucket").agg(F.sum("size").alias("most"))
    # At most ``buckets`` rows, and of them the largest that all tries may need.
    wanted = min(buckets, n * PER_VALUE * GROWTH ** (TRIES - 1))
    largest = sums.orderBy(F.col("most").desc(), "bucket").limit(wanted + 1).collect()
    taken = n * PER_VALUE
    for _ in range(TRIES):
        chosen, rest = largest[:taken], largest[taken:]
        table = rows.sparkSession.createDataFrame([(r["bucket"],) for r in chosen], "bucket long")
        found = _ranked(_volumes(rows.join(table, "bucket", "left_semi")), n).persist()
        least = found.agg(F.min("volume"), F.count(F.lit(1))).first()
        if not rest or (least[1] == n and least[0] > rest[0]["most"]):
            # Few rows: n values.
            values = [tuple(r) for r in found.orderBy(F.col("volume").desc(), "value").collect()]
            found.unpersist()
            done = rows.sparkSession.createDataFrame(values, found.schema)
            return done.withColumn("proof", F.lit("bound")).orderBy(F.col("volume").desc(), "value")
        found.unpersist()
        taken = taken * GROWTH
    return _ranked(_volumes(rows), n).withColumn("proof", F.lit("all values"))
