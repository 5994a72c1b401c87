"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same number of expected copies: the
source's target over its size. The expected copies are summed along the source
in an order that runs up and down through the sizes; with one random offset
for the source, a document is emitted once for each whole number that its
stretch of the running sum crosses. Because neighbours in that order have like
sizes, the words taken stay near the target however uneven the documents are.

All sums are of integers (rates in units of 2^-24), so reruns agree exactly and
a document never gets more than ``max_repeats`` copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import materialize, text_of, word_count

UNIT = 1 << 24
# Documents per block of a source. Blocks are numbered in parallel, so a source
# that holds a third of all rows is spread over as many tasks as it has blocks.
BLOCK_ROWS = 2048


def _key():
    """A source as a string that is never null."""
    return F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """One row per source: documents, words, and its place by code point, null last.

    Places come from range partitions: each is numbered by itself and starts
    where the ones before it end, so no task sees all sources.
    """
    per = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")
    )
    order = F.col("source").asc_nulls_last()
    dealt = per.repartitionByRange(order).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order))
    numbered = dealt.withColumn("inside", inside).join(starts, "part")
    return numbered.withColumn("place", F.col("start") + F.col("inside") - 1).drop(
        "part", "start", "inside"
    )


def source_targets(sources: DataFrame, weights=(1, 2, 3), max_repeats=3) -> DataFrame:
    """Add ``target``: shares of all words by weight, none above its cap.

    Each round is one small aggregation that brings a single row to the driver.
    The level only rises and each round caps at least one more source.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = sources.withColumn(
        "weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * max_repeats)
    weighed = materialize(weighed, "mix-weights")
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > F.col("cap")
        got = weighed.agg(
            F.sum("source_size").alias("total"),
            F.count(F.when(above, 1)).alias("capped"),
            F.sum(F.when(above, F.col("cap"))).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
        ).first()
        if got.capped == capped or not got.open:
            break
        capped, level = got.capped, float((got.total or 0) - (got.held or 0)) / got.open
    share = F.col("weight") * F.lit(level)
    cap = F.col("cap").cast("double")
    return weighed.withColumn("target", F.least(share, cap)).drop("cap")


def mix(
    docs: DataFrame, *, weights=(1, 2, 3), max_repeats=3, seed="mix", block_rows=BLOCK_ROWS
) -> DataFrame:
    """Copies of each document in a mix of all sources.

    Returns ``doc_id, size, source, source_size, target, copies, taken``, one
    row per input row. Null text has size 0; a null source is a source of its
    own; rows of size 0 may get copies but take no words; a table without words
    has target 0 throughout; repeated rows are sampled like any others; other
    columns are ignored.
    """
    sizes = materialize(
        docs.select("doc_id", "source", word_count(text_of()).alias("size")), "mix-sizes"
    )
    targets = source_targets(ranked_sources(sizes), weights, max_repeats)
    rate = F.round(F.col("target") / F.nullif("source_size", F.lit(0)) * UNIT).cast("long")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), _key())), 1, 6), 16, 10)
    targets = materialize(
        targets.select(
            _key().alias("key"),
            "source_size",
            "target",
            F.coalesce(rate, F.lit(0)).alias("rate"),
            offset.cast("long").alias("offset"),
            F.ceil(F.col("n_docs") / block_rows).cast("long").alias("blocks"),
        ),
        "mix-targets",
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    drawn = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long")
    rows = sizes.withColumn("key", _key()).join(targets, "key")
    rows = rows.withColumn("block", drawn % F.col("blocks"))

    counts = rows.groupBy("key", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "key", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    turn = F.when(F.col("block") % 2 == 0, F.col("size")).otherwise(-F.col("size"))
    inside = F.row_number().over(Window.partitionBy("key", "block").orderBy(turn, "doc_id"))
    rows = rows.withColumn("inside", inside).join(starts, ["key", "block"])
    place = F.col("start") + F.col("inside")
    upto = F.shiftright(place * F.col("rate") + F.col("offset"), 24)
    below = F.shiftright((place - 1) * F.col("rate") + F.col("offset"), 24)
    rows = rows.withColumn("copies", upto - below)
    return rows.select(
        "doc_id", "size", "source", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def apply_mix(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """Documents repeated as often as ``copies`` says, with their own columns.

    ``copies`` has one row per row of ``docs``. Rows that share an id (or have
    none) share the copies of that id evenly.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("mix__key")
    total = F.sum("copies").alias("mix__total")
    per_id = copies.groupBy(key).agg(total).where("mix__total > 0")
    same = docs.select("*", key).join(per_id, "mix__key")
    own = Window.partitionBy("mix__key")
    nth = F.row_number().over(own.orderBy("text", "source")) - 1
    times = F.floor((F.col("mix__total") + nth) / F.count(F.lit(1)).over(own))
    many = same.withColumn("mix__times", times.cast("int")).where("mix__times > 0")
    out = many.withColumn("mix__copy", F.explode(F.sequence(F.lit(1), F.col("mix__times"))))
    return out.select(*docs.columns)
