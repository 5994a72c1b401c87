"""Trailing mean speed per road.

One window per distinct (road, millisecond) ``t``: it spans ``[t - length, t]``
and yields one row with the mean of the speeds inside. Passages of one road in
the same millisecond share a window. Both ends are inclusive by default;
``include_start=False`` leaves the early end out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: window length of the deployed job, 30 minutes.
WINDOW_MS = 30 * 60 * 1000


def per_millisecond(passages: DataFrame, key: str = "highway_id") -> DataFrame:
    """Sum and count of speeds per (road, millisecond).

    The aggregation is partial before the shuffle, so however many passages a
    road has, at most 1000 rows per second of event time go on from here.
    """
    # A row without a time belongs to no window.
    return passages.where(F.col("timestamp").isNotNull()).groupBy(
        F.col(key).alias("highway_id"),
        F.unix_millis("timestamp").alias("event_ms"),
    ).agg(F.sum("speed").alias("s"), F.count("speed").alias("c"))


def place_in_blocks(per_ms: DataFrame, window_ms: int, include_start: bool = True) -> DataFrame:
    """Copy every row to the two window-long blocks whose windows can reach it.

    Time is cut into blocks as long as the window. The window that ends at
    ``t`` in block *b* is then exactly a tail of block *b - 1* and a head of
    block *b*. Each row appears once as a head row of its own block and once
    as a tail row of the next one. ``pos`` is where it stands there: its own
    time, or the last ``t`` that still reaches it.
    """
    reach = window_ms if include_start else window_ms - 1
    tail = F.col("tail")
    return per_ms.withColumn("tail", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        *per_ms.columns,
        "tail",
        (F.expr(f"(event_ms - pmod(event_ms, {window_ms}L)) div {window_ms}L") + tail).alias("block"),
        (F.col("event_ms") + tail * F.lit(reach)).alias("pos"),
    )


def _as_rows(mean: Column, end_ms: Column, window_ms: int) -> list[Column]:
    return [
        F.col("highway_id").cast("string").alias("highway_id"),
        mean.alias("avg_speed"),
        F.timestamp_millis(end_ms - window_ms).alias("window_start"),
        F.timestamp_millis(end_ms).alias("window_end"),
    ]


def trailing_mean(
    passages: DataFrame,
    window_ms: int = WINDOW_MS,
    include_start: bool = True,
    closed_only: bool = False,
    key: str = "highway_id",
) -> DataFrame:
    """Trailing mean per road, computed block by block.

    The head of a block is a running sum forwards and the tail of the block
    before it a running sum backwards, both over the partition (road, block):
    one shuffle, two sorts, and work linear in the rows whatever the number of
    rows in a window. Only additions happen, so no precision is lost to
    cancellation. A busy road spreads over as many tasks as it has blocks, and
    a block holds at most ``window_ms`` distinct milliseconds of each kind.

    ``closed_only`` leaves out each road's newest window, which a stream has
    not yet closed.
    """
    is_tail = F.col("tail") == 1
    # Only what the windows need is shuffled; a head row is known by its count.
    per_ms = per_millisecond(passages, key)
    placed = place_in_blocks(per_ms, window_ms, include_start).select(
        "highway_id",
        "block",
        "pos",
        F.when(~is_tail, F.col("s")).alias("head_s"),
        F.when(~is_tail, F.col("c")).alias("head_c"),
        F.when(is_tail, F.col("s")).alias("tail_s"),
        F.when(is_tail, F.col("c")).alias("tail_c"),
    )
    block = Window.partitionBy("highway_id", "block")
    head = block.orderBy(F.col("pos").asc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tail = block.orderBy(F.col("pos").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def both(measure: str) -> Column:
        parts = [F.sum(f"head_{measure}").over(head), F.sum(f"tail_{measure}").over(tail)]
        return F.coalesce(parts[0], F.lit(0)) + F.coalesce(parts[1], F.lit(0))

    summed = placed.select(
        "highway_id", "pos", "head_c", both("s").alias("total"), both("c").alias("count")
    ).where("head_c IS NOT NULL")
    if closed_only:
        # From the same aggregation, and joined on time too: a road is never one task.
        newest = per_ms.groupBy(F.col("highway_id").alias("road")).agg(
            F.max("event_ms").alias("newest_ms")
        )
        still_open = F.col("highway_id").eqNullSafe(F.col("road")) & (F.col("pos") == F.col("newest_ms"))
        summed = summed.join(newest, still_open, "left_anti")
    return summed.select(*_as_rows(F.try_divide("total", "count"), F.col("pos"), window_ms))


def trailing_mean_direct(
    passages: DataFrame, window_ms: int = WINDOW_MS, include_start: bool = True
) -> DataFrame:
    """The definition written as one range frame per road.

    Simple, but one task per road and work proportional to rows times window
    size; kept as the yardstick that :func:`trailing_mean` is tested against.
    """
    first = -window_ms if include_start else 1 - window_ms
    w = Window.partitionBy("highway_id").orderBy("event_ms").rangeBetween(first, 0)
    mean = F.try_divide(F.sum("s").over(w), F.sum("c").over(w))
    return per_millisecond(passages).select(*_as_rows(mean, F.col("event_ms"), window_ms))
