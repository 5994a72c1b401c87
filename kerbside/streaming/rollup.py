"""A roll-up of log counts that a stream keeps up, at several bucket lengths.

Each micro-batch adds its own counts per (bucket, service, level) as a delta;
the count of a bucket is the sum of its deltas. So no raw row is read twice,
rows that come late are one more delta, and there is no watermark and no state. A
replayed batch replaces its delta, and all lengths of one batch are listed at once.
Deltas are added up by compaction, which keeps their number small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.operators.log_counts import build_rollup, step_us
from kerbside.sources import snapshots
from kerbside.sources.tables import run_of

# Bucket lengths, each dividing the next.
STEPS = ("1 minute", "1 hour", "1 day")
KEYS = ["step", "bucket", "service", "level"]


def rollup_delta(logs: DataFrame, steps: tuple[str, ...] = STEPS) -> DataFrame:
    """Counts of a table of log rows per (step, bucket, service, level).

    Raw rows are counted once, for the shortest step; the others add up its counts.
    """
    lengths = [step_us(logs.sparkSession, step) for step in steps]
    if any(long % short for short, long in zip(lengths, lengths[1:])):
        raise ValueError(f"each of {steps} must divide the next")
    finest = build_rollup(logs, steps[0])
    # Every bucket names its own ends, so one pass makes all steps.
    start = F.unix_micros("bucket")
    places = F.array(*[
        F.struct(F.lit(step).alias("step"), F.timestamp_micros(start - F.pmod(start, F.lit(us))).alias("bucket"))
        for step, us in zip(steps, lengths)
    ])
    each = finest.select(F.explode(places).alias("at"), "service", "level", "count")
    return each.groupBy("at.step", "at.bucket", "service", "level").agg(F.sum("count").alias("count"))


def add_up(deltas: DataFrame) -> DataFrame:
    """The deltas of each bucket as one row."""
    summed = deltas.groupBy(*KEYS).agg(F.sum("count").alias("count"))
    return summed.withColumn(snapshots.SLOT, snapshots.slot_of("bucket"))


def rollup_writer(path: str, steps: tuple[str, ...] = STEPS, fan_in: int = snapshots.FAN_IN):
    """A ``foreachBatch`` function that adds the counts of log rows to the roll-up at ``path``."""

    def write(df: DataFrame, batch_id: int) -> None:
        delta = rollup_delta(df, steps).withColumn(snapshots.SLOT, snapshots.slot_of("bucket"))
        split = ("step", snapshots.SLOT)
        snapshots.append_batch(delta, path, batch_id, run=run_of(df), split=split)
        snapshots.compact(df.sparkSession, path, fold=add_up, fan_in=fan_in)

    return write


def maintain_rollup(
    logs: DataFrame,
    path: str,
    checkpoint: str,
    steps: tuple[str, ...] = STEPS,
    *,
    interval: str | None = None,
    fan_in: int = snapshots.FAN_IN,
) -> StreamingQuery:
    """Keep the roll-up at ``path`` up with a stream of log rows.

    With ``interval`` the query runs on; without it it takes what is there and stops.
    Rows without a time are not counted.
    """
    writer = logs.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(rollup_writer(path, steps, fan_in))
    if interval is not None:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def read_rollup(spark: SparkSession, path: str, snapshot: snapshots.Snapshot | None = None) -> DataFrame:
    """``step, bucket, service, level, count`` of every bucket."""
    return add_up(snapshots.read(spark, path, snapshot)).drop(snapshots.SLOT)
