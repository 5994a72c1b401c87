"""Trailing means by one clock per road, with late rows kept and their windows repaired.

A watermark is one time for all roads: a road that runs ahead makes the rows of
others late, and late rows are dropped. Here each road has a clock of its own,
the newest time it has shown, less a delay. A window is final once its road's
clock has passed it. A road that shows nothing while others go on is moved along
after ``silent_after``, so its last windows are not held open for ever.

Each micro-batch

1. marks the rows that lie behind their road's clock as late, and adds all rows
   to the passages and the late ones to a table of their own;
2. moves the clocks on; ends of windows that they have not passed yet are kept
   as pending;
3. computes the windows that became final, and again those that a late row
   reaches, from the passages of just their (road, block) pairs;
4. adds these means under a new revision; the newest revision of a window counts.

Everything lies in snapshot tables, each batch under its number, so a batch that
is replayed after a failure changes nothing. No state is kept in executors and a
busy road is never one task: the shuffles are those of the batch form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.operators.log_counts import step_us
from kerbside.operators.trailing import WINDOW_MS, trailing_mean
from kerbside.schema import AVERAGES
from kerbside.sources import snapshots
from kerbside.sources.tables import run_of

PASSAGES, LATE, CLOCKS, PENDING, MEANS = "passages", "late", "clocks", "pending", "averages"
HOUR_MS = 3_600_000
_CLOCKS = "road string, newest_ms long, closed_before long, closed_ms long"
_PENDING = "road string, event_ms long"
# A time before all others, for roads without a clock.
_NEVER = -(1 << 62)


def _held(spark: SparkSession, path: str, run: str, batch: int, schema: str) -> DataFrame:
    """What a batch left in a table that every batch replaces; nothing before the first."""
    snapshot = snapshots.latest(spark, path)
    part = snapshot.batch(run, batch)
    if part is None:
        return spark.createDataFrame([], schema)
    return snapshots.read(spark, path, snapshot, parts=[part])


def _replace(df: DataFrame, path: str, run: str, batch: int) -> DataFrame:
    """Store a batch's version of a table and read it again; the one before stays for a replay."""
    snapshots.append_batch(df, path, batch, run=run)
    snapshot = snapshots.keep_batches(df.sparkSession, path, run, batch - 1)
    return snapshots.read(df.sparkSession, path, snapshot, parts=[snapshot.batch(run, batch)])


def _one_run(spark: SparkSession, path: str, run: str) -> None:
    snapshot = snapshots.latest(spark, path)
    runs = {p["run"] for p in snapshot.parts if p["run"]} | set(snapshot.merged)
    if runs - {run}:
        raise ValueError(f"{path} belongs to a query with another checkpoint")


def _block(ms: Column, window_ms: int) -> Column:
    return F.floor(ms / F.lit(window_ms)).cast("long")


def moved_clocks(clocks: DataFrame, rows: DataFrame, delay_ms: int, silent_ms: int | None) -> DataFrame:
    """Each road's clock after a batch: ``closed_before`` it, and ``closed_ms`` now."""
    held = clocks.select("road", F.col("newest_ms").alias("held_ms"), F.col("closed_ms").alias("closed_before"))
    newest = rows.groupBy("road").agg(F.max("event_ms").alias("batch_ms"))
    both = held.join(newest, "road", "full")
    both = both.select("road", F.greatest("held_ms", "batch_ms").alias("newest_ms"), "closed_before")
    front = both.agg(F.max("newest_ms")).first()[0]
    marks = [F.col("closed_before"), F.col("newest_ms") - delay_ms]
    if silent_ms is not None and front is not None:
        marks.append(F.lit(front - silent_ms))
    return both.withColumn("closed_ms", F.greatest(*marks).cast("long"))


def _history(spark: SparkSession, root: str, touched: DataFrame, window_ms: int) -> DataFrame:
    """Passages of the touched (road, block) pairs and of the blocks before them."""
    before = F.explode(F.array(F.col("block"), F.col("block") - 1)).alias("block")
    needed = touched.select("road", before).distinct()
    ends = (F.col("block") * window_ms, (F.col("block") + 1) * window_ms - 1)
    hour = F.explode(F.sequence(*[F.floor(e / F.lit(HOUR_MS)).cast("long") for e in ends])).alias("hour")
    stamp = F.timestamp_millis(F.col("hour") * HOUR_MS)
    # One value per hour that the batch touches.
    slots = needed.select(hour).distinct().select(F.date_format(stamp, snapshots.SLOT_FORMS["hour"]))
    names = [row[0] for row in slots.collect()]
    rows = snapshots.read(spark, f"{root}/{PASSAGES}").where(F.col(snapshots.SLOT).isin(names))
    rows = rows.select("road", "timestamp", "speed")
    rows = rows.withColumn("block", _block(F.unix_millis("timestamp"), window_ms))
    return rows.join(needed, ["road", "block"], "left_semi")


def latest_means(rows: DataFrame) -> DataFrame:
    """The newest revision of each window."""
    newest = F.max_by(F.struct("avg_speed", "window_start", "revision"), "revision").alias("m")
    kept = rows.groupBy("highway_id", "window_end").agg(newest)
    return kept.select("highway_id", "m.avg_speed", "m.window_start", "window_end", "m.revision")


def clocked_writer(
    root: str,
    *,
    delay_ms: int = 0,
    silent_ms: int | None = None,
    window_ms: int = WINDOW_MS,
    include_start: bool = True,
    key: str = "highway_id",
    fan_in: int = snapshots.FAN_IN,
):
    """A ``foreachBatch`` function for passages; see the module's text."""

    def write(df: DataFrame, batch_id: int) -> None:
        spark, run = df.sparkSession, run_of(df)
        _one_run(spark, f"{root}/{CLOCKS}", run)
        road, ms = F.col(key).cast("string"), F.unix_millis("timestamp")
        usable = df.where(road.isNotNull() & F.col("timestamp").isNotNull())
        rows = usable.withColumns({"road": road, "event_ms": ms}).persist()
        try:
            held = _held(spark, f"{root}/{CLOCKS}", run, batch_id - 1, _CLOCKS)
            clocks = moved_clocks(held, rows, delay_ms, silent_ms)
            clocks = _replace(clocks, f"{root}/{CLOCKS}", run, batch_id).drop("newest_ms")
            late = F.col("event_ms") <= F.coalesce("closed_before", F.lit(_NEVER))
            marked = rows.join(clocks, "road").withColumn("late", late)
            split = (snapshots.SLOT,)
            stored = rows.drop("event_ms").withColumn(snapshots.SLOT, snapshots.slot_of("timestamp", "hour"))
            snapshots.append_batch(stored, f"{root}/{PASSAGES}", batch_id, run=run, split=split)
            behind = marked.where("late").select(*df.columns, F.lit(batch_id).alias("batch"))
            snapshots.append_batch(behind, f"{root}/{LATE}", batch_id, run=run)

            pending = _held(spark, f"{root}/{PENDING}", run, batch_id - 1, _PENDING)
            ends = pending.unionByName(marked.where("not late").select("road", "event_ms"))
            ends = ends.distinct().join(clocks, "road")
            open_ones = ends.where("event_ms > closed_ms").select("road", "event_ms")
            _replace(open_ones, f"{root}/{PENDING}", run, batch_id)

            block = _block(F.col("event_ms"), window_ms)
            closing = ends.where("event_ms <= closed_ms").select(
                "road", block.alias("block"), F.lit(False).alias("repair")
            )
            reached = marked.where("late").select(
                "road", F.explode(F.array(block, block + 1)).alias("block"), F.lit(True).alias("repair")
            )
            touched = closing.unionByName(reached).groupBy("road", "block")
            touched = touched.agg(F.max("repair").alias("repair")).persist()
            try:
                if not touched.isEmpty():
                    _add_means(touched, clocks, batch_id, run)
            finally:
                touched.unpersist()
        finally:
            rows.unpersist()
        snapshots.compact(spark, f"{root}/{PASSAGES}", fan_in=fan_in)
        snapshots.compact(spark, f"{root}/{LATE}", fan_in=fan_in)
        snapshots.compact(spark, f"{root}/{MEANS}", fold=latest_means, fan_in=fan_in)

    def _add_means(touched: DataFrame, clocks: DataFrame, batch_id: int, run: str) -> None:
        spark = touched.sparkSession
        path = f"{root}/{MEANS}"
        history = _history(spark, root, touched, window_ms)
        means = trailing_mean(history, window_ms, include_start, key="road")
        means = means.withColumns({"road": F.col("highway_id"), "end_ms": F.unix_millis("window_end")})
        means = means.withColumn("block", _block(F.col("end_ms"), window_ms))
        means = means.join(touched, ["road", "block"]).join(clocks, "road")
        new = F.col("end_ms") > F.coalesce("closed_before", F.lit(_NEVER))
        means = means.where((F.col("end_ms") <= F.col("closed_ms")) & (new | F.col("repair")))
        revision = F.lit(snapshots.latest(spark, path).version + 1).cast("long").alias("revision")
        snapshots.append_batch(means.select(*AVERAGES.names, revision), path, batch_id, run=run)

    return write


def start_clocked(
    passages: DataFrame,
    root: str,
    checkpoint: str,
    *,
    delay: str = "0 seconds",
    silent_after: str | None = None,
    interval: str | None = None,
    **options,
) -> StreamingQuery:
    """Keep passages, late rows and trailing means under ``root`` up with a stream.

    ``delay`` is how far a road's rows may be out of order without being late,
    ``silent_after`` how far others may be ahead before a road is moved along; by
    default it waits for ever. With ``interval`` the query runs on. Rows without a road
    or a time are left out. A root belongs to one checkpoint. ``options`` are those of
    :func:`clocked_writer`.
    """
    spark = passages.sparkSession
    options["delay_ms"] = step_us(spark, delay) // 1000
    options["silent_ms"] = None if silent_after is None else step_us(spark, silent_after) // 1000
    writer = passages.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(clocked_writer(root, **options))
    if interval is not None:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def read_means(spark: SparkSession, root: str) -> DataFrame:
    """The final means, each window as its newest revision has it."""
    return latest_means(snapshots.read(spark, f"{root}/{MEANS}")).select(*AVERAGES.names)


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """The rows that came behind their road's clock, with the ``batch`` that brought them."""
    return snapshots.read(spark, f"{root}/{LATE}")
