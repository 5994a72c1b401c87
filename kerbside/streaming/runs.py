"""Starting streaming queries that write the output tables."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from kerbside.operators.quality import split_bad_times, traffic_detailed
from kerbside.sources.tables import (
    AVERAGES_TABLE,
    DETAIL_TABLE,
    QUARANTINE_TABLE,
    batch_writer,
)
from kerbside.streaming.trailing import trailing_mean_stream

Sink = Callable[[DataFrame, int], None]
TABLES = (DETAIL_TABLE, AVERAGES_TABLE, QUARANTINE_TABLE)
DAY_OF = {DETAIL_TABLE: "timestamp", AVERAGES_TABLE: "window_end"}


def _start(
    df: DataFrame, sink: Sink, checkpoint: str, interval: str | None
) -> StreamingQuery:
    _LATE.listen(df.sparkSession)
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(sink)
    if interval is not None:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def write_stream(
    df: DataFrame, path: str, checkpoint: str, interval: str | None = None, sink: Sink | None = None
) -> StreamingQuery:
    """Write a stream to the table at ``path`` (or to ``sink``), batch by batch.

    With ``interval`` the query runs on; without it it takes what is there and
    stops. Progress is kept in ``checkpoint``, which must be a shared folder.
    """
    return _start(df, sink or batch_writer(path), checkpoint, interval)


def start_outputs(
    decoded: DataFrame,
    tables: str,
    checkpoints: str,
    *,
    watermark_delay: str,
    interval: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    sinks: dict[str, Sink] | None = None,
) -> list[StreamingQuery]:
    """Fork one decoded record stream to the detail, averages and quarantine tables.

    Two queries with their own progress: the stateless one writes each batch's
    usable and quarantined rows, the stateful one the means per record key.
    ``transform`` is applied to the usable rows before both tables; columns that it
    adds go to the detail table too. Detail rows and means lie by day. A table goes
    to its folder under ``tables``, or to its own function in ``sinks``, such as
    :func:`kerbside.sources.tables.jdbc_batch_writer`; a batch may reach it twice.
    """
    unknown = set(sinks or {}) - set(TABLES)
    if unknown:
        raise ValueError(f"no such tables: {sorted(unknown)}")
    alter = transform or (lambda rows: rows)
    sink = {
        name: batch_writer(f"{tables}/{name}", day_of=DAY_OF.get(name)) for name in TABLES
    } | (sinks or {})

    def write_rows(df: DataFrame, batch_id: int) -> None:
        batch = df.persist()
        try:
            good, bad = split_bad_times(batch)
            rows = alter(good)
            added = [name for name in rows.columns if name not in good.columns]
            sink[DETAIL_TABLE](traffic_detailed(rows, *added), batch_id)
            sink[QUARANTINE_TABLE](bad, batch_id)
        finally:
            batch.unpersist()

    means = trailing_mean_stream(
        alter(split_bad_times(decoded)[0]), watermark_delay=watermark_delay, key="road"
    )
    streams = {
        DETAIL_TABLE: (decoded, write_rows),
        AVERAGES_TABLE: (means, sink[AVERAGES_TABLE]),
    }
    return [
        _start(df, write, f"{checkpoints}/{name}", interval)
        for name, (df, write) in streams.items()
    ]


def finish(queries: list[StreamingQuery], allow_late: bool = True) -> int:
    """Wait for queries that stop by themselves; the first failure is raised.

    Returns how many rows came after the watermark and were dropped in all their
    batches; with ``allow_late=False`` any is an error. Counted are queries that this
    module starts; of others their recent progress.
    """
    for query in queries:
        query.awaitTermination()
    late = sum(_LATE.total(query) for query in queries)
    if late and not allow_late:
        raise ValueError(f"{late} rows came after the watermark")
    return late


def _dropped(progress: StreamingQueryProgress) -> int:
    return sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)


class _LateRows(StreamingQueryListener):
    """Rows dropped by the watermark, added up over every batch of every query."""

    def __init__(self) -> None:
        self.changed = threading.Condition()
        self.counts: dict[str, int] = {}
        self.ended: set[str] = set()
        self.sessions: list[SparkSession] = []

    def listen(self, spark: SparkSession) -> None:
        if not any(known is spark for known in self.sessions):
            spark.streams.addListener(self)
            self.sessions.append(spark)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        with self.changed:
            self.counts[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self.changed:
            run = str(event.progress.runId)
            self.counts[run] = self.counts.get(run, 0) + _dropped(event.progress)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def total(self, query: StreamingQuery, wait_s: float = 30) -> int:
        """The count of an ended query; its last events may still be on their way."""
        run = str(query.runId)
        with self.changed:
            if run not in self.counts:
                return sum(
                    operator["numRowsDroppedByWatermark"]
                    for progress in query.recentProgress
                    for operator in progress["stateOperators"]
                )
            if not self.changed.wait_for(lambda: run in self.ended, wait_s):
                raise TimeoutError("the end of the query was not reported")
            return self.counts[run]


_LATE = _LateRows()
