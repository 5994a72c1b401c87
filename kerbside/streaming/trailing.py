"""Trailing mean speed per road over a stream.

Two stateful steps follow each other:

1. ``groupBy(road, millisecond)`` in append mode sums the speeds of each
   millisecond and hands a sum on, once, when the watermark has passed it.
   Its state is spread by (road, millisecond), so a busy road uses all tasks.
   Late rows are dropped and counted here; a row is late when it is not newer
   than the watermark the previous micro-batch ran with.
2. A keyed processor joins the head of a block to the tail of the block before
   it, as :func:`kerbside.operators.trailing.trailing_mean` does. Its key is
   (road, block); a key sees at most ``window_ms`` distinct milliseconds of
   each kind, and its state goes when the watermark passes the block's end.

Step 1 delivers milliseconds up to the watermark and nothing beyond, so when a
head row arrives, all rows its window needs have arrived too and its mean is
final. With a ``watermark_delay`` the windows newer than the watermark stay
open until later data moves it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from kerbside.functions.event_time import truncate_to_ms
from kerbside.operators.trailing import WINDOW_MS, place_in_blocks
from kerbside.session import ROCKSDB_PROVIDER

# The processor travels to the workers by value, so they need no installed copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OUTPUT = "highway_id string, event_ms bigint, s double, c bigint"


Columns = tuple[np.ndarray, np.ndarray, np.ndarray]


def _split(frames: Iterable[pd.DataFrame]) -> tuple[Columns, Columns]:
    """Position, sum and count of the head rows and of the tail rows."""
    parts = [[frame[name].to_numpy() for name in ("tail", "pos", "s", "c")] for frame in frames]
    tail, *columns = [np.concatenate(arrays) for arrays in zip(*parts)]
    is_tail = tail == 1
    return tuple(a[~is_tail] for a in columns), tuple(a[is_tail] for a in columns)


def _in_order(columns: Columns) -> Columns:
    order = np.argsort(columns[0], kind="stable")
    return tuple(column[order] for column in columns)


class HeadAndTail(StatefulProcessor):
    """State of one (road, block): what earlier batches brought, as a list.

    An entry holds either tail rows or the total of one batch's head rows.
    Entries are only ever appended, so a batch costs one read and short writes.
    """

    def __init__(self, window_ms: int):
        self.window_ms = window_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.parts = handle.getListState(
            "parts", "tail boolean, pos array<bigint>, s array<double>, c array<bigint>"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        road, block = key
        block_end = (block + 1) * self.window_ms
        own, arrived = _split(rows)
        if len(own[0]):
            yield self._means(road, own, arrived)
        # Milliseconds up to the watermark have all been delivered.
        if timerValues.getCurrentWatermarkInMs() < block_end - 1:
            if len(arrived[0]):
                self.parts.appendValue((True, *(column.tolist() for column in arrived)))
            if len(own[0]):
                _, s, c = own
                self.parts.appendValue((False, [block_end], [float(s.sum())], [int(c.sum())]))
            self.handle.registerTimer(block_end)

    def _means(self, road: str, own: Columns, arrived: Columns) -> pd.DataFrame:
        """Sum and count of the window of each own row.

        The head is a prefix sum over time, the tail a sum from its end back to
        the first row that is still inside the window.
        """
        before_s, before_c, tails = 0.0, 0, [arrived]
        for is_tail, pos, s, c in self.parts.get():
            if is_tail:
                tails.append((np.array(pos, np.int64), np.array(s, float), np.array(c, np.int64)))
            else:
                before_s, before_c = before_s + s[0], before_c + c[0]
        pos, s, c = _in_order([np.concatenate(columns) for columns in zip(*tails)])
        tail_s = np.append(np.cumsum(s[::-1])[::-1], 0.0)
        tail_c = np.append(np.cumsum(c[::-1])[::-1], 0)
        own_pos, own_s, own_c = _in_order(own)
        first = np.searchsorted(pos, own_pos, side="left")
        return pd.DataFrame(
            {
                "highway_id": road,
                "event_ms": own_pos,
                "s": before_s + np.cumsum(own_s) + tail_s[first],
                "c": before_c + np.cumsum(own_c) + tail_c[first],
            }
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.parts.clear()
        return iter([])

    def close(self) -> None:
        pass


def trailing_mean_stream(
    passages: DataFrame,
    window_ms: int = WINDOW_MS,
    include_start: bool = True,
    *,
    watermark_delay: str,
    key: str = "highway_id",
) -> DataFrame:
    """Streaming form of the trailing mean, in append mode.

    The watermark is one for all roads: give a ``watermark_delay`` at least as
    long as roads, or files read together, may run ahead of each other.
    """
    passages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    per_ms = (
        passages.select(
            F.col(key).cast("string").alias("highway_id"),
            truncate_to_ms(F.col("timestamp")).alias("event_time"),
            "speed",
        )
        .withWatermark("event_time", watermark_delay)
        .groupBy("highway_id", "event_time")
        .agg(F.coalesce(F.sum("speed"), F.lit(0.0)).alias("s"), F.count("speed").alias("c"))
        .withColumn("event_ms", F.unix_millis("event_time"))
    )
    means = (
        place_in_blocks(per_ms, window_ms, include_start)
        .select("highway_id", "block", "tail", "pos", "s", "c")
        .groupBy("highway_id", "block")
        .transformWithStateInPandas(
            HeadAndTail(window_ms),
            outputStructType=_OUTPUT,
            outputMode="append",
            timeMode="eventtime",
        )
    )
    return means.select(
        "highway_id",
        F.try_divide("s", "c").alias("avg_speed"),
        F.timestamp_millis(F.col("event_ms") - window_ms).alias("window_start"),
        F.timestamp_millis("event_ms").alias("window_end"),
    )
