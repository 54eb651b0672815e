"""Alerts for series that fall silent: no candle within a time after the last one, by event time.

Every candle waits for the next one until its due time, which is a number of time frames behind its open time. The
watermark decides: a late candle that arrives before the watermark has passed the due time cancels the alert. The
state of a series is the open times that still wait, so its size is bounded by the watermark's delay.

The streaming form needs the state store that holds timers: set ``spark.sql.streaming.stateStore.providerClass`` to
``org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider``.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallow.operators import halo
from tallow.schema import SERIES, millis_of
from tallow.shipping import ship

ALERTS = "exchange string, symbol string, timeframe string, last_open_time timestamp, due_time timestamp"


class LastSeen(StatefulProcessor):
    """Alerts of one series; a timer for each candle."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "open_ms long", "due_ms long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for open_ms in frame["open_ms"].astype("int64").tolist():
                if not self.waiting.containsKey((open_ms,)):
                    self.waiting.updateValue((open_ms,), (open_ms + self.patience_ms,))
                    self.handle.registerTimer(open_ms + self.patience_ms)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        open_ms = due - self.patience_ms
        followed = any(open_ms < other <= due for (other,) in self.waiting.keys())
        self.waiting.removeKey((open_ms,))
        if not followed:
            at = lambda ms: datetime.fromtimestamp(ms / 1000, UTC)
            yield pd.DataFrame([(*key, at(open_ms), at(due))], columns=[*SERIES, "last_open_time", "due_time"])

    def close(self) -> None:
        pass


def silent_series(candles: DataFrame, timeframe: str, patience: int = 1, lateness: str = "1 hour") -> DataFrame:
    """Alerts of a stream of candles: series, last_open_time and the due_time by which no other had come.

    ``patience`` is in time frames, ``lateness`` the watermark's delay.
    """
    ship(candles.sparkSession)
    times = candles.select(*SERIES, F.col("open_time").cast("timestamp").alias("open_time")).withWatermark("open_time", lateness)
    keyed = times.withColumn("open_ms", F.unix_millis("open_time"))
    processor = LastSeen(patience * millis_of(timeframe))
    return keyed.groupBy(*SERIES).transformWithStateInPandas(statefulProcessor=processor, outputStructType=ALERTS, outputMode="Append", timeMode="EventTime")


def silent_ranges(candles: DataFrame, timeframe: str, patience: int = 1) -> DataFrame:
    """The same of a table, as if the watermark had reached its last open time: rows (series, last_open_time, due_time)."""
    due = F.timestamp_add("MILLISECOND", F.lit(patience * millis_of(timeframe)), F.col("open_time"))
    rows = halo.with_halo(candles.select(*SERIES, "open_time").distinct(), after=1)
    ahead = halo.without_copies(rows.withColumn("_next", F.lead("open_time").over(halo.within()))).withColumn("due_time", due)
    end = candles.agg(F.max("open_time").alias("_end"))
    # one row, so every side of it is small
    silent = ahead.join(F.broadcast(end), F.coalesce(F.col("_next"), F.col("_end")) > F.col("due_time"))
    return silent.select(*SERIES, F.col("open_time").alias("last_open_time"), "due_time")
