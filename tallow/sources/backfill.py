"""Filling of holes: what is missing becomes requests, requests become candles, candles go into the lake.

The lake's own candles say what is missing. Holes are cut at the pages of the series' timeline, and holes of one page
share a request, so the requests are never more than the pages that miss something, however many single candles do.
Tasks fetch them, and the lake's upsert stages what came, so nothing is fetched twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallow.operators.bars import micros_of
from tallow.operators.dedupe import keep_last
from tallow.operators.gaps import gap_ranges, series_extent
from tallow.schema import CANDLES, SERIES, millis_of
from tallow.shipping import ship
from tallow.sources import feed, lake


def missing_ranges(candles: DataFrame, timeframe: str, until_ms: int | None = None) -> DataFrame:
    """Rows (series, start_ms, end_ms): holes of each series, and with ``until_ms`` also what closed by then behind its last candle."""
    step = millis_of(timeframe)
    millis = lambda df, time: F.floor(micros_of(df, time) / 1000)
    holes = gap_ranges(candles, timeframe)
    ranges = holes.select(*SERIES, millis(holes, "from_time").alias("start_ms"), millis(holes, "to_time").alias("end_ms"))
    if until_ms is None:
        return ranges
    extent = series_extent(candles)
    first, last = millis(extent, "first_open_time"), millis(extent, "last_open_time")
    slot = lambda ms: F.floor((ms - first) / step)
    # an open time t is closed at until_ms if t + step <= until_ms
    tail = extent.select(*SERIES, (first + (slot(last) + 1) * step).alias("start_ms"), (first + slot(F.lit(until_ms) - step) * step).alias("end_ms"))
    return ranges.unionByName(tail.filter("start_ms <= end_ms"))


def requests(ranges: DataFrame, timeframe: str, limit: int = feed.PAGE) -> DataFrame:
    """Rows (series, start_ms, end_ms, slots) to ask for: at most one for each page of ``limit`` slots of a series."""
    page = limit * millis_of(timeframe)
    split = ranges.withColumn("page", F.explode(F.sequence(F.floor(F.col("start_ms") / page), F.floor(F.col("end_ms") / page))))
    # the first and last open time of the page in the phase of the series' grid
    phase = F.pmod("start_ms", F.lit(millis_of(timeframe)))
    pieces = split.withColumns(
        {"start_ms": F.greatest("start_ms", F.col("page") * page + phase), "end_ms": F.least("end_ms", (F.col("page") + 1) * page - millis_of(timeframe) + phase)}
    ).filter("start_ms <= end_ms")
    slots = F.floor((F.col("end_ms") - F.col("start_ms")) / millis_of(timeframe)) + 1
    return pieces.groupBy(*SERIES, "page").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.sum(slots).alias("slots")).drop("page")


def fetch(asked: DataFrame, width: int = 64, config: dict[str, Any] | None = None, **options: Any) -> DataFrame:
    """Candles of the requests, in ``width`` tasks at a time; options as for the feed, symbols and times come from the requests."""
    given = {k: str(v) for k, v in (feed.configured("candles", config) | options).items()}
    ship(asked.sparkSession)

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                o = feed._Options(given | {"symbol": r.symbol, "interval": r.timeframe})
                now = datetime.now(UTC)
                rows = o.client().scan(r.symbol, r.timeframe, int(r.start_ms), int(r.end_ms), o.limit)
                yield pd.DataFrame([feed.typed_row(row, r.symbol, r.timeframe, r.exchange, now) for row in rows], columns=CANDLES.fieldNames())

    return asked.repartition(width, *SERIES, "start_ms").mapInPandas(ask, CANDLES)


def fill(spark: SparkSession, timeframe: str, root: str | None = None, until_ms: int | None = None, width: int = 64, config: dict[str, Any] | None = None, **options: Any) -> DataFrame:
    """Asks the feed for what the lake's series of a time frame miss, and upserts the answers; returns the partitions written.

    A second call asks for nothing that the first one filled. Slots that the feed doesn't have stay missing and are asked for again.
    """
    candles = lake.read_candles(spark, root).filter(F.col("timeframe") == timeframe)
    limit = int(options.get("limit") or feed.configured("candles", config).get("limit", feed.PAGE))
    asked = requests(missing_ranges(candles, timeframe, until_ms), timeframe, limit)
    return lake.upsert_candles(keep_last(fetch(asked, width, config, **options)), root, allow_empty=True)
