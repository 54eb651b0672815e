"""Missing candles: holes between neighbours, and the slots in them.

A hole is found between two neighbouring candles of the grid, so what is read and compared is the candles there are;
slots come out of the holes alone. Neighbours are looked up in stretches of a series, so no task gets a whole one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallow.operators import halo
from tallow.operators.bars import micros_of
from tallow.schema import SERIES, millis_of

#: Slots that one row is expanded to at a time.
SLOTS = 10_000


def series_extent(candles: DataFrame) -> DataFrame:
    """First and last open time and number of rows of each series."""
    return candles.groupBy(*SERIES).agg(F.min("open_time").alias("first_open_time"), F.max("open_time").alias("last_open_time"), F.count(F.lit(1)).alias("candle_count"))


def _later(time: Column, steps: Column, timeframe: str) -> Column:
    return F.timestamp_add("MILLISECOND", steps * millis_of(timeframe), time)


def _slots(ranges: DataFrame, start: str, count: Column, timeframe: str, name: str) -> DataFrame:
    """A row for each of ``count`` slots from ``start`` on, in portions, so that no row holds the slots of a long range."""
    portions = ranges.select(*SERIES, start, count.alias("_n")).filter("_n > 0").withColumn("_portion", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / SLOTS))))
    first = F.col("_portion") * SLOTS
    one = portions.select(*SERIES, start, F.explode(F.sequence(first, F.least(first + SLOTS, F.col("_n")) - 1)).alias("_k"))
    return one.select(*SERIES, _later(F.col(start), F.col("_k"), timeframe).alias(name))


def time_grid(candles: DataFrame, timeframe: str) -> DataFrame:
    """Every open time from a series' first to its last, one interval apart, both ends included.

    The grid starts at the first candle, so a candle off the grid leaves its slot missing.
    """
    extent = series_extent(candles)
    count = F.floor((micros_of(extent, "last_open_time") - micros_of(extent, "first_open_time")) / (1000 * millis_of(timeframe))) + 1
    return _slots(extent, "first_open_time", count, timeframe, "open_time")


def gap_ranges(candles: DataFrame, timeframe: str) -> DataFrame:
    """Holes of each series: rows (series, from_time, to_time, missing_count), the first and the last missing slot.

    The grid starts at the first candle and ends at the last one that fits it or lies behind. Candles of a series that share
    its phase with the first are the grid's; neighbours are looked up for each phase, so the many candles meet no join.
    """
    step = millis_of(timeframe) * 1000
    extent = series_extent(candles).drop("candle_count").withColumnsRenamed({c: f"_{c}" for c in SERIES})
    rows = candles.select(*SERIES, "open_time")
    rows = rows.withColumn("_phase", F.pmod(micros_of(rows, "open_time"), F.lit(step)))
    key = (*SERIES, "_phase")
    ahead = halo.with_halo(rows, after=1, key=key).withColumn("_next", F.lead("open_time").over(halo.within(key)))
    pairs = halo.without_copies(ahead)
    at, following = micros_of(pairs, "open_time"), micros_of(pairs, "_next")
    holes = pairs.filter(F.col("_next").isNull() | (following - at > step))
    # a row for each hole, and one for the last candle of each phase
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SERIES))
    placed = holes.join(extent, same).filter(F.col("_phase") == F.pmod(micros_of(extent, "first_open_time"), F.lit(step)))
    # behind the last candle of the grid its slots go on as far as the series does
    behind = F.floor((micros_of(extent, "last_open_time") - at) / step)
    count = F.when(F.col("_next").isNull(), behind).otherwise(F.floor((following - at) / step) - 1)
    found = placed.withColumn("missing_count", count).filter("missing_count > 0")
    return found.select(*SERIES, _later(F.col("open_time"), F.lit(1), timeframe).alias("from_time"), _later(F.col("open_time"), F.col("missing_count"), timeframe).alias("to_time"), "missing_count")


def find_time_gaps(candles: DataFrame, timeframe: str) -> DataFrame:
    """Rows (series, missing_open_time): the slots of every hole."""
    return _slots(gap_ranges(candles, timeframe), "from_time", F.col("missing_count"), timeframe, "missing_open_time")


def gaps_as_difference(candles: DataFrame, timeframe: str) -> DataFrame:
    """The same as the grid less what is there."""
    return time_grid(candles, timeframe).subtract(candles.select(*SERIES, "open_time")).withColumnRenamed("open_time", "missing_open_time")


def gap_counts(candles: DataFrame, timeframe: str) -> DataFrame:
    """Number of missing candles of each series that misses any."""
    return gap_ranges(candles, timeframe).groupBy(*SERIES).agg(F.sum("missing_count").alias("gap_count"))
