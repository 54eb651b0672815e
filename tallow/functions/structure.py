"""Market structure as a state machine over swings, run in stretches.

A trend is up or down, and weakens before it breaks: a lower high or a lower low weakens an uptrend, and a lower low in a
weakened one breaks it; a downtrend mirrors that. Every swing is a table that maps each state to the next one, and tables
compose. So stretches of a series reduce their swings to one table side by side, the tables of a series' stretches tell
each stretch the state that it starts with, and the stretches then run from there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallow.functions.derived import swing_points
from tallow.operators import halo
from tallow.schema import SERIES

STATES = ("none", "up", "up_weak", "down", "down_weak")
#: The state after each state, in their order, for each kind of swing; others change nothing.
TABLES = {
    "HH": ("up", "up", "up", "down_weak", "up"),
    "LL": ("down", "up_weak", "down", "down", "down"),
    "LH": ("none", "up_weak", "up_weak", "down", "down_weak"),
    "HL": ("none", "up", "up_weak", "down_weak", "down_weak"),
}
BREAKS = {("down_weak", "up"): "up", ("up_weak", "down"): "down"}


def _numbers(states: tuple[str, ...]) -> Column:
    return F.array(*(F.lit(STATES.index(s)) for s in states))


def _table(structure: Column) -> Column:
    return reduce(lambda other, t: F.when(structure == t, _numbers(TABLES[t])).otherwise(other), TABLES, _numbers(STATES))


def _after(table: Column, state: Column) -> Column:
    return F.get(table, state)


def market_structure(candles: DataFrame, reach: int = 2) -> DataFrame:
    """Swings with the trend before and after each; of one candle's swings the high goes first."""
    swings = swing_points(candles, reach)
    swings = swings.withColumn("_stretch", halo.stretch_of(swings, "open_time"))
    swing = F.struct("open_time", "kind", "price", "structure")
    stretches = swings.groupBy(*SERIES, "_stretch").agg(F.array_sort(F.collect_list(swing)).alias("swings"))
    through = F.aggregate("swings", _numbers(STATES), lambda t, s: F.transform(t, lambda state: _after(_table(s["structure"]), state)))
    # a row for each series holds a table for each of its stretches
    ends = stretches.select(*SERIES, "_stretch", through.alias("through")).groupBy(*SERIES).agg(F.array_sort(F.collect_list(F.struct("_stretch", "through"))).alias("all"))
    start = F.struct(F.lit(0).alias("state"), F.array().cast("array<int>").alias("before"))
    run = F.aggregate("all", start, lambda s, e: F.struct(_after(e["through"], s["state"]).alias("state"), F.concat(s["before"], F.array(s["state"])).alias("before")))
    begun = ends.select(*(F.col(c).alias(f"_{c}") for c in SERIES), F.inline(F.arrays_zip(F.col("all._stretch").alias("_number"), run["before"].alias("begins"))))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SERIES))
    placed = stretches.join(begun, same & (F.col("_stretch") == F.col("_number")))
    step = lambda s, e: F.struct(
        _after(_table(e["structure"]), s["state"]).alias("state"), F.concat(s["trends"], F.array(s["state"])).alias("trends")
    )
    trends = F.aggregate("swings", F.struct(F.col("begins").alias("state"), F.array().cast("array<int>").alias("trends")), step)["trends"]
    rows = placed.select(*SERIES, F.inline(F.arrays_zip(F.col("swings").alias("s"), trends.alias("before"))))
    name = lambda state: F.get(F.array(*map(F.lit, STATES)), state)
    return rows.select(*SERIES, "s.open_time", "s.kind", "s.price", "s.structure", name(F.col("before")).alias("trend_before"), name(_after(_table(F.col("s.structure")), F.col("before"))).alias("trend_after"))


def structure_breaks(candles: DataFrame, reach: int = 2) -> DataFrame:
    """The swings that break a trend, with ``direction``, the trend that they begin."""
    direction = reduce(lambda other, b: F.when((F.col("trend_before") == b[0]) & (F.col("trend_after") == b[1]), BREAKS[b]).otherwise(other), BREAKS, F.lit(None).cast("string"))
    return market_structure(candles, reach).withColumn("direction", direction).filter("direction IS NOT NULL")
