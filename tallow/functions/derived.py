"""Datasets derived from candles and trades, by standard public definitions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallow.operators import halo
from tallow.schema import SERIES


#: Candles of a stretch of recursive smoothing; powers of its weights stay within a double.
SMOOTHED = 512


def _log_returns(candles: DataFrame, back: int) -> DataFrame:
    """Simple and log returns by stretches, with what windows of ``back`` more rows need."""
    rows = halo.with_halo(candles.select(*SERIES, "open_time", "close"), 1 + back)
    ratio = F.col("close") / F.nullif(F.lag("close").over(halo.within()), F.lit(0.0))
    return rows.withColumns({"simple_return": ratio - 1, "log_return": F.ln(F.nullif(ratio, F.lit(0.0)))})


def price_returns(candles: DataFrame) -> DataFrame:
    """Simple and log return on the previous close; null for the first candle and where a price is zero."""
    return halo.without_copies(_log_returns(candles, 0)).select(*SERIES, "open_time", "simple_return", "log_return")


def price_range_atr(candles: DataFrame, length: int = 14) -> DataFrame:
    """High less low, true range, and its mean over the last ``length`` candles."""
    rows = halo.with_halo(candles.select(*SERIES, "open_time", "high", "low", "close"), length)
    last = F.lag("close").over(halo.within())
    # greatest skips nulls, so the first candle's true range is its own range
    true_range = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - last), F.abs(F.col("low") - last))
    ranges = rows.withColumns({"price_range": F.col("high") - F.col("low"), "true_range": true_range})
    mean = ranges.withColumn("atr", F.avg("true_range").over(halo.within().rowsBetween(1 - length, 0)))
    return halo.without_copies(mean).select(*SERIES, "open_time", "price_range", "true_range", "atr")


def price_volatility(candles: DataFrame, length: int = 24) -> DataFrame:
    """Standard deviation of log returns over the last ``length`` candles."""
    rolling = halo.within().rowsBetween(1 - length, 0)
    deviation = _log_returns(candles, length - 1).withColumn("rolling_volatility", F.stddev_samp("log_return").over(rolling))
    return halo.without_copies(deviation).select(*SERIES, "open_time", "rolling_volatility")


def realized_volatility(candles: DataFrame) -> DataFrame:
    """Root of the sum of squared log returns of each day."""
    day = F.to_date("open_time").alias("day")
    return price_returns(candles).groupBy(*SERIES, day).agg(F.sqrt(F.sum(F.col("log_return") * F.col("log_return"))).alias("realized_volatility"))


def swing_points(candles: DataFrame, reach: int = 2) -> DataFrame:
    """Highs above, or lows below, ``reach`` candles on either side, and how each compares with the swing before it."""
    rows = halo.with_halo(candles.select(*SERIES, "open_time", "high", "low"), reach, reach)
    beside = [*range(-reach, 0), *range(1, reach + 1)]
    around = lambda c: [F.lag(c, k).over(halo.within()) for k in beside]
    higher, lower = F.lit(True), F.lit(True)
    for h, low in zip(around("high"), around("low"), strict=True):
        higher, lower = higher & (F.col("high") > h), lower & (F.col("low") < low)
    marked = halo.without_copies(rows.withColumns({"is_high": higher, "is_low": lower}))
    kinds = F.array(
        F.struct(F.lit("high").alias("kind"), F.col("high").alias("price"), F.col("is_high").alias("holds")),
        F.struct(F.lit("low").alias("kind"), F.col("low").alias("price"), F.col("is_low").alias("holds")),
    )
    swings = marked.select(*SERIES, "open_time", F.inline(kinds)).filter("holds").drop("holds")
    key = (*SERIES, "kind")
    swings = halo.with_halo(swings, 1, key=key)
    before = F.lag("price").over(halo.within(key))
    up, same = F.when(F.col("kind") == "high", "HH").otherwise("HL"), F.lit("EQ")
    down = F.when(F.col("kind") == "high", "LH").otherwise("LL")
    structure = F.when(F.col("price") > before, up).when(F.col("price") < before, down).when(before.isNotNull(), same)
    return halo.without_copies(swings.withColumn("structure", structure))


def volume_profile(trades: DataFrame, bin_size: float, share: float = 0.7) -> DataFrame:
    """Traded quantity at each price bin of a market; the bin with the most (point of control, the lowest where several tie),
    and the value area: the largest bins that together hold ``share`` of the quantity."""
    price_bin = (F.floor(F.col("price") / bin_size) * bin_size).cast("double").alias("price_bin")
    bins = trades.groupBy("exchange", "symbol", price_bin).agg(F.sum("quantity").alias("volume"))
    ranked = Window.partitionBy("exchange", "symbol").orderBy(F.desc("volume"), "price_bin")
    before = F.coalesce(F.sum("volume").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    total = F.sum("volume").over(Window.partitionBy("exchange", "symbol"))
    return bins.withColumns({"is_poc": F.row_number().over(ranked) == 1, "in_value_area": before < share * total})


def value_area(trades: DataFrame, bin_size: float, share: float = 0.7) -> DataFrame:
    """The contiguous price range of each market that holds ``share`` of the quantity: poc, value_low, value_high (bins), volume, share.

    It grows from the point of control (the lowest of several) by the larger of the two neighbouring bins, the lower one
    where they tie, until it holds the share. Bins without a trade are skipped. A market's bins are one row, not its trades.
    """
    price_bin = (F.floor(F.col("price") / bin_size) * bin_size).cast("double").alias("price_bin")
    bins = trades.groupBy("exchange", "symbol", price_bin).agg(F.sum("quantity").alias("volume"))
    markets = bins.groupBy("exchange", "symbol").agg(F.array_sort(F.collect_list(F.struct("price_bin", "volume"))).alias("bins"), F.sum("volume").alias("total"))
    markets = markets.select("exchange", "symbol", "total", F.col("bins.price_bin").alias("prices"), F.col("bins.volume").alias("volumes"))
    most = F.array_max("volumes")
    state = lambda low, high, held: F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"), held.alias("held"))
    beside = lambda place: F.coalesce(F.get("volumes", place.cast("int")), F.lit(-1.0))

    def grow(s, _):
        below, above = beside(s["low"] - 1), beside(s["high"] + 1)
        wider = F.when(below >= above, state(s["low"] - 1, s["high"], s["held"] + below)).otherwise(state(s["low"], s["high"] + 1, s["held"] + above))
        return F.when((s["held"] >= share * F.col("total")) | ((below < 0) & (above < 0)), s).otherwise(wider)

    poc = F.array_position("volumes", most) - 1
    grown = markets.withColumn("area", F.aggregate("volumes", state(poc, poc, most), grow))
    at = lambda place: F.get("prices", place.cast("int"))
    return grown.select(
        "exchange", "symbol", at(poc).alias("poc"), at(F.col("area.low")).alias("value_low"), at(F.col("area.high")).alias("value_high"), F.col("area.held").alias("volume"), F.try_divide("area.held", "total").alias("share")
    )


def orderflow_delta(trades: DataFrame, timeframe: str = "1h") -> DataFrame:
    """Bought less sold quantity of each bar, and its running sum."""
    from tallow.operators.bars import bar_window

    signed = F.when(F.col("trade_side") == "buy", F.col("quantity")).otherwise(-F.col("quantity"))
    bars = trades.groupBy("exchange", "symbol", bar_window("timestamp", timeframe).alias("bar")).agg(F.sum(signed).alias("delta"))
    market = ("exchange", "symbol")
    rows = halo.carried(bars.select(*market, F.col("bar.start").alias("open_time"), "delta"), F.col("delta"), "before", market)
    running = halo.within(market).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("cumulative_delta", F.col("before") + F.sum("delta").over(running)).drop("before", "_stretch")


def candle_delta(candles: DataFrame) -> DataFrame:
    """The same delta from a candle's own volumes."""
    return candles.select(*SERIES, "open_time", (2 * F.col("taker_buy_base_volume") - F.col("base_volume")).alias("delta"))


def wilder_atr(candles: DataFrame, length: int = 14) -> DataFrame:
    """Recursively smoothed true range: the first true range, then (last value * (length - 1) + true range) / length.

    The recursion is linear, so it has a closed form inside a stretch of SMOOTHED candles, and what a stretch takes
    over from those before it is another such sum over their ends, as far back as a double shows it.
    """
    keep = 1 - 1 / length
    ranges = price_range_atr(candles, length).select(*SERIES, "open_time", "true_range")
    if length == 1:
        return ranges.withColumnRenamed("true_range", "atr")
    rows = halo.numbered(ranges, "place").withColumns({"stretch": F.expr(f"place div {SMOOTHED}"), "k": F.col("place") % SMOOTHED})
    share = F.when(F.col("place") == 0, F.col("true_range")).otherwise(F.col("true_range") / length)
    inside = Window.partitionBy(*SERIES, "stretch").orderBy("open_time").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("own", F.pow(F.lit(keep), F.col("k")) * F.sum(share * F.pow(F.lit(keep), -F.col("k"))).over(inside))
    ends = rows.groupBy(*SERIES, "stretch").agg(F.max_by("own", "k").alias("end"))
    # a full stretch leaves this share of what came before it
    left = keep**SMOOTHED
    back = math.ceil(math.log(1e-18) / math.log(left))
    before = F.collect_list("end").over(Window.partitionBy(*SERIES).orderBy("stretch").rowsBetween(-back, -1))
    carried = ends.select(*SERIES, "stretch", F.aggregate(before, F.lit(0.0), lambda done, end: done * left + end).alias("carried"))
    out = halo.joined(rows, carried, (*SERIES, "stretch"))
    return out.select(*SERIES, "open_time", (F.col("own") + F.pow(F.lit(keep), F.col("k") + 1) * F.col("carried")).alias("atr"))
