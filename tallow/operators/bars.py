"""Candles from trades, and longer candles from shorter ones: one shuffle, with partial aggregates before it."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallow.schema import CANDLES, OFFSETS, interval_of


def bar_window(time: str, timeframe: str) -> Column:
    length = interval_of(timeframe)
    return F.window(time, length, length, OFFSETS.get(timeframe))


def _shaped(bars: DataFrame, timeframe: str) -> DataFrame:
    return bars.withColumns(
        {
            "timeframe": F.lit(timeframe),
            "open_time": F.col("bar.start"),
            "close_time": F.col("bar.end") - F.expr("INTERVAL '0.001' SECOND"),
        }
    ).select(CANDLES.fieldNames())


def micros_of(df: DataFrame, time: str) -> Column:
    """A time column, with a zone or without, as microseconds since the epoch."""
    if isinstance(df.schema[time].dataType, T.TimestampType):
        return F.unix_micros(time)
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(time))


def trade_order(trades: DataFrame) -> Column:
    """(timestamp, agg_trade_id) as one number.

    A number of fixed width keeps the candles' aggregate a hash aggregate; with a struct to order by, Spark would sort
    all trades on both sides of the shuffle.
    """
    micros = micros_of(trades, "timestamp")
    # an identifier is a long, so it lies within half of the factor on either side of 0
    return micros.cast("decimal(18,0)") * F.lit(Decimal(2 * 10**19)) + F.col("agg_trade_id").cast("decimal(19,0)")


def candles_from_trades(trades: DataFrame, timeframe: str) -> DataFrame:
    """Open and close by (timestamp, agg_trade_id), so that trades of one instant have an order."""
    trades = trades.withColumn("_order", trade_order(trades))
    order = F.col("_order")
    bought = F.col("trade_side") == "buy"
    bars = trades.groupBy("exchange", "symbol", bar_window("timestamp", timeframe).alias("bar")).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("base_volume"),
        F.sum("quote_quantity").alias("quote_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(F.when(bought, F.col("quantity")).otherwise(0.0)).alias("taker_buy_base_volume"),
        F.sum(F.when(bought, F.col("quote_quantity")).otherwise(0.0)).alias("taker_buy_quote_volume"),
        F.max("ingested_at").alias("ingested_at"),
    )
    return _shaped(bars, timeframe)


def resample(candles: DataFrame, timeframe: str) -> DataFrame:
    """Longer candles from shorter ones of the same series."""
    total = lambda c: F.sum(c).alias(c)
    bars = candles.groupBy("exchange", "symbol", bar_window("open_time", timeframe).alias("bar")).agg(
        F.min_by("open", "open_time").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "open_time").alias("close"),
        *(total(c) for c in ("base_volume", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume")),
        F.max("ingested_at").alias("ingested_at"),
    )
    return _shaped(bars, timeframe)
