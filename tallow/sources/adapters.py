"""Trades and candles out of the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXCHANGE = "demo"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades_from_events(events: DataFrame) -> DataFrame:
    """Events as trades: the type is the market, the value the price, ``k`` of the properties the quantity."""
    trades = events.select(
        F.lit(EXCHANGE).alias("exchange"),
        F.upper("event_type").alias("symbol"),
        F.col("event_id").alias("agg_trade_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.col("event_id").alias("first_trade_id"),
        F.col("event_id").alias("last_trade_id"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        (F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("ingested_at"),
    )
    # the buyer made the price, so the aggressor sold
    return trades.withColumns({"quote_quantity": F.col("price") * F.col("quantity"), "trade_side": F.when(F.col("is_buyer_maker"), "sell").otherwise("buy")})


def prices_from_orders(orders: DataFrame) -> DataFrame:
    """Orders as trades of one unit: the priority is the market, the total the price."""
    return orders.select(
        F.lit(EXCHANGE).alias("exchange"),
        F.upper("o_orderpriority").alias("symbol"),
        F.col("o_orderkey").alias("agg_trade_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("quantity"),
        F.col("o_totalprice").alias("quote_quantity"),
        F.when(F.col("o_custkey") % 2 == 0, "sell").otherwise("buy").alias("trade_side"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 SECOND")).alias("ingested_at"),
    )
