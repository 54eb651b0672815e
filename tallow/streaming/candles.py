"""Structured Streaming: candles of a stream of trades, and their upsert into the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallow.operators.bars import candles_from_trades
from tallow.operators.dedupe import keep_last
from tallow.sources.lake import upsert_candles


def streaming_candles(trades: DataFrame, timeframe: str, lateness: str = "1 hour") -> DataFrame:
    """Candles that the watermark has closed; trades seen twice within it count once, later ones are dropped."""
    times = trades.withColumns({c: F.col(c).cast("timestamp") for c in ("timestamp", "ingested_at")})
    once = times.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["exchange", "symbol", "agg_trade_id"])
    return candles_from_trades(once, timeframe)


def upsert_stream(candles: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Every micro-batch goes through the lake's upsert, so a batch that is replayed changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        # computed once: the upsert stages it and checks, merges and counts what it staged
        upsert_candles(keep_last(batch), root, allow_empty=True)

    return candles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
