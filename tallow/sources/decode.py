"""Wire candles: JSON arrays of twelve values in fixed positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The wire's positions; the last one is not used.
WIRE = ("open_time", "open", "high", "low", "close", "base_volume", "close_time", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume", "ignore")
_TIMES, _COUNTS = {"open_time", "close_time"}, {"trade_count"}


def _typed(row: Column, position: int, name: str) -> Column:
    value = F.element_at(row, position + 1)
    if name in _TIMES:
        return F.timestamp_millis(value.cast("bigint")).alias(name)
    return value.cast("bigint" if name in _COUNTS else "double").alias(name)


def decode_rows(df: DataFrame, symbol: str, timeframe: str, exchange: str, row: str = "row", carry: tuple[str, ...] = (), ingested_at: Column | None = None) -> DataFrame:
    """Candles of wire rows (array<string>), one select: positions, casts, constants, order of columns.

    A row of another width, or a value that is no number, is an error, as Spark's ANSI casts make it.
    ``carry`` names columns to keep behind the candle's own.
    """
    width = F.size(row)
    checked = F.when(width == len(WIRE), F.col(row)).otherwise(
        F.raise_error(F.concat(F.lit(f"a wire candle has {len(WIRE)} values, this one "), width.cast("string")))
    )
    typed = {name: _typed(F.col("_row"), k, name) for k, name in enumerate(WIRE[:-1])}
    return df.withColumn("_row", checked).select(
        F.lit(exchange).alias("exchange"),
        F.upper(F.lit(symbol)).alias("symbol"),
        F.lit(timeframe).alias("timeframe"),
        *(typed[n] for n in ("open_time", "open", "high", "low", "close", "base_volume", "quote_volume", "close_time", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume")),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        *carry,
    )


def decode_pages(pages: DataFrame, symbol: str, timeframe: str, exchange: str, payload: str = "payload", page_no: str = "page_no", ingested_at: Column | None = None) -> DataFrame:
    """Candles of JSON pages (one string of rows each), with page_no and row_pos to order them by."""
    rows = pages.select(page_no, F.posexplode(F.from_json(payload, "array<array<string>>")).alias("row_pos", "row"))
    return decode_rows(rows, symbol, timeframe, exchange, carry=(page_no, "row_pos"), ingested_at=ingested_at)
