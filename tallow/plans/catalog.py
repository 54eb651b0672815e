"""Registered market-data queries, each over its whole table, and the DuckDB SQL that checks them.

Faults are planted by a rule on the hour of a candle, the same in both languages, so that the quality rules have
something to find.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallow.functions import derived, structure
from tallow.operators import bars, dedupe, gaps, quality, rules
from tallow.schema import CANDLE_KEY, SERIES, TRADE_KEY
from tallow.scratch import application_dir
from tallow.sources import adapters, backfill, decode, lake, states
from tallow.streaming import alerts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

TRADES_SQL = """
trades AS (
  SELECT 'demo' AS exchange, upper(event_type) AS symbol, event_id AS agg_trade_id, ts AS timestamp, value AS price,
    CAST(props->>'$.k' AS DOUBLE) AS quantity, event_id AS first_trade_id, event_id AS last_trade_id,
    user_id % 2 = 0 AS is_buyer_maker, ts + INTERVAL 1 SECOND AS ingested_at,
    value * CAST(props->>'$.k' AS DOUBLE) AS quote_quantity,
    CASE WHEN user_id % 2 = 0 THEN 'sell' ELSE 'buy' END AS trade_side
  FROM events
)"""


def _candles_sql(name: str, source: str, timeframe: str, bucket: str, length: str) -> str:
    return f"""
{name} AS (
  SELECT exchange, symbol, '{timeframe}' AS timeframe, open_time, open, high, low, close, base_volume, quote_volume,
    open_time + INTERVAL {length} - INTERVAL 1 MILLISECOND AS close_time, trade_count, taker_buy_base_volume, taker_buy_quote_volume, ingested_at
  FROM (
    SELECT exchange, symbol, {bucket} AS open_time,
      arg_min(price, (timestamp, agg_trade_id)) AS open, max(price) AS high, min(price) AS low,
      arg_max(price, (timestamp, agg_trade_id)) AS close, sum(quantity) AS base_volume, sum(quote_quantity) AS quote_volume,
      count(*) AS trade_count, sum(CASE WHEN trade_side = 'buy' THEN quantity ELSE 0 END) AS taker_buy_base_volume,
      sum(CASE WHEN trade_side = 'buy' THEN quote_quantity ELSE 0 END) AS taker_buy_quote_volume, max(ingested_at) AS ingested_at
    FROM {source} GROUP BY ALL
  )
)"""


HOURLY_SQL = TRADES_SQL + "," + _candles_sql("candles", "trades", "1h", "date_trunc('hour', timestamp)", "1 HOUR")
_SHOWN = """exchange, symbol, timeframe, open_time, open, high, low, close, round(base_volume, 4) AS base_volume,
  round(quote_volume, 4) AS quote_volume, close_time, trade_count, round(taker_buy_base_volume, 4) AS taker_buy_base_volume,
  round(taker_buy_quote_volume, 4) AS taker_buy_quote_volume, ingested_at"""

#: Hours since the epoch, and the faults planted by it.
FAULTS_SQL = """
hours AS (SELECT *, CAST(epoch(open_time) AS BIGINT) // 3600 AS hour_no FROM candles),
faulty AS (
  SELECT exchange, symbol, timeframe, open_time, open,
    CASE WHEN hour_no % 97 = 0 THEN low ELSE high END AS high, CASE WHEN hour_no % 97 = 0 THEN high ELSE low END AS low,
    CASE WHEN hour_no % 89 = 0 THEN NULL WHEN hour_no % 67 = 0 THEN CAST('NaN' AS DOUBLE) ELSE close END AS close,
    CASE WHEN hour_no % 83 = 0 THEN -1 - base_volume ELSE base_volume END AS base_volume, quote_volume,
    CASE WHEN hour_no % 79 = 0 THEN open_time ELSE close_time END AS close_time,
    trade_count, taker_buy_base_volume, taker_buy_quote_volume, ingested_at
  FROM hours
)"""


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.trades_from_events(adapters.table(spark, sf_dir, "events"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.candles_from_trades(trades(spark, sf_dir), "1h")


def _hour_no():
    # times without a zone are counted from the epoch as they stand
    return F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(open_time AS TIMESTAMP_NTZ))")


def faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, h = hourly(spark, sf_dir), _hour_no()
    return df.withColumns(
        {
            "high": F.when(h % 97 == 0, F.col("low")).otherwise(F.col("high")),
            "low": F.when(h % 97 == 0, F.col("high")).otherwise(F.col("low")),
            "close": F.when(h % 89 == 0, None).when(h % 67 == 0, float("nan")).otherwise(F.col("close")),
            "base_volume": F.when(h % 83 == 0, -1 - F.col("base_volume")).otherwise(F.col("base_volume")),
            "close_time": F.when(h % 79 == 0, F.col("open_time")).otherwise(F.col("close_time")),
        }
    )


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Sums of doubles depend on their order beyond some digits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


_SUMS = ("base_volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


@query("agg_trades", f"WITH {TRADES_SQL} SELECT * FROM trades")
def _agg_trades(spark, sf_dir):
    return trades(spark, sf_dir)


@query("ohlcv_hourly", f"WITH {HOURLY_SQL} SELECT {_SHOWN} FROM candles")
def _ohlcv_hourly(spark, sf_dir):
    return rounded(hourly(spark, sf_dir), *_SUMS)


def _longer(timeframe: str, bucket: str, length: str) -> None:
    sql = f"""WITH {HOURLY_SQL}, longer AS (
  SELECT exchange, symbol, '{timeframe}' AS timeframe, {bucket} AS bar, arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low,
    arg_max(close, open_time) AS close, sum(base_volume) AS base_volume, sum(quote_volume) AS quote_volume, CAST(sum(trade_count) AS BIGINT) AS trade_count,
    sum(taker_buy_base_volume) AS taker_buy_base_volume, sum(taker_buy_quote_volume) AS taker_buy_quote_volume, max(ingested_at) AS ingested_at
  FROM candles GROUP BY ALL
) SELECT {_SHOWN} FROM (SELECT *, bar AS open_time, bar + INTERVAL {length} - INTERVAL 1 MILLISECOND AS close_time FROM longer)"""
    query(f"ohlcv_{timeframe}", sql)(lambda spark, sf_dir: rounded(bars.resample(hourly(spark, sf_dir), timeframe), *_SUMS))


_longer("4h", "time_bucket(INTERVAL 4 HOUR, open_time, TIMESTAMP '1970-01-01')", "4 HOUR")
_longer("1d", "date_trunc('day', open_time)", "1 DAY")
_longer("1w", "date_trunc('week', open_time)", "7 DAY")


@query(
    "ohlcv_daily_orders",
    "WITH prices AS (SELECT 'demo' AS exchange, upper(o_orderpriority) AS symbol, o_orderkey AS agg_trade_id, o_orderdate AS timestamp, o_totalprice AS price, "
    "1.0::DOUBLE AS quantity, o_totalprice AS quote_quantity, CASE WHEN o_custkey % 2 = 0 THEN 'sell' ELSE 'buy' END AS trade_side, "
    f"o_orderdate + INTERVAL 1 SECOND AS ingested_at FROM orders), {_candles_sql('candles', 'prices', '1d', "date_trunc('day', timestamp)", '1 DAY')} "
    + "SELECT "
    + _SHOWN.replace(", 4)", ", 2)")
    + " FROM candles",
)
def _daily_orders(spark, sf_dir):
    return rounded(bars.candles_from_trades(adapters.prices_from_orders(adapters.table(spark, sf_dir, "orders")), "1d"), *_SUMS, digits=2)


# -- quality ----------------------------------------------------------------------------------------------------

_MISSING = "open IS NULL OR close IS NULL OR isnan(close)"


@query("dq_missing_values", f"WITH {HOURLY_SQL}, {FAULTS_SQL} SELECT exchange, symbol, timeframe, open_time FROM faulty WHERE {_MISSING}")
def _dq_missing(spark, sf_dir):
    return quality.any_of(faulty(spark, sf_dir), ["missing_values"]).select(*CANDLE_KEY)


@query(
    "dq_ohlc_violations",
    f"WITH {HOURLY_SQL}, {FAULTS_SQL} SELECT exchange, symbol, timeframe, open_time, open, high, low FROM faulty "
    "WHERE high < low OR high < open OR low > open OR (NOT isnan(close) AND (high < close OR low > close)) OR (isnan(close) AND high < close)",
)
def _dq_ohlc(spark, sf_dir):
    names = ["high >= low", "high >= open", "high >= close", "low <= open", "low <= close"]
    return quality.any_of(faulty(spark, sf_dir), names).select(*CANDLE_KEY, "open", "high", "low")


@query("dq_negative_values", f"WITH {HOURLY_SQL}, {FAULTS_SQL} SELECT exchange, symbol, timeframe, open_time, round(base_volume, 4) AS base_volume FROM faulty WHERE base_volume < 0 OR low < 0 OR quote_volume < 0")
def _dq_negative(spark, sf_dir):
    return rounded(quality.any_of(faulty(spark, sf_dir), ["negative_values"]).select(*CANDLE_KEY, "base_volume"), "base_volume")


@query("dq_time_order", f"WITH {HOURLY_SQL}, {FAULTS_SQL} SELECT exchange, symbol, timeframe, open_time, close_time FROM faulty WHERE open_time >= close_time")
def _dq_time_order(spark, sf_dir):
    return quality.any_of(faulty(spark, sf_dir), ["open_time < close_time"]).select(*CANDLE_KEY, "close_time")


@query(
    "dq_duplicate_keys",
    f"WITH {HOURLY_SQL}, {FAULTS_SQL}, twice AS (SELECT * FROM faulty UNION ALL SELECT * FROM faulty WHERE (CAST(epoch(open_time) AS BIGINT) // 3600) % 71 = 0) "
    "SELECT exchange, symbol, timeframe, open_time, count(*) AS row_count FROM twice GROUP BY ALL HAVING count(*) > 1",
)
def _dq_duplicates(spark, sf_dir):
    df = faulty(spark, sf_dir)
    return rules.duplicate_keys(df.unionByName(df.filter(_hour_no() % 71 == 0)), CANDLE_KEY)


@query(
    "dq_unsorted_rows",
    f"WITH {TRADES_SQL}, late AS (SELECT symbol, agg_trade_id, CASE WHEN agg_trade_id % 53 = 0 THEN timestamp - INTERVAL 40 DAY ELSE timestamp END AS open_time FROM trades), "
    "ahead AS (SELECT *, lag(open_time) OVER (PARTITION BY symbol ORDER BY agg_trade_id) AS previous_open_time FROM late) "
    "SELECT * FROM ahead WHERE open_time < previous_open_time",
)
def _dq_unsorted(spark, sf_dir):
    df = trades(spark, sf_dir).withColumn("open_time", F.expr("IF(agg_trade_id % 53 = 0, timestamp - INTERVAL 40 DAYS, timestamp)"))
    found = quality.unsorted_rows(df.withColumn("timeframe", F.lit("tick")), "agg_trade_id")
    return found.select("symbol", "agg_trade_id", "open_time", "previous_open_time")


@query(
    "dq_unsorted_frame",
    f"WITH {TRADES_SQL}, late AS (SELECT symbol, agg_trade_id, CASE WHEN agg_trade_id % 53 = 0 THEN timestamp - INTERVAL 40 DAY ELSE timestamp END AS open_time FROM trades), "
    "ahead AS (SELECT *, lag(open_time) OVER (ORDER BY agg_trade_id) AS previous_open_time FROM late) "
    "SELECT * FROM ahead WHERE open_time < previous_open_time",
)
def _dq_unsorted_frame(spark, sf_dir):
    df = trades(spark, sf_dir).withColumn("open_time", F.expr("IF(agg_trade_id % 53 = 0, timestamp - INTERVAL 40 DAYS, timestamp)"))
    return quality.unsorted_rows(df, "agg_trade_id", "frame").select("symbol", "agg_trade_id", "open_time", "previous_open_time")


@query(
    "dq_report",
    f"""WITH {HOURLY_SQL}, {FAULTS_SQL}
SELECT 'missing_values' AS rule, count(*) AS violations FROM faulty WHERE {_MISSING}
UNION ALL SELECT 'high >= low', count(*) FROM faulty WHERE high < low
UNION ALL SELECT 'high >= open', count(*) FROM faulty WHERE high < open
UNION ALL SELECT 'high >= close', count(*) FROM faulty WHERE high < close
UNION ALL SELECT 'low <= open', count(*) FROM faulty WHERE low > open
UNION ALL SELECT 'low <= close', count(*) FROM faulty WHERE low > close
UNION ALL SELECT 'negative_values', count(*) FROM faulty WHERE open < 0 OR high < 0 OR low < 0 OR close < 0 OR base_volume < 0 OR quote_volume < 0 OR taker_buy_base_volume < 0 OR taker_buy_quote_volume < 0
UNION ALL SELECT 'open_time < close_time', count(*) FROM faulty WHERE open_time >= close_time""",
)
def _dq_report(spark, sf_dir):
    return quality.violation_report(faulty(spark, sf_dir), quality.row_rules())


@query(
    "gate_report",
    f"""WITH {HOURLY_SQL}, {FAULTS_SQL}, numbered AS (SELECT *, CAST(epoch(open_time) AS BIGINT) // 3600 AS h FROM faulty),
placed AS (SELECT *, CASE WHEN h % 59 = 0 THEN (h + 3) * 10 + 5 ELSE h * 10 END AS pos FROM numbered),
input AS (SELECT * FROM placed UNION ALL SELECT * FROM placed WHERE h % 53 = 0),
ahead AS (SELECT *, lag(open_time) OVER (PARTITION BY exchange, symbol, timeframe ORDER BY pos) AS previous FROM input)
SELECT 'missing_columns' AS rule, CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'empty', CAST(count(*) = 0 AS BIGINT) FROM input
UNION ALL SELECT 'missing_values', count(*) FROM input WHERE {_MISSING}
UNION ALL SELECT 'high >= low', count(*) FROM input WHERE high < low
UNION ALL SELECT 'high >= open', count(*) FROM input WHERE high < open
UNION ALL SELECT 'high >= close', count(*) FROM input WHERE high < close
UNION ALL SELECT 'low <= open', count(*) FROM input WHERE low > open
UNION ALL SELECT 'low <= close', count(*) FROM input WHERE low > close
UNION ALL SELECT 'negative_values', count(*) FROM input WHERE open < 0 OR high < 0 OR low < 0 OR close < 0 OR base_volume < 0 OR quote_volume < 0 OR taker_buy_base_volume < 0 OR taker_buy_quote_volume < 0
UNION ALL SELECT 'open_time < close_time', count(*) FROM input WHERE open_time >= close_time
UNION ALL SELECT 'duplicate_keys', count(*) FROM (SELECT exchange, symbol, timeframe, open_time FROM input GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'unsorted_rows', count(*) FROM ahead WHERE open_time < previous""",
)
def _gate_report(spark, sf_dir):
    h = F.col("h")
    placed = faulty(spark, sf_dir).withColumn("h", _hour_no()).withColumn("pos", F.when(h % 59 == 0, (h + 3) * 10 + 5).otherwise(h * 10))
    # a place of its own for each row of the input: series at one hour lie side by side, repeated rows behind one another
    placed = placed.withColumn("pos", F.col("pos") * 100_000 + F.pmod(F.crc32(F.col("symbol").cast("binary")), F.lit(49_999)) * 2)
    again = placed.filter(h % 53 == 0).withColumn("pos", F.col("pos") + 1)
    return quality.gate_report(placed.unionByName(again), "pos")


@query(
    "dq_quarantine_split",
    f"""WITH {HOURLY_SQL}, {FAULTS_SQL}
SELECT symbol, ({_MISSING} OR high < low OR high < open OR high < close OR low > open OR low > close OR base_volume < 0 OR low < 0 OR quote_volume < 0 OR open_time >= close_time) IS TRUE AS quarantined,
  count(*) AS row_count FROM faulty GROUP BY ALL""",
)
def _dq_split(spark, sf_dir):
    marked = quality.broken_rules(faulty(spark, sf_dir))
    return marked.groupBy("symbol", (F.size("broken") > 0).alias("quarantined")).agg(F.count(F.lit(1)).alias("row_count"))


# -- trade rules ------------------------------------------------------------------------------------------------

_BAD_TRADES_SQL = (
    TRADES_SQL
    + """, bad AS (SELECT * REPLACE (CASE WHEN agg_trade_id % 41 = 0 THEN -price ELSE price END AS price, CASE WHEN agg_trade_id % 43 = 0 THEN first_trade_id + 1 ELSE first_trade_id END AS first_trade_id,
  CASE WHEN agg_trade_id % 47 = 0 THEN 'hold' ELSE trade_side END AS trade_side) FROM trades)"""
)


def bad_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("agg_trade_id")
    return trades(spark, sf_dir).withColumns(
        {
            "price": F.when(i % 41 == 0, -F.col("price")).otherwise(F.col("price")),
            "first_trade_id": F.when(i % 43 == 0, F.col("first_trade_id") + 1).otherwise(F.col("first_trade_id")),
            "trade_side": F.when(i % 47 == 0, "hold").otherwise(F.col("trade_side")),
        }
    )


def _trade_rule(name: str, rule: str, where: str) -> None:
    def run(spark, sf_dir):
        df = bad_trades(spark, sf_dir)
        chosen = next(r for r in rules.compile_rules(quality.TRADE_RULES) if r.name == rule)
        return df.filter(chosen.violated(df.schema)).select(*TRADE_KEY)

    query(name, f"WITH {_BAD_TRADES_SQL} SELECT exchange, symbol, agg_trade_id FROM bad WHERE {where}")(run)


_trade_rule("trades_negative_values", "negative_values", "price < 0 OR quantity < 0 OR quote_quantity < 0")
_trade_rule("trades_id_order", "first_trade_id <= last_trade_id", "first_trade_id > last_trade_id")
_trade_rule("trades_side_domain", "trade_side_domain", "trade_side NOT IN ('buy', 'sell')")


@query(
    "trades_duplicate_keys",
    f"WITH {TRADES_SQL}, twice AS (SELECT * FROM trades UNION ALL SELECT * FROM trades WHERE agg_trade_id % 59 = 0) "
    "SELECT exchange, symbol, agg_trade_id, count(*) AS row_count FROM twice GROUP BY ALL HAVING count(*) > 1",
)
def _trades_duplicates(spark, sf_dir):
    df = trades(spark, sf_dir)
    return rules.duplicate_keys(df.unionByName(df.filter("agg_trade_id % 59 = 0")), TRADE_KEY)


@query(
    "trades_gate_report",
    f"""WITH {_BAD_TRADES_SQL},
input AS (SELECT *, CASE WHEN agg_trade_id % 53 = 0 THEN timestamp - INTERVAL 40 DAY ELSE timestamp END AS seen_at, agg_trade_id * 2 AS pos FROM bad
  UNION ALL SELECT *, timestamp, agg_trade_id * 2 + 1 FROM bad WHERE agg_trade_id % 59 = 0),
ahead AS (SELECT *, lag(seen_at) OVER (PARTITION BY exchange, symbol ORDER BY pos) AS previous FROM input)
SELECT 'missing_columns' AS rule, CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'empty', CAST(count(*) = 0 AS BIGINT) FROM input
UNION ALL SELECT 'first_trade_id <= last_trade_id', count(*) FROM input WHERE first_trade_id > last_trade_id
UNION ALL SELECT 'negative_values', count(*) FROM input WHERE price < 0 OR quantity < 0 OR quote_quantity < 0
UNION ALL SELECT 'trade_side_domain', count(*) FROM input WHERE trade_side NOT IN ('buy', 'sell')
UNION ALL SELECT 'duplicate_keys', count(*) FROM (SELECT exchange, symbol, agg_trade_id FROM input GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'unsorted_rows', count(*) FROM ahead WHERE seen_at < previous""",
)
def _trades_gate(spark, sf_dir):
    bad, i = bad_trades(spark, sf_dir), F.col("agg_trade_id")
    late = F.expr("IF(agg_trade_id % 53 = 0, timestamp - INTERVAL 40 DAYS, timestamp)")
    twice = bad.withColumn("pos", i * 2).withColumn("timestamp", late).unionByName(bad.filter(i % 59 == 0).withColumn("pos", i * 2 + 1))
    return quality.gate_report(twice, "pos", declaration=quality.TRADE_RULES)


@query(
    "trades_quarantine_split",
    f"""WITH {_BAD_TRADES_SQL}, marked AS (SELECT *, concat_ws(', ', CASE WHEN first_trade_id > last_trade_id THEN 'first_trade_id <= last_trade_id' END,
  CASE WHEN price < 0 OR quantity < 0 OR quote_quantity < 0 THEN 'negative_values' END, CASE WHEN trade_side NOT IN ('buy', 'sell') THEN 'trade_side_domain' END) AS broken FROM bad)
SELECT symbol, broken, count(*) AS row_count FROM marked GROUP BY ALL""",
)
def _trades_split(spark, sf_dir):
    good, bad = quality.split(bad_trades(spark, sf_dir), quality.TRADE_RULES)
    both = good.select("symbol", F.lit("").alias("broken")).unionByName(bad.select("symbol", F.array_join("broken", ", ").alias("broken")))
    return both.groupBy("symbol", "broken").agg(F.count(F.lit(1)).alias("row_count"))


@query("naming_violations", f"WITH {TRADES_SQL} SELECT lower(symbol) AS symbol, exchange, agg_trade_id FROM trades WHERE agg_trade_id % 61 = 0 AND lower(symbol) <> upper(symbol)")
def _naming(spark, sf_dir):
    lowered = F.when(F.col("agg_trade_id") % 61 == 0, F.lower("symbol")).otherwise(F.col("symbol"))
    return rules.naming_violations(trades(spark, sf_dir).withColumn("symbol", lowered)).select("symbol", "exchange", "agg_trade_id")


# -- grid and gaps ----------------------------------------------------------------------------------------------

_GRID_SQL = (
    HOURLY_SQL
    + """, grid AS (
  SELECT exchange, symbol, timeframe, unnest(generate_series(min(open_time), max(open_time), INTERVAL 1 HOUR)) AS open_time
  FROM candles GROUP BY exchange, symbol, timeframe
), gaps AS (SELECT grid.exchange, grid.symbol, grid.timeframe, grid.open_time AS missing_open_time FROM grid ANTI JOIN candles USING (exchange, symbol, timeframe, open_time))"""
)


@query("series_extent", f"WITH {HOURLY_SQL} SELECT exchange, symbol, timeframe, min(open_time) AS first_open_time, max(open_time) AS last_open_time, count(*) AS candle_count FROM candles GROUP BY ALL")
def _extent(spark, sf_dir):
    return gaps.series_extent(hourly(spark, sf_dir))


@query("time_grid", f"WITH {_GRID_SQL} SELECT * FROM grid")
def _grid(spark, sf_dir):
    return gaps.time_grid(hourly(spark, sf_dir), "1h")


@query("find_time_gaps", f"WITH {_GRID_SQL} SELECT * FROM gaps")
def _gaps(spark, sf_dir):
    return gaps.find_time_gaps(hourly(spark, sf_dir), "1h")


@query(
    "gap_ranges",
    f"""WITH {_GRID_SQL}, numbered AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, timeframe ORDER BY missing_open_time) AS k FROM gaps)
SELECT exchange, symbol, timeframe, min(missing_open_time) AS from_time, max(missing_open_time) AS to_time, count(*) AS missing_count
FROM numbered GROUP BY exchange, symbol, timeframe, missing_open_time - k * INTERVAL 1 HOUR""",
)
def _gap_ranges(spark, sf_dir):
    return gaps.gap_ranges(hourly(spark, sf_dir), "1h")


@query("gaps_except", f"WITH {_GRID_SQL} SELECT exchange, symbol, timeframe, open_time AS missing_open_time FROM (SELECT * FROM grid EXCEPT SELECT exchange, symbol, timeframe, open_time FROM candles)")
def _gaps_except(spark, sf_dir):
    return gaps.gaps_as_difference(hourly(spark, sf_dir), "1h")


@query("gap_counts", f"WITH {_GRID_SQL} SELECT exchange, symbol, timeframe, count(*) AS gap_count FROM gaps GROUP BY ALL")
def _gap_counts(spark, sf_dir):
    return gaps.gap_counts(hourly(spark, sf_dir), "1h")


@query(
    "silent_series",
    f"""WITH {HOURLY_SQL}, ahead AS (SELECT exchange, symbol, timeframe, open_time, lead(open_time) OVER (PARTITION BY exchange, symbol, timeframe ORDER BY open_time) AS next_open_time,
  max(open_time) OVER () AS last_of_all FROM candles)
SELECT exchange, symbol, timeframe, open_time AS last_open_time, open_time + INTERVAL 1 HOUR AS due_time FROM ahead
WHERE coalesce(next_open_time, last_of_all) > open_time + INTERVAL 1 HOUR""",
)
def _silent(spark, sf_dir):
    return alerts.silent_ranges(hourly(spark, sf_dir), "1h")


@query(
    "backfill_requests",
    f"""WITH {_GRID_SQL}, placed AS (SELECT *, epoch_ms(missing_open_time) AS ms, epoch_ms(missing_open_time) // (24 * 3600000) AS page FROM gaps)
SELECT exchange, symbol, timeframe, min(ms) AS start_ms, max(ms) AS end_ms, count(*) AS slots FROM placed GROUP BY exchange, symbol, timeframe, page""",
)
def _backfill_requests(spark, sf_dir):
    """Pages of a day each."""
    return backfill.requests(backfill.missing_ranges(hourly(spark, sf_dir), "1h"), "1h", limit=24).withColumn("slots", F.col("slots").cast("long"))


# -- deduplication, upsert, layout ------------------------------------------------------------------------------

#: Three pages of one feed that overlap: each holds the candles of two of three classes of hours.
_PAGES_SQL = (
    HOURLY_SQL
    + """, pages AS (SELECT c.* REPLACE (close + page_no AS close), page_no, CAST(epoch(open_time) AS BIGINT) // 3600 AS row_pos
  FROM candles c, (SELECT unnest([0, 1, 2]) AS page_no) WHERE (CAST(epoch(open_time) AS BIGINT) // 3600) % 3 <> page_no)"""
)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, h = hourly(spark, sf_dir), _hour_no()
    one = [df.filter(h % 3 != p).withColumns({"close": F.col("close") + p, "page_no": F.lit(p), "row_pos": h}) for p in range(3)]
    return one[0].unionByName(one[1]).unionByName(one[2])


def _winner_sql(direction: str) -> str:
    return f"WITH {_PAGES_SQL} SELECT exchange, symbol, timeframe, open_time, close, page_no FROM pages QUALIFY row_number() OVER (PARTITION BY exchange, symbol, timeframe, open_time ORDER BY page_no {direction}) = 1"


@query("union_pages", f"WITH {_PAGES_SQL} SELECT exchange, symbol, timeframe, open_time, close, page_no FROM pages")
def _union_pages(spark, sf_dir):
    return pages(spark, sf_dir).select(*CANDLE_KEY, "close", "page_no")


@query("dedupe_keep_first", _winner_sql("ASC"))
def _keep_first(spark, sf_dir):
    return dedupe.keep_first(pages(spark, sf_dir)).select(*CANDLE_KEY, "close", "page_no")


@query("dedupe_keep_last", _winner_sql("DESC"))
def _keep_last(spark, sf_dir):
    return dedupe.keep_last(pages(spark, sf_dir), ("page_no", "row_pos")).select(*CANDLE_KEY, "close", "page_no")


@query(
    "upsert_keep_last",
    f"WITH {HOURLY_SQL} SELECT exchange, symbol, timeframe, open_time, CASE WHEN (CAST(epoch(open_time) AS BIGINT) // 3600) % 5 = 0 THEN close + 1 ELSE close END AS close FROM candles "
    "WHERE (CAST(epoch(open_time) AS BIGINT) // 3600) % 5 = 0 OR (CAST(epoch(open_time) AS BIGINT) // 3600) % 7 <> 0",
)
def _upsert(spark, sf_dir):
    df, h = hourly(spark, sf_dir), _hour_no()
    corrected = df.filter(h % 5 == 0).withColumn("close", F.col("close") + 1)
    return dedupe.merge_latest(df.filter(h % 7 != 0), corrected).select(*CANDLE_KEY, "close")


def _own_lake(spark: SparkSession) -> str:
    return f"{application_dir(spark)}/lake-{uuid.uuid4().hex}"


def _with_zone(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({t: F.col(t).cast("timestamp") for t in times})


@query(
    "lake_roundtrip",
    f"WITH {HOURLY_SQL} SELECT exchange, symbol, timeframe, open_time, CASE WHEN (CAST(epoch(open_time) AS BIGINT) // 3600) % 5 = 0 THEN close + 1 ELSE close END AS close, "
    "strftime(open_time, '%Y') AS year, strftime(open_time, '%m') AS month FROM candles "
    "WHERE (CAST(epoch(open_time) AS BIGINT) // 3600) % 5 = 0 OR (CAST(epoch(open_time) AS BIGINT) // 3600) % 7 <> 0",
)
def _lake_roundtrip(spark, sf_dir):
    """A first write, corrections of single candles, and what the lake holds then."""
    df, h = hourly(spark, sf_dir), _hour_no()
    first = df.filter(h % 7 != 0)
    # corrections move the close upwards, so the high as well
    corrected = df.filter(h % 5 == 0).withColumns({"close": F.col("close") + 1, "high": F.greatest("high", F.col("close") + 1)})
    root = _own_lake(spark)
    for part in (first, corrected, corrected):
        lake.upsert_candles(_with_zone(part, "open_time", "close_time", "ingested_at"), root)
    return lake.read_candles(spark, root).select(*SERIES, F.col("open_time").cast("timestamp_ntz").alias("open_time"), "close", "year", "month")


@query(
    "trade_lake_roundtrip",
    f"WITH {TRADES_SQL} SELECT exchange, symbol, agg_trade_id, CASE WHEN agg_trade_id % 5 = 0 THEN price + 1 ELSE price END AS price, trade_side, "
    "strftime(timestamp, '%Y') AS year, strftime(timestamp, '%m') AS month, strftime(timestamp, '%d') AS day FROM trades WHERE agg_trade_id % 5 = 0 OR agg_trade_id % 7 <> 0",
)
def _trade_lake_roundtrip(spark, sf_dir):
    df = _with_zone(trades(spark, sf_dir), "timestamp", "ingested_at")
    root = _own_lake(spark)
    lake.upsert_trades(df.filter("agg_trade_id % 7 <> 0"), root)
    lake.upsert_trades(df.filter("agg_trade_id % 5 = 0").withColumn("price", F.col("price") + 1), root)
    return lake.read_trades(spark, root).select(*TRADE_KEY, "price", "trade_side", "year", "month", "day")


@query(
    "lake_appends",
    f"WITH {HOURLY_SQL} SELECT exchange, symbol, timeframe, open_time, close + CASE WHEN ascii(right(symbol, 1)) % 2 = 0 THEN 1 ELSE 0 END AS close, "
    "strftime(open_time, '%Y') AS year, strftime(open_time, '%m') AS month FROM candles",
)
def _lake_appends(spark, sf_dir):
    """Two appends through the data source, then some symbols replaced."""
    df, h, root = _with_zone(hourly(spark, sf_dir), "open_time", "close_time", "ingested_at"), _hour_no(), _own_lake(spark)
    for part in (df.filter(h % 2 == 0), df.filter(h % 2 == 1)):
        lake.append(part, root)
    some = df.filter("ascii(right(symbol, 1)) % 2 = 0").withColumns({"close": F.col("close") + 1, "high": F.greatest("high", F.col("close") + 1)})
    lake.append(some, root, replace=True)
    return lake.read_candles(spark, root).select(*SERIES, F.col("open_time").cast("timestamp_ntz").alias("open_time"), "close", "year", "month")


@query(
    "lake_extent",
    f"WITH {HOURLY_SQL} SELECT exchange, symbol, timeframe, min(open_time) AS first_open_time, max(open_time) AS last_open_time, count(*) AS candle_count FROM candles "
    "WHERE (CAST(epoch(open_time) AS BIGINT) // 3600) % 5 = 0 OR (CAST(epoch(open_time) AS BIGINT) // 3600) % 7 <> 0 GROUP BY ALL",
)
def _lake_extent(spark, sf_dir):
    """Series' extents out of the lake's states, after two upserts."""
    df, h, root = hourly(spark, sf_dir), _hour_no(), _own_lake(spark)
    for part in (df.filter(h % 7 != 0), df.filter(h % 5 == 0)):
        lake.upsert_candles(_with_zone(part, "open_time", "close_time", "ingested_at"), root, states=[states.extent()])
    found = states.read_state(spark, root, states.extent())
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_open_time", "last_open_time")})


@query(
    "lake_profile",
    f"WITH {TRADES_SQL} SELECT exchange, symbol, CAST(floor(price / 10) * 10 AS DOUBLE) AS price_bin, sum(quantity) AS volume FROM trades GROUP BY ALL",
)
def _lake_profile(spark, sf_dir):
    """Volume profiles out of the states of the days of trades."""
    root = _own_lake(spark)
    lake.upsert_trades(_with_zone(trades(spark, sf_dir), "timestamp", "ingested_at"), root, states=[states.profile(10.0)])
    return states.read_state(spark, root, states.profile(10.0))


@query(
    "partition_row_counts",
    f"WITH {HOURLY_SQL} SELECT exchange, symbol, timeframe, strftime(open_time, '%Y') AS year, strftime(open_time, '%m') AS month, count(*) AS row_count FROM candles GROUP BY ALL",
)
def _partition_counts(spark, sf_dir):
    return lake.with_partitions(hourly(spark, sf_dir)).groupBy(*SERIES, "year", "month").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "partition_path",
    f"WITH {HOURLY_SQL} SELECT DISTINCT exchange, symbol, timeframe, strftime(open_time, '%Y') AS year, strftime(open_time, '%m') AS month, "
    "'price/ohlcv/exchange=' || exchange || '/symbol=' || symbol || '/timeframe=' || timeframe || strftime(open_time, '/year=%Y/month=%m') AS path FROM candles",
)
def _partition_path(spark, sf_dir):
    return lake.partition_path(hourly(spark, sf_dir))


# -- projections and order --------------------------------------------------------------------------------------


@query("calendar_parts", f"WITH {HOURLY_SQL} SELECT symbol, open_time, CAST(year(open_time) AS INTEGER) AS year, CAST(month(open_time) AS INTEGER) AS month, strftime(open_time, '%m') AS month_text FROM candles")
def _calendar(spark, sf_dir):
    return hourly(spark, sf_dir).select("symbol", "open_time", F.year("open_time").alias("year"), F.month("open_time").alias("month"), F.date_format("open_time", "MM").alias("month_text"))


@query("epoch_millis_roundtrip", "SELECT event_id, epoch_us(ts) // 1000 AS epoch_millis, epoch_us(ts) // 1000 % 1000 AS millis, epoch_ms(epoch_us(ts) // 1000) AS back FROM events")
def _epoch(spark, sf_dir):
    ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    back = F.expr("timestampadd(MILLISECOND, epoch_millis, TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    df = adapters.table(spark, sf_dir, "events").select("event_id", ms.alias("epoch_millis"))
    return df.select("event_id", "epoch_millis", (F.col("epoch_millis") % 1000).alias("millis"), back.alias("back"))


def _edge(name: str, order: str) -> None:
    key = "open_time, symbol" if order == "ASC" else "open_time DESC, symbol DESC"
    columns = [F.asc, F.asc] if order == "ASC" else [F.desc, F.desc]
    query(name, f"WITH {HOURLY_SQL} SELECT symbol, open_time, open, close FROM candles ORDER BY {key} LIMIT 5")(
        lambda spark, sf_dir: hourly(spark, sf_dir).select("symbol", "open_time", "open", "close").orderBy(columns[0]("open_time"), columns[1]("symbol")).limit(5)
    )


_edge("head_candles", "ASC")
_edge("tail_candles", "DESC")


@query(
    "decode_wire",
    "SELECT 'demo' AS exchange, 'AB' AS symbol, '1h' AS timeframe, epoch_ms(epoch_us(ts) // 1000) AS open_time, value AS open, value AS close, event_id AS trade_count FROM events",
)
def _decode(spark, sf_dir):
    ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)").cast("string")
    value, zero = F.col("value").cast("string"), F.lit("0")
    row = F.array(ms, value, value, value, value, zero, ms, zero, F.col("event_id").cast("string"), zero, zero, zero)
    wire = adapters.table(spark, sf_dir, "events").select(row.alias("row"))
    out = decode.decode_rows(wire, "ab", "1h", "demo", ingested_at=F.lit(None).cast("timestamp"))
    # an instant as wall time in UTC, whatever the session's zone
    utc = F.expr("timestampadd(MILLISECOND, unix_millis(open_time), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    return out.select("exchange", "symbol", "timeframe", utc.alias("open_time"), "open", "close", "trade_count")


@query(
    "decode_pages",
    "SELECT event_id // 1000 AS page_no, CAST(row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) - 1 AS INTEGER) AS row_pos, "
    "'AB' AS symbol, epoch_ms(epoch_us(ts) // 1000) AS open_time, value AS close, event_id AS trade_count FROM events",
)
def _decode_pages(spark, sf_dir):
    ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)").cast("string")
    value, zero = F.col("value").cast("string"), F.lit("0")
    row = F.array(ms, value, value, value, value, zero, ms, zero, F.col("event_id").cast("string"), zero, zero, zero)
    wire = adapters.table(spark, sf_dir, "events").select("event_id", F.floor(F.col("event_id") / 1000).alias("page_no"), row.alias("row"))
    pages = wire.groupBy("page_no").agg(F.to_json(F.array_sort(F.collect_list(F.struct("event_id", "row")))["row"]).alias("payload"))
    out = decode.decode_pages(pages, "ab", "1h", "demo", ingested_at=F.lit(None).cast("timestamp"))
    utc = F.expr("timestampadd(MILLISECOND, unix_millis(open_time), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    return out.select("page_no", "row_pos", "symbol", utc.alias("open_time"), "close", "trade_count")


# -- derived datasets -------------------------------------------------------------------------------------------

_RETURNS_SQL = (
    HOURLY_SQL
    + """, ratios AS (SELECT *, close / nullif(lag(close) OVER w, 0) AS ratio, lag(close) OVER w AS last_close FROM candles WINDOW w AS (PARTITION BY symbol ORDER BY open_time)),
returns AS (SELECT *, ratio - 1 AS simple_return, ln(nullif(ratio, 0)) AS log_return FROM ratios)"""
)


@query("price_returns", f"WITH {_RETURNS_SQL} SELECT exchange, symbol, timeframe, open_time, round(simple_return, 6) AS simple_return, round(log_return, 6) AS log_return FROM returns")
def _returns(spark, sf_dir):
    return rounded(derived.price_returns(hourly(spark, sf_dir)), "simple_return", "log_return", digits=6)


@query(
    "price_range_atr",
    f"WITH {_RETURNS_SQL}, ranges AS (SELECT *, high - low AS price_range, greatest(high - low, abs(high - last_close), abs(low - last_close)) AS true_range FROM returns) "
    "SELECT exchange, symbol, timeframe, open_time, round(price_range, 4) AS price_range, round(true_range, 4) AS true_range, "
    "round(avg(true_range) OVER (PARTITION BY symbol ORDER BY open_time ROWS 13 PRECEDING), 4) AS atr FROM ranges",
)
def _range(spark, sf_dir):
    return rounded(derived.price_range_atr(hourly(spark, sf_dir)), "price_range", "true_range", "atr")


@query(
    "price_wilder_atr",
    f"WITH RECURSIVE {_RETURNS_SQL}, ranges AS (SELECT exchange, symbol, timeframe, open_time, row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS place, "
    "greatest(high - low, abs(high - last_close), abs(low - last_close)) AS true_range FROM returns), "
    "smooth AS (SELECT *, true_range AS atr FROM ranges WHERE place = 1 UNION ALL "
    "SELECT r.exchange, r.symbol, r.timeframe, r.open_time, r.place, r.true_range, (s.atr * 13 + r.true_range) / 14 FROM smooth s JOIN ranges r ON r.symbol = s.symbol AND r.place = s.place + 1) "
    "SELECT exchange, symbol, timeframe, open_time, round(atr, 4) AS atr FROM smooth",
)
def _wilder(spark, sf_dir):
    return rounded(derived.wilder_atr(hourly(spark, sf_dir)), "atr")


@query(
    "price_volatility",
    f"WITH {_RETURNS_SQL} SELECT exchange, symbol, timeframe, open_time, round(stddev_samp(log_return) OVER (PARTITION BY symbol ORDER BY open_time ROWS 23 PRECEDING), 6) AS rolling_volatility FROM returns",
)
def _volatility(spark, sf_dir):
    return rounded(derived.price_volatility(hourly(spark, sf_dir)), "rolling_volatility", digits=6)


@query(
    "realized_volatility",
    f"WITH {_RETURNS_SQL} SELECT exchange, symbol, timeframe, CAST(open_time AS DATE) AS day, round(sqrt(sum(log_return * log_return)), 6) AS realized_volatility FROM returns GROUP BY ALL",
)
def _realized(spark, sf_dir):
    return rounded(derived.realized_volatility(hourly(spark, sf_dir)), "realized_volatility", digits=6)


_SWINGS_SQL = f"""{HOURLY_SQL}, around AS (
  SELECT *, high > lag(high, 2) OVER w AND high > lag(high) OVER w AND high > lead(high) OVER w AND high > lead(high, 2) OVER w AS is_high,
    low < lag(low, 2) OVER w AND low < lag(low) OVER w AND low < lead(low) OVER w AND low < lead(low, 2) OVER w AS is_low
  FROM candles WINDOW w AS (PARTITION BY symbol ORDER BY open_time)
), swings AS (
  SELECT exchange, symbol, timeframe, open_time, 'high' AS kind, high AS price FROM around WHERE is_high
  UNION ALL SELECT exchange, symbol, timeframe, open_time, 'low', low FROM around WHERE is_low
), before AS (SELECT *, lag(price) OVER (PARTITION BY symbol, kind ORDER BY open_time) AS last_price FROM swings),
swing_points AS (SELECT exchange, symbol, timeframe, open_time, kind, price, CASE WHEN price > last_price THEN CASE kind WHEN 'high' THEN 'HH' ELSE 'HL' END
  WHEN price < last_price THEN CASE kind WHEN 'high' THEN 'LH' ELSE 'LL' END WHEN last_price IS NOT NULL THEN 'EQ' END AS structure FROM before)"""


@query("swing_points", f"WITH {_SWINGS_SQL} SELECT * FROM swing_points")
def _swings(spark, sf_dir):
    return derived.swing_points(hourly(spark, sf_dir))


def _structure_sql() -> str:
    """The state machine, swing by swing."""
    after = " ".join(f"WHEN s.structure = '{t}' AND m.trend_after = '{a}' THEN '{b}'" for t, row in structure.TABLES.items() for a, b in zip(structure.STATES, row, strict=True))
    return f"""WITH RECURSIVE {_SWINGS_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time, kind) AS k FROM swing_points),
machine AS (
  SELECT symbol, CAST(0 AS BIGINT) AS k, 'none' AS trend_before, 'none' AS trend_after FROM (SELECT DISTINCT symbol FROM numbered)
  UNION ALL SELECT s.symbol, s.k, m.trend_after, CASE {after} ELSE m.trend_after END FROM machine m JOIN numbered s ON s.symbol = m.symbol AND s.k = m.k + 1
)
SELECT n.exchange, n.symbol, n.timeframe, n.open_time, n.kind, n.price, n.structure, trend_before, trend_after FROM numbered n JOIN machine USING (symbol, k)"""


@query("market_structure", _structure_sql())
def _structure(spark, sf_dir):
    return structure.market_structure(hourly(spark, sf_dir))


_BROKEN_SQL = "CASE WHEN trend_before = 'down_weak' AND trend_after = 'up' THEN 'up' WHEN trend_before = 'up_weak' AND trend_after = 'down' THEN 'down' END"


@query("structure_breaks", f"SELECT *, {_BROKEN_SQL} AS direction FROM ({_structure_sql()}) WHERE {_BROKEN_SQL} IS NOT NULL")
def _breaks(spark, sf_dir):
    return structure.structure_breaks(hourly(spark, sf_dir))


@query(
    "volume_profile",
    f"""WITH {TRADES_SQL}, bins AS (SELECT exchange, symbol, CAST(floor(price / 10) * 10 AS DOUBLE) AS price_bin, sum(quantity) AS volume FROM trades GROUP BY ALL)
SELECT *, row_number() OVER w = 1 AS is_poc,
  coalesce(sum(volume) OVER (PARTITION BY symbol ORDER BY volume DESC, price_bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 0.7 * sum(volume) OVER (PARTITION BY symbol) AS in_value_area
FROM bins WINDOW w AS (PARTITION BY symbol ORDER BY volume DESC, price_bin)""",
)
def _profile(spark, sf_dir):
    return derived.volume_profile(trades(spark, sf_dir), 10.0)


@query(
    "value_area",
    f"""WITH RECURSIVE {TRADES_SQL}, bins AS (SELECT exchange, symbol, CAST(floor(price / 10) * 10 AS DOUBLE) AS price_bin, sum(quantity) AS volume FROM trades GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY price_bin) AS k, row_number() OVER (PARTITION BY symbol ORDER BY volume DESC, price_bin) AS r, sum(volume) OVER (PARTITION BY symbol) AS total FROM bins),
grown AS (
  SELECT exchange, symbol, price_bin AS poc, k AS low, k AS high, volume AS held, total FROM placed WHERE r = 1
  UNION ALL SELECT g.exchange, g.symbol, g.poc, CASE WHEN coalesce(b.volume, -1) >= coalesce(a.volume, -1) THEN g.low - 1 ELSE g.low END,
    CASE WHEN coalesce(b.volume, -1) >= coalesce(a.volume, -1) THEN g.high ELSE g.high + 1 END, g.held + greatest(coalesce(a.volume, -1), coalesce(b.volume, -1)), g.total
  FROM grown g LEFT JOIN placed b ON b.symbol = g.symbol AND b.k = g.low - 1 LEFT JOIN placed a ON a.symbol = g.symbol AND a.k = g.high + 1
  WHERE g.held < 0.7 * g.total AND (a.k IS NOT NULL OR b.k IS NOT NULL)
), done AS (SELECT * FROM grown QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY high - low DESC) = 1)
SELECT d.exchange, d.symbol, poc, l.price_bin AS value_low, h.price_bin AS value_high, held AS volume, held / d.total AS share
FROM done d JOIN placed l ON l.symbol = d.symbol AND l.k = d.low JOIN placed h ON h.symbol = d.symbol AND h.k = d.high""",
)
def _value_area(spark, sf_dir):
    return derived.value_area(trades(spark, sf_dir), 10.0)


@query(
    "orderflow_delta",
    f"""WITH {TRADES_SQL}, deltas AS (SELECT exchange, symbol, date_trunc('hour', timestamp) AS open_time, sum(CASE WHEN trade_side = 'buy' THEN quantity ELSE -quantity END) AS delta FROM trades GROUP BY ALL)
SELECT *, sum(delta) OVER (PARTITION BY symbol ORDER BY open_time ROWS UNBOUNDED PRECEDING) AS cumulative_delta FROM deltas""",
)
def _delta(spark, sf_dir):
    return derived.orderflow_delta(trades(spark, sf_dir))


@query("candle_delta", f"WITH {HOURLY_SQL} SELECT exchange, symbol, timeframe, open_time, 2 * taker_buy_base_volume - base_volume AS delta FROM candles")
def _candle_delta(spark, sf_dir):
    return derived.candle_delta(hourly(spark, sf_dir))
