from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallow.operators import quality, rules
from tallow.schema import CANDLES, TRADES

BASE = {
    "exchange": "demo", "symbol": "BTCUSDT", "timeframe": "1h", "open_time": datetime(2026, 1, 1), "open": 90000.0, "high": 91000.0, "low": 89000.0,
    "close": 90500.0, "base_volume": 100.0, "quote_volume": 9000000.0, "close_time": datetime(2026, 1, 1, 0, 59, 59), "trade_count": 1000,
    "taker_buy_base_volume": 55.0, "taker_buy_quote_volume": 5000000.0, "ingested_at": datetime(2026, 1, 1, 1, 0, 1),
}


def candles(spark, *changes, ordinal=False):
    rows = [tuple({**BASE, **c}[f] for f in CANDLES.fieldNames()) for c in (changes or ({},))]
    df = spark.createDataFrame(rows, CANDLES)
    return df.withColumn("pos", F.monotonically_increasing_id()).coalesce(1) if ordinal else df


def hour(n, **more):
    at = datetime(2026, 1, 1) + timedelta(hours=n)
    return {"open_time": at, "close_time": at + timedelta(minutes=59), **more}


def broken(df, **options):
    with pytest.raises(quality.QualityError) as e:
        quality.enforce(df, **options)
    return e.value.rule


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({"close": None}, "missing_values"),
        ({"close": float("nan")}, "missing_values"),
        ({"high": 88000.0}, "high >= low"),
        ({"open": 91500.0}, "high >= open"),
        ({"close": 91500.0}, "high >= close"),
        ({"open": 88500.0}, "low <= open"),
        ({"close": 88500.0}, "low <= close"),
        ({"base_volume": -1.0}, "negative_values"),
        ({"close_time": datetime(2026, 1, 1)}, "open_time < close_time"),
        ({"high": 88000.0, "close_time": datetime(2026, 1, 1)}, "high >= low"),
    ],
)
def test_each_rule(spark, change, rule):
    assert broken(candles(spark, change)) == rule


def test_whole_table_rules(spark):
    assert broken(candles(spark).drop("ingested_at")) == "missing_columns"
    assert broken(candles(spark).limit(0)) == "empty"
    assert broken(candles(spark, {}, {})) == "duplicate_keys"
    assert broken(candles(spark, hour(2), hour(1), ordinal=True), ordinal="pos") == "unsorted_rows"


def test_passes(spark):
    for ok in ({}, {"high": float("inf")}, {"base_volume": -0.0}, {"base_volume": 0.0}):
        quality.enforce(candles(spark, ok))
    tied = candles(spark, hour(1), hour(1, symbol="ETHUSDT"), ordinal=True)
    quality.enforce(tied, ordinal="pos", scope="frame")
    # one series behind the other is in order for each series, not for the frame
    stacked = candles(spark, hour(1), hour(2), hour(1, symbol="ETHUSDT"), ordinal=True)
    quality.enforce(stacked, ordinal="pos")
    assert broken(stacked, ordinal="pos", scope="frame") == "unsorted_rows"
    quality.enforce(candles(spark).withColumn("extra", F.lit(1)))


def test_split(spark):
    good, bad = quality.split(candles(spark, hour(1), hour(2, high=1.0), hour(3, close=None)))
    assert good.count() == 1
    found = {tuple(r.broken) for r in bad.collect()}
    assert ("missing_values",) in found and len(found) == 2


def test_trade_rules(spark):
    df = spark.createDataFrame(
        [("demo", "AB", 1, 2.0, 1.0, 2.0, 1, 1, "buy"), ("demo", "AB", 2, -2.0, 1.0, 2.0, 3, 1, "hold"), ("Demo", "ab", 2, 2.0, 1.0, 2.0, 1, 1, "sell")],
        "exchange string, symbol string, agg_trade_id long, price double, quantity double, quote_quantity double, first_trade_id long, last_trade_id long, trade_side string",
    )
    got = {r.rule: r.violations for r in quality.violation_report(df, rules.compile_rules(quality.TRADE_RULES)).collect()}
    assert got == {"first_trade_id <= last_trade_id": 1, "negative_values": 1, "trade_side_domain": 1}
    assert rules.duplicate_keys(df.withColumns({"symbol": F.upper("symbol"), "exchange": F.lower("exchange")}), quality.TRADE_KEY).count() == 1
    assert rules.naming_violations(df).count() == 1
    with pytest.raises(ValueError, match="snake"):
        rules.naming_violations(df.withColumnRenamed("price", "Price"))


def test_rules_of_a_file(spark, tmp_path):
    (tmp_path / "r.yaml").write_text("rules:\n  required: [extra]\n  not_null: [close]\n  logical: ['close < 5']\n  one_of: {symbol: [A, B]}\n  unique: [symbol]\n")
    own = rules.load_declaration(str(tmp_path / "r.yaml"))
    df = spark.createDataFrame([("A", 1.0, 0), ("C", 7.0, 0), ("A", None, 0)], "symbol string, close double, extra int")
    assert dict(quality.check(df, declaration=own)) == {"empty": 0, "missing_values": 1, "close < 5": 1, "symbol_domain": 1, "duplicate_keys": 1}
    with pytest.raises(quality.QualityError, match="extra"):
        quality.enforce(df.drop("extra"), declaration=own)
    for text in ("", "rules: [", "other: {}", "rules: {unheard_of: [a]}", "rules: {unique: a}"):
        (tmp_path / "bad.yaml").write_text(text)
        with pytest.raises(rules.RuleError):
            rules.load_declaration(str(tmp_path / "bad.yaml"))
    assert quality.CANDLE_RULES["not_null"] == CANDLES.fieldNames()
    assert not quality.TRADE_RULES.keys() - rules.KINDS.keys()


def test_order_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(quality, "STRETCH", 3)
    at = [5, 6, 4, 7, 1, 8, 9, 2, 10, 11]
    place = spark.createDataFrame([(hour(h)["open_time"], k) for k, h in enumerate(at)], "open_time timestamp, pos long")
    df = candles(spark, *(hour(h, symbol="AB"[k % 2]) for k, h in enumerate(at))).join(place, "open_time")
    for scope in ("series", "frame"):
        got = {(r.pos, r.previous_open_time.hour) for r in quality.unsorted_rows(df, "pos", scope).collect()}
        ahead = lambda k: [j for j in range(k) if scope == "frame" or j % 2 == k % 2]  # noqa: B023, E731
        assert got == {(k, at[ahead(k)[-1]]) for k in range(len(at)) if ahead(k) and at[ahead(k)[-1]] > at[k]}


def test_gate_of_trades_and_of_other_declarations(spark):
    rows = [("demo", "AB", k, datetime(2026, 1, 1, 1 + k), 2.0 + k, 1.0, 2.0 + k, k, k, True, "sell", datetime(2026, 2, 1)) for k in range(3)]
    df = spark.createDataFrame(rows, TRADES).withColumn("pos", -F.col("agg_trade_id"))
    report = dict(quality.check(df, "pos", declaration=quality.TRADE_RULES))
    assert report["unsorted_rows"] == 2 and report["duplicate_keys"] == 0
    assert {r.rule: r.violations for r in quality.gate_report(df, "pos", declaration=quality.TRADE_RULES).collect()}["unsorted_rows"] == 2
    assert broken(df, ordinal="pos", declaration=quality.TRADE_RULES) == "unsorted_rows"
    good, bad = quality.split(df.withColumn("trade_side", F.when(F.col("agg_trade_id") == 1, "hold").otherwise("buy")), quality.TRADE_RULES)
    assert good.count() == 2 and [r.broken for r in bad.collect()] == [["trade_side_domain"]]
    assert quality.any_of(df, ["negative_values"], quality.TRADE_RULES).count() == 0
    # neither a key nor a time is declared
    small = {"non_negative": ["price"]}
    assert {r.rule for r in quality.gate_report(df, declaration=small).collect()} == {"missing_columns", "empty", "negative_values"}
    with pytest.raises(rules.RuleError, match="time"):
        quality.check(df, "pos", declaration=small)
    assert quality.check(df.drop("timestamp"), declaration=quality.TRADE_RULES) == [("missing_columns: timestamp", 1)]
    assert quality.split(df, {})[0].count() == 3
