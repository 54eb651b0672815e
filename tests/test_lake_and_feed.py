from __future__ import annotations

import json
import os
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallow.operators import gaps
from tallow.schema import TIMEFRAMES
from tallow.settings import ConfigError
from tallow.sources import decode, feed, lake
from tallow.sources.feed import FeedClient, SourceError
from tests.test_quality import candles, hour

HOUR = 3_600_000
START = 1_767_225_600_000  # 2026-01-01


def wire(ms, close=2.0):
    return [ms, "1", "3", "1", str(close), "10", ms + HOUR - 1, "20", 5, "4", "8", "0"]


def serve(url, params, timeout):
    """A provider with 2,500 hourly candles."""
    lo, hi = params.get("startTime", 0), min(params.get("endTime", 1 << 60), START + 2499 * HOUR)
    first = max(START, -(-(lo - START) // HOUR) * HOUR + START)
    return [wire(ms) for ms in range(first, hi + 1, HOUR)][: params["limit"]]


def test_upserts(spark, tmp_path):
    root = str(tmp_path / "lake")
    first = lake.upsert_candles(candles(spark, hour(1), hour(2), hour(24 * 31)), root)
    assert [(r.year, r.month, r.row_count) for r in first.collect()] == [("2026", "01", 2), ("2026", "02", 1)]
    before = {p: os.path.getmtime(p) for p in _files(root, "month=02")}
    lake.upsert_candles(candles(spark, hour(1), hour(2)), root)  # replay
    lake.upsert_candles(candles(spark, hour(2, close=90100.0), hour(3)), root)
    rows = {r.open_time.hour: r.close for r in lake.read_candles(spark, root).filter("month = '01'").collect()}
    assert rows == {1: 90500.0, 2: 90100.0, 3: 90500.0}
    assert before == {p: os.path.getmtime(p) for p in _files(root, "month=02")}  # untouched
    with pytest.raises(ValueError, match="high >= low"):
        lake.upsert_candles(candles(spark, hour(5, high=1.0)), root)
    assert lake.read_candles(spark, root).count() == 4
    assert lake.read_candles(spark, str(tmp_path / "none")).count() == 0


def _files(root, part):
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if part in d and f.endswith(".parquet")]


def test_partition_values_stay_strings(spark, tmp_path):
    root = str(tmp_path / "lake")
    for _ in range(2):
        lake.upsert_candles(candles(spark, {**hour(24 * 190), "timeframe": "1d"}), root)
    months = {d for _, names, _ in os.walk(root) for d in names if d.startswith("month=")}
    assert months == {"month=07"}
    assert lake.read_candles(spark, root).first().timeframe == "1d"


def test_nanosecond_leaf(spark, tmp_path):
    import pandas as pd

    path = str(tmp_path / "data.parquet")
    pd.DataFrame({"open_time": pd.to_datetime([START], unit="ms", utc=True).astype("datetime64[ns, UTC]"), "close": [1.0]}).to_parquet(path)
    assert lake.read_nanosecond_leaf(spark, path).select(F.unix_millis("open_time")).first()[0] == START


def test_decode(spark):
    pages = spark.createDataFrame([(0, json.dumps([wire(START), wire(START + HOUR, 2.5)])), (1, "[]")], "page_no int, payload string")
    rows = decode.decode_pages(pages, "ab", "1h", "demo").orderBy("open_time").collect()
    assert [(r.symbol, r.close, r.trade_count, r.page_no, r.row_pos) for r in rows] == [("AB", 2.0, 5, 0, 0), ("AB", 2.5, 5, 0, 1)]
    assert rows[0].open_time == datetime(2026, 1, 1)
    for bad in (wire(START)[:11], ["abc", *wire(START)[1:]]):
        one = spark.createDataFrame([(0, json.dumps([bad]))], "page_no int, payload string")
        with pytest.raises(Exception, match="twelve|12 values|CAST_INVALID"):
            decode.decode_pages(one, "ab", "1h", "demo").collect()


def test_feed_source(spark):
    feed.register(spark)
    options = {"symbol": "ab", "interval": "1h", "start_ms": START, "end_ms": START + 2499 * HOUR, "transport": "tests.test_lake_and_feed:serve"}
    df = spark.read.format("candle_feed").options(**options).load()
    assert df.rdd.getNumPartitions() == 3
    assert df.agg(F.count("*"), F.count_distinct("open_time"), F.min("symbol")).first()[:] == (2500, 2500, "AB")
    narrow = df.filter((F.col("open_time") >= "2026-01-02") & (F.col("open_time") < "2026-01-03"))
    assert narrow.count() == 24
    empty = spark.read.format("candle_feed").options(**options | {"start_ms": START + 9999 * HOUR, "end_ms": START}).load()
    assert empty.count() == 0 and len(empty.columns) == 15


def test_feed_stream(spark, tmp_path):
    feed.register(spark)
    options = {"symbol": "ab", "interval": "1h", "start_ms": START, "limit": 1000, "transport": "tests.test_lake_and_feed:serve"}
    stream = spark.readStream.format("candle_feed").options(**options).load()
    query = stream.writeStream.format("memory").queryName("tail").option("checkpointLocation", str(tmp_path)).start()
    try:
        query.processAllAvailable()
        assert spark.table("tail").agg(F.count_distinct("open_time")).first()[0] == 2500
    finally:
        query.stop()


def test_client():
    calls = []

    def pages(*answers):
        left = list(answers)
        calls.clear()

        def transport(url, params, timeout):
            calls.append(params)
            answer = left.pop(0)
            if isinstance(answer, Exception):
                raise answer
            return answer

        slept: list[float] = []
        return FeedClient("u", transport, sleep=slept.append), slept

    times = lambda rows: [r[0] for r in rows]
    client, _ = pages([])
    assert list(client.scan("a", "1h", START, limit=2)) == [] and len(calls) == 1
    client, _ = pages([wire(START), wire(START + HOUR)], [])
    assert times(client.scan("a", "1h", START, limit=2)) == [START, START + HOUR] and len(calls) == 2
    client, _ = pages([wire(START), wire(START + HOUR)], [wire(START + HOUR, 9.0)])
    got = list(client.scan("a", "1h", START, limit=2))
    assert times(got) == [START, START + HOUR] and got[1][4] == "2.0"
    client, _ = pages([wire(START - HOUR)])
    with pytest.raises(SourceError, match="advance"):
        list(client.scan("a", "1h", START, limit=1))
    client, slept = pages(*[OSError("down")] * 4, [wire(START)])
    assert len(client.page("a", "1h")) == 1 and slept == [2, 4, 6, 8]
    client, slept = pages(*[OSError("down")] * 5)
    with pytest.raises(SourceError):
        client.page("a", "1h")
    assert slept == [2, 4, 6, 8]
    for limit in (0, 1001):
        with pytest.raises(ValueError, match="limit"):
            client.page("a", "1h", limit)
    client, _ = pages({"msg": "no"})
    with pytest.raises(SourceError, match="list"):
        client.page("a", "1h")
    with pytest.raises(SourceError, match="12"):
        feed.typed_row(wire(START)[:11], "a", "1h", "demo", datetime.now(UTC))


@pytest.mark.parametrize("timeframe", sorted(TIMEFRAMES))
def test_gaps_of_each_timeframe(spark, timeframe):
    step = timedelta(milliseconds=feed.millis_of(timeframe))
    at = datetime(2026, 1, 5)
    df = candles(spark, *({"timeframe": timeframe, "open_time": at + k * step, "close_time": at + (k + 1) * step} for k in (0, 1, 3)))
    assert [r.missing_open_time for r in gaps.find_time_gaps(df, timeframe).collect()] == [at + 2 * step]


def test_gap_cases(spark):
    assert gaps.find_time_gaps(candles(spark), "1h").count() == 0
    assert gaps.find_time_gaps(candles(spark).limit(0), "1h").count() == 0
    off = hour(1)
    off["open_time"] += timedelta(seconds=1)
    assert gaps.find_time_gaps(candles(spark, hour(0), off, hour(2)), "1h").count() == 1
    two = candles(spark, hour(0), hour(2), hour(0, symbol="B"), hour(1, symbol="B"), hour(4, symbol="B"))
    assert {(r.symbol, r.gap_count) for r in gaps.gap_counts(two, "1h").collect()} == {("BTCUSDT", 1), ("B", 2)}
    with pytest.raises(ValueError, match="timeframe"):
        gaps.find_time_gaps(two, "2h")


def test_pages_out_of_order():
    left = [[wire(START + 3 * HOUR), wire(START + HOUR), wire(START + 2 * HOUR)], [wire(START + 2 * HOUR, 9.0), wire(START + 4 * HOUR)]]
    client = FeedClient("u", lambda url, params, timeout: left.pop(0))
    got = list(client.scan("a", "1h", START, limit=3))
    assert sorted(r[0] - START for r in got) == [HOUR, 2 * HOUR, 3 * HOUR, 4 * HOUR]
    assert {r[0]: r[4] for r in got}[START + 2 * HOUR] == "2.0"  # the first version


def refused(url, params, timeout):
    raise AssertionError("the driver asked the feed")


def clock():
    return int(os.environ["TALLOW_TEST_NOW"])


def test_tail_waits_for_the_close_and_asks_nothing(monkeypatch):
    options = {"symbols": "ab, cd", "interval": "1h", "start_ms": str(START), "limit": "2", "transport": "tests.test_lake_and_feed:refused", "clock": "tests.test_lake_and_feed:clock"}
    tail = feed.CandleTail(feed._Options(options))
    monkeypatch.setenv("TALLOW_TEST_NOW", str(START + 4 * HOUR - 1))
    assert tail.initialOffset() == {"AB": START, "CD": START}
    end = tail.latestOffset()
    assert end == {"AB": START + 3 * HOUR, "CD": START + 3 * HOUR}  # the fourth candle is still open
    slices = tail.partitions({"AB": START}, end)
    assert [(s.symbol, s.start_ms, s.end_ms) for s in slices] == [(x, START + a * HOUR, START + b * HOUR - 1) for x in ("AB", "CD") for a, b in ((0, 2), (2, 3))]
    assert tail.partitions(end, end) == []
    assert feed.CandleTail(feed._Options(options | {"lag_ms": str(HOUR)})).latestOffset()["AB"] == START + 2 * HOUR
    week = feed.CandleTail(feed._Options(options | {"interval": "1w"})).latestOffset()["AB"]
    assert week == START  # Thursday; the week began before it
    with pytest.raises(ValueError, match="start_ms"):
        feed.CandleTail(feed._Options({k: v for k, v in options.items() if k != "start_ms"}))


def serve_hours(url, params, timeout):
    """A candle for each hour there is; notes which process asked."""
    with open(url.removeprefix("note:").split("/candles")[0], "a") as note:
        note.write(f"{os.getpid()} {params['symbol']} {params['startTime']}\n")
    first = -(-(params["startTime"] - START) // HOUR)
    return [wire(START + k * HOUR) for k in range(first, (params["endTime"] - START) // HOUR + 1)][: params["limit"]]


def test_stream_of_two_symbols_restarts_without_loss(spark, tmp_path, monkeypatch):
    feed.register(spark)
    note, out = tmp_path / "note", str(tmp_path / "out")
    now = tmp_path / "now"
    options = {"symbols": "ab,cd", "interval": "1h", "start_ms": START, "limit": 10, "base_url": f"note:{note}", "transport": "tests.test_lake_and_feed:serve_hours"}
    for hours in (25, 25, 61):
        now.write_text(str(hours))
        # the clock stands that many hours behind the start
        lag = int(datetime.now(UTC).timestamp() * 1000) - START - hours * HOUR - 60_000
        stream = spark.readStream.format("candle_feed").options(**options, lag_ms=lag).load()
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "checkpoint")).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        rows = [(r.symbol, r.open_time) for r in spark.read.parquet(out).collect()]
        assert len(rows) == len(set(rows)) == 2 * hours
    asked = [line.split() for line in note.read_text().splitlines()]
    assert {s for _, s, _ in asked} == {"AB", "CD"} and len(asked) >= 2 * (3 + 4)
    assert str(os.getpid()) not in {p for p, _, _ in asked}


def an_hour_on():
    return START + HOUR


def test_stream_of_trades(spark, tmp_path):
    feed.register(spark)
    # a clock that stands still, as a stream is never through with one that goes on
    options = {"symbols": "ab", "start_ms": START, "limit": 100, "slice_ms": 600_000, "clock": "tests.test_lake_and_feed:an_hour_on", "transport": "tests.test_lake_and_feed:serve_trades"}
    query = spark.readStream.format("trade_feed").options(**options).load().writeStream.format("memory").queryName("trade_tail").option("checkpointLocation", str(tmp_path)).start()
    try:
        query.processAllAvailable()
        assert spark.table("trade_tail").agg(F.count("*"), F.count_distinct("agg_trade_id")).first()[:] == (5000, 5000)
    finally:
        query.stop()


def test_point_lookups_are_pushed():
    at = datetime.fromtimestamp((START + 7 * HOUR) / 1000, UTC)
    options = {"symbol": "ab", "interval": "1h", "start_ms": str(START), "end_ms": str(START + 2499 * HOUR)}
    for f, lo, hi in ((feed.EqualTo(("open_time",), at), 7, 7), (feed.In(("open_time",), (at, at + timedelta(hours=2))), 7, 9)):
        reader = feed.CandleReader(feed._Options(options))
        assert list(reader.pushFilters([f])) == [f]  # Spark filters again
        assert [(s.start_ms, s.end_ms) for s in reader.partitions()] == [(START + lo * HOUR, START + hi * HOUR)]


def trade(k, **more):
    return {"a": k, "p": str(10.0 + k), "q": "2", "f": k, "l": k, "T": START + k // 3 * 1000, "m": k % 2 == 0, **more}


def serve_trades(url, params, timeout):
    """A provider with 5,000 trades, three in each second."""
    rows = [trade(k) for k in range(5000)]
    if "fromId" in params:
        rows = [r for r in rows if r["a"] >= params["fromId"]]
    else:
        rows = [r for r in rows if params["startTime"] <= r["T"] <= params["endTime"]]
    return rows[: params["limit"]]


def test_trade_feed(spark):
    feed.register(spark)
    options = {"symbol": "ab", "start_ms": START, "end_ms": START + HOUR - 1, "limit": 100, "slice_ms": 600_000, "transport": "tests.test_lake_and_feed:serve_trades"}
    df = feed.trades(spark, {"price": {"default_exchange": "demo"}}, **options)
    assert df.rdd.getNumPartitions() == 6
    assert df.agg(F.count("*"), F.count_distinct("agg_trade_id"), F.min("exchange")).first()[:] == (5000, 5000, "demo")
    one = df.filter("agg_trade_id = 7").first()
    assert (one.price, one.quote_quantity, one.trade_side, one.is_buyer_maker) == (17.0, 34.0, "buy", False)
    assert df.filter((F.col("timestamp") >= "2026-01-01 00:00:10") & (F.col("timestamp") < "2026-01-01 00:00:20")).count() == 30
    with pytest.raises(SourceError, match="trades"):
        list(FeedClient("u", lambda *a: {}).trades("a", START, START))


def test_configured_feed_and_lake(tmp_path):
    config = {"feed": {"base_url": "http://x", "candles": "/c", "limit": 10, "max_attempts": 2}, "price": {"default_symbol": "AB"}, "paths": {"raw": str(tmp_path)}}
    assert feed.configured("candles", config) == {"base_url": "http://x", "endpoint": "/c", "limit": "10", "attempts": "2", "symbol": "AB"}
    assert feed.configured("trades")["endpoint"] == "/trades"  # of config/config.yaml
    assert lake.configured_root(lake.TRADE_SET, config) == f"{tmp_path}/price/agg_trades"
    assert lake.configured_root() == "data/raw/price/ohlcv"


def test_failed_replacement_keeps_the_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    lake.upsert_candles(candles(spark, hour(1)), root)

    def broken(*args):
        raise OSError("disk full")

    monkeypatch.setattr(lake, "_replace", broken)
    with pytest.raises(lake.LakeError, match="staging") as e:
        lake.upsert_candles(candles(spark, hour(1, close=90100.0), hour(2)), root)
    kept = spark.read.parquet(str(e.value).rsplit(" ", 1)[1])
    assert {(r.open_time.hour, r.close) for r in kept.collect()} == {(1, 90100.0), (2, 90500.0)}


def test_upsert_reads_the_input_once_and_touched_partitions_only(spark, tmp_path):
    root = str(tmp_path / "lake")
    lake.upsert_candles(candles(spark, hour(1), hour(24 * 40), hour(24 * 70)), root)
    runs = spark.sparkContext.accumulator(0)

    def counted(rows):
        runs.add(1)
        yield from rows

    source = candles(spark, hour(2)).coalesce(1)
    lake.upsert_candles(source.mapInPandas(counted, source.schema), root)
    assert runs.value == 1
    touched = spark.createDataFrame([("demo", "BTCUSDT", "1h", "2026", "01")], lake.CANDLE_SET.partitions)
    plan = lake.touched_only(lake.read_candles(spark, root), touched, lake.CANDLE_SET.partitions)
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in shown and "month#" in shown.split("PartitionFilters")[1] and "= 01" in shown
    assert len(plan.inputFiles()) == 3  # listed before pruning
    assert lake.upsert_candles(candles(spark).limit(0), root, allow_empty=True).count() == 0
    assert not [d for d in os.listdir(tmp_path) if "staging" in d]


def test_trade_lake(spark, tmp_path):
    root = str(tmp_path / "trades")
    rows = [("demo", "AB", k, datetime(2026, 1, 1 + k), 2.0 + k, 1.0, 2.0 + k, k, k, True, "sell", datetime(2026, 2, 1)) for k in range(3)]
    df = spark.createDataFrame(rows, lake.TRADES)
    assert [(r.day, r.row_count) for r in lake.upsert_trades(df, root).collect()] == [("01", 1), ("02", 1), ("03", 1)]
    lake.upsert_trades(df.filter("agg_trade_id = 1").withColumn("price", F.lit(9.0)), root)
    assert {r.agg_trade_id: r.price for r in lake.read_trades(spark, root).collect()} == {0: 2.0, 1: 9.0, 2: 4.0}
    with pytest.raises(ValueError, match="negative"):
        lake.upsert_trades(df.withColumn("price", F.lit(-1.0)), root)


def test_partition_paths_are_the_writers(spark, tmp_path):
    odd = ["A/B", "a=b:c", "50%", "x\ty", "q?*'\"", "[z]^{", "\\", "plain-1.2 ü", "a~b}c|d<e>"]
    df = candles(spark, *(hour(k, symbol=s) for k, s in enumerate(odd)), hour(0, symbol=None))
    lake.with_partitions(df).write.partitionBy(*lake.CANDLE_SET.partitions).parquet(f"{tmp_path}/price/ohlcv")
    made = {os.path.relpath(d, tmp_path) for d, names, _ in os.walk(tmp_path) if not names}
    assert made == {r.path for r in lake.partition_path(df).collect()}


def serve_by_host(url, params, timeout):
    """Two hosts; each serves two hourly candles, whose close tells host and symbol."""
    close = {"http://a/k": 1.25, "http://b/c": 2.25}[url] + 0.5 * (params["symbol"] == "EF")
    return [wire(ms, close) for ms in (START, START + HOUR) if params["startTime"] <= ms <= params["endTime"]]


def test_declared_sources(spark):
    config = {
        "feed": {"base_url": "http://b", "candles": "/c", "limit": 10},
        "price": {"default_symbol": "ZZ", "default_exchange": "other"},
        "sources": {
            "spot": {"base_url": "http://a", "datasets": {"candles": "/k"}, "symbols": ["AB"], "limit": 5},
            "futures": {"exchange": "fut", "datasets": {"candles": "/c", "trades": "/t"}, "symbols": ["CD", "EF"]},
            "rates": {"market": "rates"},
        },
    }
    assert set(feed.sources(config)) == {"spot", "futures", "rates"} and set(feed.sources(config, "trades")) == {"futures"}
    assert feed.configured("candles", config, "spot") == {"base_url": "http://a", "endpoint": "/k", "limit": "5", "exchange": "spot", "symbol": "AB"}
    # of several symbols none is meant, nor the default one
    assert feed.configured("trades", config, "futures") == {"base_url": "http://b", "endpoint": "/t", "limit": "10", "exchange": "fut"}
    for source, dataset in (("spot", "trades"), ("rates", "candles"), ("none", "candles")):
        with pytest.raises(ConfigError, match="futures"):
            feed.configured(dataset, config, source)
    for wrong in ({"sources": ["spot"]}, {"sources": {"spot": "x"}}, {"sources": {"spot": {"datasets": ["candles"]}}}):
        with pytest.raises(ConfigError, match="mappings"):
            feed.sources(wrong)
    feed.register(spark)
    asked = {"interval": "1h", "start_ms": START, "end_ms": START + HOUR, "transport": "tests.test_lake_and_feed:serve_by_host"}
    got = feed.of_all_sources(spark, "candles", config, **asked).collect()
    assert sorted((r.exchange, r.symbol, r.close) for r in got) == [(e, s, c) for e, s, c in (("fut", "CD", 2.25), ("fut", "EF", 2.75), ("spot", "AB", 1.25)) for _ in range(2)]
    with pytest.raises(ConfigError, match="no declared source"):
        feed.of_all_sources(spark, "candles", {"sources": {}}, **asked)
    assert feed.sources()["demo_spot"]["symbols"] == ["BTCUSDT"]  # of config/config.yaml
