"""Holes filled from a feed, and alerts for silent series."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallow.operators import gaps
from tallow.schema import CANDLES, DECLARED_CANDLES, SchemaError, load_fields
from tallow.sources import backfill, lake, states
from tallow.streaming import alerts, gate
from tests.test_lake_and_feed import HOUR, START, wire
from tests.test_quality import candles, hour


def serve_noted(url, params, timeout):
    """Every hourly candle of 40 days; notes each request."""
    with open(url.removeprefix("note:").split("/candles")[0], "a") as note:
        note.write(f"{params['symbol']} {params['startTime']} {params['endTime']}\n")
    first = -(-(params["startTime"] - START) // HOUR)
    return [wire(START + k * HOUR) for k in range(first, min((params["endTime"] - START) // HOUR, 959) + 1)][: params["limit"]]


def test_fill(spark, tmp_path):
    root, note = str(tmp_path / "lake"), tmp_path / "note"
    note.touch()
    there = [k for k in range(600) if not 100 <= k < 350 and k % 7 != 3]
    lake.upsert_candles(candles(spark, *(hour(k) for k in there), *(hour(k, symbol="B") for k in (0, 1, 2))), root)
    options = {"base_url": f"note:{note}", "transport": "tests.test_filling:serve_noted", "limit": 50, "width": 3}
    done = backfill.fill(spark, "1h", root, **options)
    assert [r.row_count for r in done.filter("symbol = 'BTCUSDT'").orderBy("month").collect()] == [600]
    asked = [line.split() for line in note.read_text().splitlines()]
    # 600 slots are 12 or 13 pages; 83 single holes share theirs
    assert len(asked) == len(set(map(tuple, asked))) <= 13 and {s for s, _, _ in asked} == {"BTCUSDT"}
    rows = lake.read_candles(spark, root)
    assert gaps.gap_ranges(rows, "1h").count() == 0
    before = {r.open_time: r.close for r in rows.filter("symbol = 'BTCUSDT'").collect()}
    assert len(before) == 600 and before[hour(0)["open_time"]] == 90500.0 and before[hour(100)["open_time"]] == 2.0
    backfill.fill(spark, "1h", root, **options)
    assert len(note.read_text().splitlines()) == len(asked)  # nothing is missing
    # up to a time, for both series
    until = START + 700 * HOUR + HOUR // 2
    backfill.fill(spark, "1h", root, until_ms=until, **options)
    assert {r.symbol: r.candle_count for r in gaps.series_extent(lake.read_candles(spark, root)).collect()} == {"BTCUSDT": 700, "B": 700}
    asked = len(note.read_text().splitlines())
    backfill.fill(spark, "1h", root, until_ms=until, **options)
    assert len(note.read_text().splitlines()) == asked


def test_requests_are_pages(spark):
    ranges = spark.createDataFrame([("e", "s", "1h", START + a * HOUR, START + b * HOUR) for a, b in ((1, 1), (3, 3), (90, 420))], "exchange string, symbol string, timeframe string, start_ms long, end_ms long")
    rows = sorted((r.start_ms - START) // HOUR for r in backfill.requests(ranges, "1h", 100).collect())
    got = backfill.requests(ranges, "1h", 100).collect()
    assert all((r.end_ms - r.start_ms) // HOUR < 100 for r in got) and sum(r.slots for r in got) == 333 and len(rows) <= 6
    assert all(r.start_ms % HOUR == 0 for r in got)


STORE = "spark.sql.streaming.stateStore.providerClass"


def test_alerts(spark, tmp_path):
    """An alert, a late candle that cancels one, a restart in between, and the same rows from the table."""
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def arrive(*hours, symbol="A"):
        candles(spark, *(hour(k, symbol=symbol) for k in hours)).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        stream = spark.readStream.schema(candles(spark).schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        found = alerts.silent_series(stream, "1h", patience=2, lateness="4 hours")
        query = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
        return {(r.symbol, r.last_open_time.hour, r.due_time.hour) for r in spark.read.parquet(out).collect()} if os.path.isdir(out) and any(f.endswith(".parquet") for f in os.listdir(out)) else set()

    try:
        arrive(0, 1, 2)
        arrive(0, symbol="B")
        arrive(6)  # A misses 3 to 5; the watermark stands at 2
        assert run() == {("B", 0, 2)} or run() == set()
        arrive(4)  # late, but in time: A is silent neither from 2 nor from 4 on
        arrive(8, 10)
        got = run()
        assert ("A", 2, 4) not in got and ("B", 0, 2) in got
        arrive(13)
        arrive(16, 18, 20, 22)
        got = run()
        table = spark.read.parquet(str(source))
        batch = {(r.symbol, r.last_open_time.hour, r.due_time.hour) for r in alerts.silent_ranges(table, "1h", 2).collect()}
        assert got <= batch and ("A", 10, 12) in got and ("A", 13, 15) in got
        # the table's watermark has no delay
        assert all(due > 22 - 4 for _, _, due in batch - got)
    finally:
        spark.conf.unset(STORE)


def test_alerts_of_a_table(spark):
    df = candles(spark, *(hour(k) for k in (0, 1, 4, 4, 9)), hour(8, symbol="B"), hour(2, symbol="C"))
    got = {(r.symbol, r.last_open_time, r.due_time) for r in alerts.silent_ranges(df, "1h", 2).collect()}
    at = lambda k: datetime(2026, 1, 1) + timedelta(hours=k)
    assert got == {("BTCUSDT", at(1), at(3)), ("BTCUSDT", at(4), at(6)), ("C", at(2), at(4))}
    assert alerts.silent_ranges(df.filter(F.lit(False)), "1h").count() == 0


def test_states_follow_the_lake(spark, tmp_path):
    """After an upsert of one partition the answer holds, and no other partition has been read."""
    root, state = str(tmp_path / "lake"), states.extent()
    lake.upsert_candles(candles(spark, *(hour(k) for k in (1, 2, 800, 801)), hour(5, symbol="1e5")), root, states=[state])
    whole = lambda: sorted(map(tuple, gaps.series_extent(lake.read_candles(spark, root)).collect()))
    answer = lambda: sorted(map(tuple, states.read_state(spark, root, state).collect()))
    assert answer() == whole() and len(answer()) == 2
    february = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if "month=02" in d and f.endswith(".parquet") and "_states" not in d]
    kept = {f: open(f, "rb").read() for f in february}
    for f in february:
        with open(f, "wb") as broken:
            broken.write(b"not to be read")
    lake.upsert_candles(candles(spark, hour(0), hour(2, close=90100.0)), root, states=[state])
    got = answer()
    for f, data in kept.items():
        with open(f, "wb") as whole_again:
            whole_again.write(data)
        os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
    assert got == whole() and [r[5] for r in got if r[1] == "BTCUSDT"] == [5]
    lake.upsert_candles(candles(spark, hour(900)), root)  # without its state
    assert answer() != whole()
    lake.rebuild_states(spark, root, [state])
    assert answer() == whole()


def test_gate_of_a_stream(spark, tmp_path):
    """Good rows, bad rows and counts, and the last batch replayed after a lost commit."""
    source, root, bad = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "bad")
    source.mkdir()
    seen = []

    def run():
        stream = spark.readStream.schema(candles(spark).schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        gate.gated_stream(stream, root, bad, str(tmp_path / "checkpoint"), listener=lambda k, counts: seen.append((k, counts))).awaitTermination()
        rows = sorted((r.symbol, r.open_time.hour, r.close) for r in lake.read_candles(spark, root).collect())
        return rows, sorted((r.open_time.hour, tuple(r.broken)) for r in spark.read.parquet(bad).collect())

    candles(spark, hour(0), hour(1, close=None), hour(2)).coalesce(1).write.mode("append").parquet(str(source))
    run()
    candles(spark, hour(2, close=90100.0), hour(2, close=90100.0), hour(3, high=1.0), hour(4, base_volume=-1.0)).coalesce(1).write.mode("append").parquet(str(source))
    first = run()
    assert first[0] == [("BTCUSDT", 0, 90500.0), ("BTCUSDT", 2, 90100.0)]
    assert [h for h, _ in first[1]] == [1, 3, 4] and first[1][0][1] == ("missing_values",) and first[1][2][1] == ("negative_values",)
    assert [(k, c["rows"], c["quarantined"], c["missing_values"]) for k, c in seen] == [(0, 3, 1, 1), (1, 4, 2, 0)]
    for lost in ("1", ".1.crc"):
        os.remove(tmp_path / "checkpoint" / "commits" / lost)
    assert run() == first and [k for k, _ in seen] == [0, 1, 1]


def test_declared_schemas_and_drift(spark, tmp_path):
    assert CANDLES["close"].metadata == {"unit": "quote_currency"} and not DECLARED_CANDLES["close"].nullable and CANDLES["close"].nullable
    root = str(tmp_path / "lake")
    lake.upsert_candles(candles(spark, hour(1)), root)
    assert lake.schema_drift(spark, root).count() == 0
    leaf = str(tmp_path / "leaf")
    candles(spark).drop("close").withColumn("trade_count", F.lit("7")).withColumn("spread", F.lit(1.0)).write.parquet(leaf)
    got = {tuple(r) for r in lake.schema_drift(spark, root, leaf=leaf).collect()}
    assert got == {("close", "lost", "double", None), ("trade_count", "retyped", "bigint", "string"), ("spread", "added", None, "double")}
    for text in ("a: 1", "fields: {a: {type: money}}", "fields: {a: {type: long, units: x}}", "fields: [a]", "a: ["):
        (tmp_path / "d.yaml").write_text(text)
        with pytest.raises(SchemaError):
            load_fields(str(tmp_path / "d.yaml"))
    (tmp_path / "d.yaml").write_text("fields: {a: {type: long, unit: count}, b: {type: date, nullable: false}}")
    assert load_fields(str(tmp_path / "d.yaml")).simpleString() == "struct<a:bigint,b:date>"
