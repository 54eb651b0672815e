"""Windows by stretches, holes, and what is built on them, against plain Python."""

from __future__ import annotations

import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallow.functions import derived, structure
from tallow.operators import gaps, halo
from tallow.plans import catalog
from tallow.schema import SERIES
from tests.conftest import SF
from tests.test_quality import candles, hour


def wild(spark, n=90, seed=4):
    """Two series with pauses of many stretches and none at all."""
    rng, rows, at = random.Random(seed), [], 0
    for k in range(n):
        at += rng.choice([1, 1, 1, 2, 9, 60])
        close, spread = 90500.0 + rng.randrange(-400, 400), rng.randrange(500, 900)
        rows.append(hour(at, symbol="AB"[k % 2], close=close, open=close, high=close + spread, low=close - spread))
    return candles(spark, *rows)


@pytest.mark.parametrize("stretch", [1, 3, 16, 4096])
def test_stretches_change_nothing(spark, monkeypatch, stretch):
    monkeypatch.setattr(halo, "STRETCH", stretch)
    df, plain = wild(spark), Window.partitionBy(*SERIES).orderBy("open_time")
    rows = df.withColumns(
        {
            "log_return": F.ln(F.col("close") / F.lag("close").over(plain)),
            "true_range": F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.lag("close").over(plain)), F.abs(F.col("low") - F.lag("close").over(plain))),
            "top": F.col("high") > F.greatest(*(F.lag("high", k).over(plain) for k in (-2, -1, 1, 2))),
            "inner": F.lag("high", 2).over(plain).isNotNull() & F.lead("high", 2).over(plain).isNotNull(),
        }
    )
    rows = rows.withColumns({"deviation": F.stddev_samp("log_return").over(plain.rowsBetween(-4, 0)), "mean": F.avg("true_range").over(plain.rowsBetween(-5, 0))})
    want = {(r.symbol, r.open_time): r for r in rows.collect()}
    close = lambda a, b: a is b is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-15)
    got = derived.price_volatility(df, 5).collect()
    assert len(got) == len(want) and all(close(r.rolling_volatility, want[r.symbol, r.open_time].deviation) for r in got)
    got = derived.price_range_atr(df, 6).collect()
    assert len(got) == len(want) and all(close(r.atr, want[r.symbol, r.open_time].mean) for r in got)
    assert all(close(r.log_return, want[r.symbol, r.open_time].log_return) for r in derived.price_returns(df).collect())
    swings = derived.swing_points(df).collect()
    assert {(r.symbol, r.open_time) for r in swings if r.kind == "high"} == {k for k, r in want.items() if r.top and r.inner}
    highs = sorted((r for r in swings if r.kind == "high" and r.symbol == "A"), key=lambda r: r.open_time)
    for before, r in zip(highs, highs[1:], strict=False):
        assert r.structure == ("HH" if r.price > before.price else "LH" if r.price < before.price else "EQ")
    assert highs[0].structure is None


def test_running_values_start_anew_in_stretches(spark, monkeypatch):
    df = wild(spark)
    lost = df.withColumn("exchange", F.when(F.col("symbol") == "A", F.col("exchange")))  # a null key is one, too
    plain = Window.partitionBy(*SERIES).orderBy("open_time")
    smooth = {(r.symbol, r.open_time): r.atr for r in derived.wilder_atr(df, 5).collect()}
    for stretch in (1, 5, 4096):
        monkeypatch.setattr(halo, "STRETCH", stretch)
        for rows in (df, lost):
            want = rows.withColumns({"place": F.row_number().over(plain) - 1})
            got = halo.numbered(rows, "place").collect()
            assert sorted((r.symbol, r.open_time, r.place) for r in got) == sorted((r.symbol, r.open_time, r.place) for r in want.collect())
            again = {(r.symbol, r.open_time): r.atr for r in derived.wilder_atr(rows, 5).collect()}
            assert again.keys() == smooth.keys() and all(math.isclose(again[k], smooth[k], rel_tol=1e-9) for k in smooth)
        trades = df.select("exchange", "symbol", F.col("open_time").alias("timestamp"), F.col("close").alias("price"), (F.col("close") / 7).alias("quantity"))
        trades = trades.withColumn("trade_side", F.when(F.col("price") > 90500, "buy").otherwise("sell"))
        flow = sorted(derived.orderflow_delta(trades).collect(), key=lambda r: (r.symbol, r.open_time))
        running: dict[str, float] = {}
        for r in flow:
            running[r.symbol] = running.get(r.symbol, 0.0) + r.delta
            assert math.isclose(r.cumulative_delta, running[r.symbol], rel_tol=1e-9, abs_tol=1e-6)
        assert len(flow) == trades.count()
    # a window without a stretch among its keys goes over stretches, not over rows
    plan = derived.wilder_atr(df, 5)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("stretch" in line.rsplit("], [", 2)[-2] or "stretch" in line.rsplit("], [", 2)[-1] for line in windows)


def test_no_window_over_a_whole_series(spark):
    from tests.plans import window_keys

    df = catalog.hourly(spark, SF)
    for made in (derived.price_returns(df), derived.price_volatility(df), derived.price_range_atr(df), derived.swing_points(df), gaps.find_time_gaps(df, "1h")):
        keys = window_keys(made)
        assert keys and all("_stretch" in k for k in keys)


@pytest.mark.parametrize("stretch", [1, 4, 4096])
def test_holes(spark, monkeypatch, stretch):
    monkeypatch.setattr(halo, "STRETCH", stretch)
    monkeypatch.setattr(gaps, "SLOTS", 7)
    df = wild(spark)
    # off the grid, one of them last; repeated rows; a series of one candle
    last = max(r.open_time for r in df.collect())
    late = candles(spark, {**hour(0), "symbol": "A", "open_time": last + timedelta(hours=5, seconds=9)}, {**hour(3), "symbol": "A", "open_time": hour(30)["open_time"] + timedelta(seconds=1)}, hour(5, symbol="C"), hour(5, symbol=None), hour(7, symbol=None))
    df = df.unionByName(df.limit(20)).unionByName(late)
    want = {}
    rows = [(r.symbol, r.open_time) for r in df.collect()]
    for symbol in {s for s, _ in rows}:
        times = {t for s, t in rows if s == symbol}
        grid, at = [], min(times)
        while at <= max(times):
            grid.append(at)
            at += timedelta(hours=1)
        want[symbol] = [t for t in grid if t not in times]
    found = gaps.find_time_gaps(df, "1h").collect()
    assert sorted(((str(r.symbol), r.missing_open_time) for r in found)) == sorted((str(s), t) for s, ts in want.items() for t in ts)
    ranges = gaps.gap_ranges(df, "1h").collect()
    assert sum(r.missing_count for r in ranges) == len(found) and {r.symbol: r.gap_count for r in gaps.gap_counts(df, "1h").collect()} == {s: len(t) for s, t in want.items() if t}
    starts = {(r.symbol, r.from_time) for r in ranges}
    assert all((r.symbol, r.to_time + timedelta(hours=1)) not in starts for r in ranges)
    assert gaps.time_grid(df, "1h").count() == len(found) + sum(len({t for t in ts if t not in want[s]} & {t for t in ts}) for s, ts in on_grid(rows).items())


def on_grid(rows):
    out = {}
    for symbol in {s for s, _ in rows}:
        times = {t for s, t in rows if s == symbol}
        out[symbol] = {t for t in times if (t - min(times)) % timedelta(hours=1) == timedelta(0)}
    return out


def test_holes_need_no_grid(spark):
    shown = gaps.gap_ranges(catalog.hourly(spark, SF), "1h")._jdf.queryExecution().executedPlan().toString()
    assert "sequence" not in shown


def test_structure_in_any_stretches(spark, monkeypatch):
    df = wild(spark, 240, seed=9)
    rows = {}
    for stretch in (3, 40, 4096):
        monkeypatch.setattr(halo, "STRETCH", stretch)
        rows[stretch] = sorted(structure.market_structure(df).collect())
    assert rows[3] == rows[40] == rows[4096] and len({r.trend_after for r in rows[3]}) == 5
    # the same machine, swing by swing
    for symbol in "AB":
        state = "none"
        for r in sorted((r for r in rows[3] if r.symbol == symbol), key=lambda r: (r.open_time, r.kind)):
            assert r.trend_before == state
            state = structure.TABLES[r.structure][structure.STATES.index(state)] if r.structure in structure.TABLES else state
            assert r.trend_after == state
    broken = structure.structure_breaks(df).collect()
    assert {(r.trend_before, r.trend_after, r.direction) for r in broken} == {("down_weak", "up", "up"), ("up_weak", "down", "down")}
    assert structure.market_structure(df.limit(0)).count() == 0


def test_value_area(spark):
    def area(volumes, share=0.7):
        rows = [("e", "s", 10.0 * k + 1, float(v)) for k, v in enumerate(volumes) if v is not None]
        return derived.value_area(spark.createDataFrame(rows, "exchange string, symbol string, price double, quantity double"), 10.0, share).first()

    # 10 of 30, then the neighbours 6, 5 and 4; the far bin of 5 is left out
    assert area([5, 0, 4, 10, 6, 5])[2:6] == (30.0, 30.0, 50.0, 21.0)
    assert area([3, 9, 3, 9])[2:6] == (10.0, 0.0, 30.0, 24.0)  # the lowest point of control, ties to the lower side
    assert area([1, None, 1], 0.9)[2:6] == (0.0, 0.0, 20.0, 2.0)  # a bin without a trade
    assert area([7])[2:] == (0.0, 0.0, 0.0, 7.0, 1.0)
    assert area([0, 0])[5] == 0.0
