"""A paginated candle feed as a Spark data source.

The candle grid is known beforehand, so a range of times splits into slices of as many candles as a page may hold;
each slice is an input partition that pages on its own. A sequential scan becomes a parallel one whose width is the
number of slices, capped by ``slices`` where the provider limits requests.

    feed.register(spark)
    feed.candles(spark, symbol="BTCUSDT", interval="1h", start_ms=..., end_ms=...)   # the rest from config/config.yaml

Trades have no grid: their range splits into slices of equal time, and a slice goes on by trade identifiers.
Streams of either take ``symbols``, several separated by commas, and fetch each symbol's slices in tasks.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from tallow.schema import CANDLES, OFFSETS, TRADES, millis_of
from tallow.settings import ConfigError, config_value, load_config
from tallow.shipping import ship
from tallow.sources.decode import WIRE

#: A page's most rows, and what a request asks for by default.
MOST, PAGE = 1000, 1000

Transport = Callable[[str, dict[str, Any], float], Any]


class SourceError(RuntimeError):
    """The feed gave no usable answer."""


def http_json(url: str, params: dict[str, Any], timeout: float) -> Any:
    """GET with query parameters; a JSON answer."""
    with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(params)}", timeout=timeout) as answer:
        return json.loads(answer.read())


class FeedClient:
    """Bounded pages of wire candles, with retries."""

    def __init__(self, url: str, transport: Transport = http_json, timeout: float = 30, attempts: int = 5, backoff: float = 2, sleep: Callable[[float], None] = time.sleep):
        self.url, self.transport, self.timeout = url, transport, timeout
        self.attempts, self.backoff, self.sleep = attempts, backoff, sleep

    def get(self, params: dict[str, Any]) -> Any:
        """The answer, tried again with linearly growing pauses; none after the last attempt."""
        cause: Exception | None = None
        for attempt in range(1, self.attempts + 1):
            try:
                return self.transport(self.url, params, self.timeout)
            except (OSError, ValueError) as e:
                cause = e
                if attempt < self.attempts:
                    self.sleep(self.backoff * attempt)
        raise SourceError(f"no answer from {self.url} in {self.attempts} attempts") from cause

    def page(self, symbol: str, interval: str, limit: int = PAGE, start_ms: int | None = None, end_ms: int | None = None) -> list[list]:
        """One page of at most ``limit`` rows."""
        if not 1 <= limit <= MOST:
            raise ValueError(f"limit must lie between 1 and {MOST}")
        params = {"symbol": symbol.upper(), "interval": interval, "limit": limit}
        params |= {k: v for k, v in (("startTime", start_ms), ("endTime", end_ms)) if v is not None}
        answer = self.get(params)
        if not isinstance(answer, list):
            raise SourceError("the feed's answer is no list of candles")
        return answer

    def scan(self, symbol: str, interval: str, start_ms: int, end_ms: int | None = None, limit: int = PAGE) -> Iterator[list]:
        """Rows of a range, page by page and in the order served; of rows of one open time the first.

        A page's rows may stand in any order: the largest time is where the next page starts. Ends with a short or
        empty page, or behind the end.
        """
        cursor = start_ms
        seen: set[int] = set()
        while end_ms is None or cursor <= end_ms:
            rows = self.page(symbol, interval, limit, cursor, end_ms)
            for row in rows:
                at = int(row[0])
                if at not in seen:
                    seen.add(at)
                    yield row
            if len(rows) < limit:
                return
            last = max(int(row[0]) for row in rows)
            if last + 1 <= cursor:
                raise SourceError("the feed's pages don't advance")
            cursor = last + 1

    def trades(self, symbol: str, start_ms: int, end_ms: int, limit: int = PAGE) -> Iterator[dict]:
        """Trades of a range of times: the first page by time, the others by the identifier behind the last one."""
        if not 1 <= limit <= MOST:
            raise ValueError(f"limit must lie between 1 and {MOST}")
        ask = {"startTime": start_ms, "endTime": end_ms}
        following = None
        while True:
            rows = self.get({"symbol": symbol.upper(), "limit": limit} | ask)
            if not isinstance(rows, list):
                raise SourceError("the feed's answer is no list of trades")
            fresh = sorted((r for r in rows if following is None or int(r["a"]) >= following), key=lambda r: int(r["a"]))
            yield from (r for i, r in enumerate(fresh) if start_ms <= int(r["T"]) <= end_ms and (i == 0 or r["a"] != fresh[i - 1]["a"]))
            if len(rows) < limit or any(int(r["T"]) > end_ms for r in rows):
                return
            if not fresh:
                raise SourceError("the feed's pages don't advance")
            following = int(fresh[-1]["a"]) + 1
            ask = {"fromId": following}


def _moment(ms: Any) -> datetime:
    return datetime.fromtimestamp(int(ms) / 1000, UTC)


def typed_row(row: list, symbol: str, timeframe: str, exchange: str, now: datetime) -> tuple:
    """A candle in the order of CANDLES."""
    if len(row) != len(WIRE):
        raise SourceError(f"a wire candle has {len(WIRE)} values, this one {len(row)}")
    v = dict(zip(WIRE, row, strict=True))
    numbers = {k: float(v[k]) for k in ("open", "high", "low", "close", "base_volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")}
    numbers |= {"open_time": _moment(v["open_time"]), "close_time": _moment(v["close_time"]), "trade_count": int(v["trade_count"])}
    numbers |= {"exchange": exchange, "symbol": symbol.upper(), "timeframe": timeframe, "ingested_at": now}
    return tuple(numbers[f] for f in CANDLES.fieldNames())


def typed_trade(row: dict, symbol: str, exchange: str, now: datetime) -> tuple:
    """A trade in the order of TRADES. Where the buyer was the maker, the aggressor sold."""
    price, quantity = float(row["p"]), float(row["q"])
    maker = bool(row["m"])
    return (exchange, symbol.upper(), int(row["a"]), _moment(row["T"]), price, quantity, price * quantity, int(row["f"]), int(row["l"]), maker, "sell" if maker else "buy", now)


class Slice(InputPartition):
    def __init__(self, start_ms: int, end_ms: int):
        self.start_ms, self.end_ms = start_ms, end_ms


class _Options:
    def __init__(self, options: dict[str, str], candles: bool = True):
        need = lambda k: options.get(k) or _missing(k)
        self.symbols = [s.strip().upper() for s in (options.get("symbols") or need("symbol")).split(",") if s.strip()]
        self.symbol, self.interval = self.symbols[0], need("interval") if candles else ""
        self.exchange = options.get("exchange", "demo")
        self.limit = int(options.get("limit", PAGE))
        self.step = millis_of(self.interval) if candles else 1
        #: Time that a slice of trades covers.
        self.slice_ms = int(options.get("slice_ms", 3_600_000))
        self.start_ms = int(options["start_ms"]) if "start_ms" in options else None
        self.end_ms = int(options["end_ms"]) if "end_ms" in options else None
        self.slices = int(options.get("slices", 256))
        self.url = options.get("base_url", "http://localhost:8080") + options.get("endpoint", "/candles" if candles else "/trades")
        self.transport, self.clock = options.get("transport", ""), options.get("clock", "")
        #: How long after its time a row may be served; a stream asks for it only then.
        self.lag_ms = int(options.get("lag_ms", 0))
        self.attempts, self.backoff, self.timeout = int(options.get("attempts", 5)), float(options.get("backoff", 2)), float(options.get("timeout", 30))
        if not 1 <= self.limit <= MOST:
            raise ValueError(f"limit must lie between 1 and {MOST}")

    def now_ms(self) -> int:
        return _named(self.clock)() if self.clock else int(time.time() * 1000)

    def client(self) -> FeedClient:
        transport: Transport = _named(self.transport) if self.transport else http_json
        return FeedClient(self.url, transport, self.timeout, self.attempts, self.backoff)


def _named(path: str) -> Callable:
    """What ``module:name`` names."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def _missing(option: str):
    raise ValueError(f"option {option} is missing")


def _millis(value: datetime) -> int:
    """Whole milliseconds of a time, rounded down; one without a zone is UTC."""
    return int((value if value.tzinfo else value.replace(tzinfo=UTC)).timestamp() * 1000 // 1)


class _RangeReader(DataSourceReader):
    """A range of times that filters on ``column`` narrow; Spark applies every filter again."""

    column = ""

    def __init__(self, options: _Options):
        self.o = options
        self.start_ms, self.end_ms = options.start_ms, options.end_ms

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            lo = hi = None
            if getattr(f, "attribute", None) == (self.column,):
                values = [v for v in (f.value if isinstance(f, In) else [getattr(f, "value", None)]) if isinstance(v, datetime)]
                if values and isinstance(f, (EqualTo, EqualNullSafe, In, GreaterThan, GreaterThanOrEqual)):
                    lo = min(map(_millis, values))
                if values and isinstance(f, (EqualTo, EqualNullSafe, In, LessThan, LessThanOrEqual)):
                    hi = max(map(_millis, values))
            if lo is not None:
                self.start_ms = lo if self.start_ms is None else max(self.start_ms, lo)
            if hi is not None:
                self.end_ms = hi if self.end_ms is None else min(self.end_ms, hi)
            yield f

    def width(self) -> int:
        """Time that a slice covers, before the number of slices is capped."""
        raise NotImplementedError

    def partitions(self) -> list[Slice]:
        if self.start_ms is None:
            raise ValueError(f"a scan needs start_ms, or a filter on {self.column}")
        end = self.end_ms if self.end_ms is not None else int(time.time() * 1000)
        if end < self.start_ms:
            return [Slice(0, -1)]
        count = min(self.o.slices, -(-(end - self.start_ms + 1) // self.width()))
        width = -(-(end - self.start_ms + 1) // count)
        width = -(-width // self.o.step) * self.o.step
        return [Slice(a, min(a + width - 1, end)) for a in range(self.start_ms, end + 1, width)]


class CandleReader(_RangeReader):
    column = "open_time"

    def width(self) -> int:
        return self.o.step * self.o.limit

    def read(self, partition: Slice) -> Iterator[tuple]:
        if partition.end_ms < partition.start_ms:
            return
        now = datetime.now(UTC)
        for row in self.o.client().scan(self.o.symbol, self.o.interval, partition.start_ms, partition.end_ms, self.o.limit):
            yield typed_row(row, self.o.symbol, self.o.interval, self.o.exchange, now)


class TradeReader(_RangeReader):
    column = "timestamp"

    def width(self) -> int:
        return self.o.slice_ms

    def read(self, partition: Slice) -> Iterator[tuple]:
        if partition.end_ms < partition.start_ms:
            return
        now = datetime.now(UTC)
        for row in self.o.client().trades(self.o.symbol, partition.start_ms, partition.end_ms, self.o.limit):
            yield typed_trade(row, self.o.symbol, self.o.exchange, now)


class SymbolSlice(Slice):
    def __init__(self, symbol: str, start_ms: int, end_ms: int):
        super().__init__(start_ms, end_ms)
        self.symbol = symbol


class _Tail(DataSourceStreamReader):
    """Follows a feed: the offset holds, for each symbol, the time to ask for next.

    The driver moves offsets by the clock alone and asks for nothing; what lies between two offsets is split by symbol and
    time into input partitions, which tasks fetch. A batch planned before a restart is fetched again as it was planned.
    """

    #: Time at which a row of a time below it is final.
    def final_below(self, now_ms: int) -> int:
        raise NotImplementedError

    def width(self) -> int:
        raise NotImplementedError

    def __init__(self, options: _Options):
        if options.start_ms is None:
            _missing("start_ms")
        self.o = options

    def initialOffset(self) -> dict:
        return {s: self.o.start_ms for s in self.o.symbols}

    def latestOffset(self) -> dict:
        end = max(self.final_below(self.o.now_ms() - self.o.lag_ms), self.o.start_ms)
        return {s: end for s in self.o.symbols}

    def partitions(self, start: dict, end: dict) -> list[SymbolSlice]:
        out = []
        for symbol, stop in end.items():
            first = start.get(symbol, self.o.start_ms)
            if stop <= first:
                continue
            count = min(self.o.slices, -(-(stop - first) // self.width()))
            width = -(-(stop - first) // count)
            width = -(-width // self.o.step) * self.o.step
            out += [SymbolSlice(symbol, a, min(a + width, stop) - 1) for a in range(first, stop, width)]
        return out

    def commit(self, end: dict) -> None:
        pass


class CandleTail(_Tail):
    """A candle comes once its close time has passed."""

    def final_below(self, now_ms: int) -> int:
        shift = millis_of("1d") * int(OFFSETS[self.o.interval].split()[0]) if self.o.interval in OFFSETS else 0
        return (now_ms - shift) // self.o.step * self.o.step + shift

    def width(self) -> int:
        return self.o.step * self.o.limit

    def read(self, partition: SymbolSlice) -> Iterator[tuple]:
        now = datetime.now(UTC)
        for row in self.o.client().scan(partition.symbol, self.o.interval, partition.start_ms, partition.end_ms, self.o.limit):
            yield typed_row(row, partition.symbol, self.o.interval, self.o.exchange, now)


class TradeTail(_Tail):
    """Trades up to the clock's time, less ``lag_ms``."""

    def final_below(self, now_ms: int) -> int:
        return now_ms

    def width(self) -> int:
        return self.o.slice_ms

    def read(self, partition: SymbolSlice) -> Iterator[tuple]:
        now = datetime.now(UTC)
        for row in self.o.client().trades(partition.symbol, partition.start_ms, partition.end_ms, self.o.limit):
            yield typed_trade(row, partition.symbol, self.o.exchange, now)


class CandleFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "candle_feed"

    def schema(self):
        # units are dropped: Spark's streaming runner compares schemas with their metadata, which Arrow doesn't carry
        return T.StructType([T.StructField(f.name, f.dataType) for f in CANDLES])

    def reader(self, schema) -> CandleReader:
        return CandleReader(_Options(dict(self.options)))

    def streamReader(self, schema) -> CandleTail:
        return CandleTail(_Options(dict(self.options)))


class TradeFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "trade_feed"

    def schema(self):
        return T.StructType([T.StructField(f.name, f.dataType) for f in TRADES])

    def reader(self, schema) -> TradeReader:
        return TradeReader(_Options(dict(self.options), candles=False))

    def streamReader(self, schema) -> TradeTail:
        return TradeTail(_Options(dict(self.options), candles=False))


def register(spark: SparkSession) -> None:
    """Makes ``format("candle_feed")`` and ``format("trade_feed")`` known to the session, and lets filters reach them."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (CandleFeed, TradeFeed):
        spark.dataSource.register(source)


def sources(config: dict[str, Any] | None = None, dataset: str | None = None) -> dict[str, dict[str, Any]]:
    """The declared sources by name, or those that have the dataset."""
    declared = config_value(load_config() if config is None else config, "sources") or {}
    if not isinstance(declared, dict) or not all(isinstance(x, dict) and isinstance(x.get("datasets") or {}, dict) for x in declared.values()):
        raise ConfigError("sources must map names to mappings, and datasets of a source to paths")
    return {name: x for name, x in declared.items() if dataset is None or dataset in (x.get("datasets") or {})}


def _declared(source: str, dataset: str, config: dict[str, Any]) -> dict[str, Any]:
    """The options that a declared source gives; the symbol only where it has one, as a scan reads one."""
    found = sources(config, dataset).get(source)
    if found is None:
        raise ConfigError(f"no source {source!r} with {dataset}; those declared are {', '.join(sorted(sources(config, dataset))) or 'none'}")
    symbols = found.get("symbols") or []
    given = {k: found.get(k) for k in ("base_url", "limit")} | {"endpoint": found["datasets"][dataset], "exchange": found.get("exchange", source)}
    return {k: v for k, v in given.items() if v is not None} | {"symbol": symbols[0] if len(symbols) == 1 else None}


def configured(dataset: str, config: dict[str, Any] | None = None, source: str | None = None) -> dict[str, str]:
    """The options of a feed, candles or trades, that the configuration gives; those of a declared source go first."""
    config = load_config() if config is None else config
    keys = {
        "base_url": "feed.base_url",
        "endpoint": f"feed.{dataset}",
        "limit": "feed.limit",
        "timeout": "feed.timeout_seconds",
        "attempts": "feed.max_attempts",
        "backoff": "feed.backoff_seconds",
        "exchange": "price.default_exchange",
        "symbol": "price.default_symbol",
    }
    found = {option: config_value(config, path) for option, path in keys.items()}
    found |= _declared(source, dataset, config) if source else {}
    return {option: str(value) for option, value in found.items() if value is not None}


def candles(spark: SparkSession, config: dict[str, Any] | None = None, source: str | None = None, **options) -> DataFrame:
    """Candles of the configured feed, or of a declared source; options go before the configuration."""
    return spark.read.format("candle_feed").options(**configured("candles", config, source) | options).load()


def trades(spark: SparkSession, config: dict[str, Any] | None = None, source: str | None = None, **options) -> DataFrame:
    """Trades of the configured feed, or of a declared source; options go before the configuration."""
    return spark.read.format("trade_feed").options(**configured("trades", config, source) | options).load()


def of_all_sources(spark: SparkSession, dataset: str, config: dict[str, Any] | None = None, **options) -> DataFrame:
    """Candles or trades of every symbol of every declared source that has them, as one frame."""
    scan = {"candles": candles, "trades": trades}[dataset]
    scans = [scan(spark, config, name, **options | {"symbol": symbol}) for name, x in sources(config, dataset).items() for symbol in x.get("symbols") or []]
    if not scans:
        raise ConfigError(f"no declared source has symbols for {dataset}")
    return reduce(DataFrame.unionByName, scans)
