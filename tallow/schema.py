"""Table schemas, keys and timeframes."""

from __future__ import annotations

from importlib.resources import files
from importlib.resources.abc import Traversable
from pathlib import Path

from pyspark.sql import types as T


class SchemaError(ValueError):
    """A declaration of fields can't be used."""


def load_fields(path: str | Traversable) -> T.StructType:
    """The fields in a YAML file's ``fields``: name: {type, unit, nullable}; a field is nullable unless it says otherwise."""
    import yaml

    try:
        file = Path(path) if isinstance(path, str) else path
        declared = yaml.safe_load(file.read_text(encoding="utf-8"))["fields"]
        out = T.StructType()
        for name, given in declared.items():
            if unknown := given.keys() - {"type", "unit", "nullable"}:
                raise SchemaError(f"{path}: field {name} has unknown entries: {', '.join(sorted(unknown))}")
            out = out.add(name, KINDS[given["type"]], given.get("nullable", True), {"unit": given["unit"]} if "unit" in given else None)
        return out
    except (OSError, yaml.YAMLError, TypeError, KeyError, AttributeError) as e:
        raise SchemaError(f"{path} declares no fields, or one without a known type") from e


#: Types that a declaration may name.
KINDS = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType()}

_FILES = files("tallow") / "declarations"
#: As declared, with what must be there marked as such.
DECLARED_CANDLES, DECLARED_TRADES = load_fields(_FILES / "candles.yaml"), load_fields(_FILES / "trades.yaml")


def _readable(declared: T.StructType) -> T.StructType:
    """The fields for tables: whether values are there is the gate's to check, so that it can report them."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in declared])


CANDLES, TRADES = _readable(DECLARED_CANDLES), _readable(DECLARED_TRADES)


def drift(declared: T.StructType, found: T.StructType, ignore: tuple[str, ...] = ()) -> list[tuple[str, str, str | None, str | None]]:
    """Differences as (column, added | lost | retyped, declared type, found type), in the order of the columns; names count as they are written."""
    there = {f.name: f.dataType.simpleString() for f in found}
    wanted = {f.name: f.dataType.simpleString() for f in declared}
    out = [(c, "retyped" if c in there else "lost", kind, there.get(c)) for c, kind in wanted.items() if there.get(c) != kind and c not in ignore]
    return out + [(c, "added", None, kind) for c, kind in there.items() if c not in wanted and c not in ignore]


SERIES = ("exchange", "symbol", "timeframe")
CANDLE_KEY = (*SERIES, "open_time")
CANDLE_PARTITIONS = (*SERIES, "year", "month")
TRADE_KEY = ("exchange", "symbol", "agg_trade_id")
TRADE_PARTITIONS = ("exchange", "symbol", "year", "month", "day")

#: Names and fixed lengths. A week starts on Monday.
TIMEFRAMES = {"1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour", "4h": "4 hours", "1d": "1 day", "1w": "7 days"}
#: Windows count from the epoch, a Thursday.
OFFSETS = {"1w": "4 days"}


def interval_of(timeframe: str) -> str:
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {timeframe!r}; known are {', '.join(TIMEFRAMES)}")
    return TIMEFRAMES[timeframe]


_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}


def millis_of(timeframe: str) -> int:
    n, unit = interval_of(timeframe).split()
    return int(n) * _SECONDS[unit.rstrip("s")] * 1000
