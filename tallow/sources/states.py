"""Statistics that follow the lake: partial states of each partition, renewed by its upsert and merged on reading.

A state is an aggregate whose parts merge. An upsert computes it for the partitions that it replaces, from the rows that
it has just merged, and replaces their parts in a table beside the data that is partitioned in the same way. An answer
merges the parts, so it reads a row or a few for each partition and none of the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallow.schema import SERIES


@dataclass(frozen=True)
class State:
    """``parts`` aggregate a partition's rows by ``keys``; ``merges`` put parts together by ``groups``.

    keys are named expressions, parts and merges named aggregates; groups may be partition columns and keys.
    """

    name: str
    groups: tuple[str, ...]
    parts: dict[str, Column]
    merges: dict[str, Column]
    keys: tuple[Column, ...] = ()


def extent(time: str = "open_time", groups: tuple[str, ...] = SERIES) -> State:
    """First and last time and number of rows of each series, or of each market of trades."""
    names = {"open_time": ("first_open_time", "last_open_time", "candle_count")}.get(time, (f"first_{time}", f"last_{time}", "row_count"))
    parts = dict(zip(names, (F.min(time), F.max(time), F.count(F.lit(1))), strict=True))
    return State(f"extent-{time}", groups, parts, dict(zip(names, (F.min(names[0]), F.max(names[1]), F.sum(names[2])), strict=True)))


def profile(bin_size: float) -> State:
    """Traded quantity at each price bin of a market."""
    price_bin = (F.floor(F.col("price") / bin_size) * bin_size).cast("double").alias("price_bin")
    return State(f"profile-{bin_size:g}", ("exchange", "symbol", "price_bin"), {"volume": F.sum("quantity")}, {"volume": F.sum("volume")}, (price_bin,))


def _path(root: str, state: State) -> str:
    # readers of the lake skip what starts with an underscore
    return f"{root.rstrip('/')}/_states/{state.name}"


def _named(aggregates: dict[str, Column]) -> list[Column]:
    return [a.alias(name) for name, a in aggregates.items()]


def renew(rows: DataFrame, root: str, partitions: Sequence[str], states: Sequence[State]) -> None:
    """Replaces the parts of the partitions that rows hold whole."""
    for state in states:
        parts = rows.groupBy(*partitions, *state.keys).agg(*_named(state.parts))
        parts.write.partitionBy(*partitions).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(_path(root, state))


def read_state(spark: SparkSession, root: str, state: State) -> DataFrame:
    """The state of the whole lake; filters on partition columns that are groups prune its parts."""
    # partition values stay strings, as in the lake
    own = spark.read.option("basePath", _path(root, state)).option("mergeSchema", "false")
    found = own.schema(_schema(spark, root, state)).parquet(_path(root, state))
    return found.groupBy(*state.groups).agg(*_named(state.merges))


def _schema(spark: SparkSession, root: str, state: State) -> T.StructType:
    inferred = spark.read.parquet(_path(root, state))
    path = inferred.inputFiles()[0].split("/_states/", 1)[1]
    partitions = [p.split("=", 1)[0] for p in path.split("/")[1:-1]]
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in partitions else f.dataType) for f in inferred.schema])
