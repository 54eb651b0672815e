"""The lake of candles and trades: hive-partitioned Parquet with idempotent upserts.

Partition values are read with a stated schema: inferred ones would turn a lone timeframe=1d into a double and
month=07 into a number, after which a write would make a second directory for the same month.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallow.operators.dedupe import keep_last, merge_latest
from tallow.operators.quality import CANDLE_RULES, TRADE_RULES, enforce
from tallow.schema import CANDLE_KEY, CANDLE_PARTITIONS, CANDLES, TRADE_KEY, TRADE_PARTITIONS, TRADES, drift
from tallow.settings import config_value, load_config
from tallow.sources import files
from tallow.sources.files import NO_VALUE, UNSAFE
from tallow.sources.states import State, renew


class LakeError(RuntimeError):
    """An upsert stopped half-way; the message says where its rows are kept."""


@dataclass(frozen=True)
class Dataset:
    """How a table lies in the lake."""

    path: str
    schema: T.StructType
    key: tuple[str, ...]
    partitions: tuple[str, ...]
    time: str
    rules: dict[str, Any]


CANDLE_SET = Dataset("price/ohlcv", CANDLES, CANDLE_KEY, CANDLE_PARTITIONS, "open_time", CANDLE_RULES)
TRADE_SET = Dataset("price/agg_trades", TRADES, TRADE_KEY, TRADE_PARTITIONS, "timestamp", TRADE_RULES)
_PARTS = {"year": "yyyy", "month": "MM", "day": "dd"}


def configured_root(dataset: Dataset = CANDLE_SET, config: dict[str, Any] | None = None) -> str:
    """The dataset's folder below the configured one for raw data."""
    config = load_config() if config is None else config
    return f"{str(config_value(config, 'paths.raw', 'data/raw')).rstrip('/')}/{dataset.path}"


def _stored_schema(schema: T.StructType, partitions: tuple[str, ...]) -> T.StructType:
    body = [f for f in schema if f.name not in partitions]
    return T.StructType([*body, *(T.StructField(p, T.StringType()) for p in partitions)])


def with_partitions(df: DataFrame, dataset: Dataset = CANDLE_SET) -> DataFrame:
    """The parts of the time that name partitions, as strings of fixed width."""
    return df.withColumns({p: F.date_format(dataset.time, _PARTS[p]) for p in dataset.partitions if p in _PARTS})


def escaped(value: Column) -> Column:
    """A partition value as the writer names its folder."""
    sign = lambda c: F.when(c.rlike(UNSAFE), F.concat(F.lit("%"), F.lpad(F.hex(c), 2, "0"))).otherwise(c)
    shown = F.when(value.rlike(UNSAFE), F.array_join(F.transform(F.split(value, ""), sign), "")).otherwise(value)
    return F.coalesce(F.nullif(shown, F.lit("")), F.lit(NO_VALUE))


def partition_path(df: DataFrame, dataset: Dataset = CANDLE_SET) -> DataFrame:
    """Distinct partitions with their directory below the lake's root."""
    keys = with_partitions(df, dataset).select(*dataset.partitions).distinct()
    parts = [F.concat(F.lit(f"{c}="), escaped(F.col(c))) for c in dataset.partitions]
    return keys.withColumn("path", F.concat_ws("/", F.lit(dataset.path), *parts))


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read(spark: SparkSession, root: str, dataset: Dataset = CANDLE_SET) -> DataFrame:
    """All rows of a lake; an absent one is empty. Filters on partition columns prune directories."""
    schema = _stored_schema(dataset.schema, dataset.partitions)
    if not _exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


def read_candles(spark: SparkSession, root: str | None = None) -> DataFrame:
    return read(spark, root or configured_root(CANDLE_SET), CANDLE_SET)


def read_trades(spark: SparkSession, root: str | None = None) -> DataFrame:
    return read(spark, root or configured_root(TRADE_SET), TRADE_SET)


def schema_drift(spark: SparkSession, root: str, dataset: Dataset = CANDLE_SET, leaf: str | None = None) -> DataFrame:
    """Rows (column, change, declared, found) of what a stored file's footer has otherwise than the declaration: added, lost, retyped.

    It looks at a file of the lake, or of the folder ``leaf``; partition columns lie in paths and aren't compared.
    """
    found = spark.read.parquet(leaf or root).schema
    return spark.createDataFrame(drift(dataset.schema, found, (*dataset.partitions, *_PARTS)), "column string, change string, declared string, found string")


def read_nanosecond_leaf(spark: SparkSession, path: str) -> DataFrame:
    """Files whose times are nanoseconds, which Spark reads as integers only when told to: in a session of their own."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    raw = own.read.parquet(path)
    times = [f.name for f in CANDLES if isinstance(f.dataType, T.TimestampType)]
    return raw.withColumns({c: F.expr(f"timestamp_micros({c} div 1000)") for c in times if c in raw.columns and raw.schema[c].dataType == T.LongType()})


#: Values of a partition column up to which each is a condition of its own; of more, the range is.
PRUNED = 1000


def touched_only(df: DataFrame, touched: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """The rows of the partitions in ``touched``.

    Literal conditions on each column keep the others' directories out of the scan; there may be many partitions, so their
    combinations are a join whose kind Spark chooses.
    """
    values = {}
    extent = touched.agg(*(f(c).alias(f"{k}_{c}") for c in partitions for k, f in (("n", F.count_distinct), ("low", F.min), ("high", F.max)))).first()
    few = [c for c in partitions if extent[f"n_{c}"] <= PRUNED]
    if few:
        values = touched.agg(*(F.collect_set(c).alias(c) for c in few)).first().asDict()
    near = [F.col(c).isin(*sorted(values[c])) if c in values else F.col(c).between(extent[f"low_{c}"], extent[f"high_{c}"]) for c in partitions]
    return df.filter(reduce(lambda a, b: a & b, near)).join(touched.select(*partitions), list(partitions), "left_semi")


def upsert(new: DataFrame, root: str, dataset: Dataset = CANDLE_SET, allow_empty: bool = False, states: Sequence[State] = ()) -> DataFrame:
    """Merges rows into the lake and returns the partitions written, with their number of rows (a table kept in its ``_written``).

    The input is computed once, into a staging folder beside the lake, and what lies there is what gets checked and
    merged. Only partitions that it touches are read and replaced, after the merged rows
    passed the gate as well, and so are those partitions' parts of ``states``; replaying an input changes nothing. Nothing is lost where the replacement fails: the
    merged rows stay in the staging folder, which the LakeError names.
    """
    spark = new.sparkSession
    counts = _stored_schema(T.StructType([]), dataset.partitions).add("row_count", "long")
    staging = f"{root.rstrip('/')}-staging-{uuid.uuid4().hex}"
    try:
        rows = with_partitions(new.select(dataset.schema.fieldNames()), dataset)
        rows.write.parquet(f"{staging}/input")
        staged = spark.read.schema(rows.schema).parquet(f"{staging}/input")
        staged.select(*dataset.partitions).distinct().write.parquet(f"{staging}/touched")
        touched = spark.read.schema(_stored_schema(T.StructType([]), dataset.partitions)).parquet(f"{staging}/touched")
        if allow_empty and touched.isEmpty():
            _delete(spark, staging)
            return spark.createDataFrame([], counts)
        enforce(staged, declaration=dataset.rules)
        existing = touched_only(read(spark, root, dataset), touched, dataset.partitions).select(staged.columns)
        merge_latest(existing, staged, dataset.key).write.parquet(f"{staging}/merged")
        merged = spark.read.schema(rows.schema).parquet(f"{staging}/merged")
        enforce(merged, declaration=dataset.rules)
    except Exception:
        # the lake is as it was, and the input is the caller's
        _delete(spark, staging)
        raise
    try:
        _replace(merged, root, dataset)
        renew(merged, root, dataset.partitions, states)
    except Exception as e:
        raise LakeError(f"partitions of {root}, or their states, were not all replaced; the merged rows are kept in {staging}/merged") from e
    # below a folder that readers of the lake skip
    report = f"{root.rstrip('/')}/_written/{uuid.uuid4().hex}"
    merged.groupBy(*dataset.partitions).agg(F.count(F.lit(1)).alias("row_count")).write.parquet(report)
    _delete(spark, staging)
    return spark.read.schema(counts).parquet(report).orderBy(*dataset.partitions)


def _replace(merged: DataFrame, root: str, dataset: Dataset) -> None:
    (
        # a hot partition may become several tasks and files
        merged.hint("rebalance", *dataset.partitions)
        .sortWithinPartitions(*dataset.partitions, dataset.time)
        .write.partitionBy(*dataset.partitions)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(root)
    )


def append(new: DataFrame, root: str, dataset: Dataset = CANDLE_SET, replace: bool = False) -> DataFrame:
    """Adds rows that passed the gate, without looking at what the lake holds, and returns the partitions written as an upsert does.

    With ``replace`` the touched partitions hold the new rows alone. A failing write leaves no file. What lies there
    isn't merged and states aren't renewed: for rows that may be there already, use an upsert.
    """
    spark = new.sparkSession
    enforce(new, declaration=dataset.rules)
    run = uuid.uuid4().hex
    rows = with_partitions(new.select(dataset.schema.fieldNames()), dataset).hint("rebalance", *dataset.partitions)
    files.register(spark)
    target = rows.sortWithinPartitions(*dataset.partitions, dataset.time).write.format("lake_files")
    target.option("partitions", ",".join(dataset.partitions)).option("run", run).mode("overwrite" if replace else "append").save(root)
    counts = _stored_schema(T.StructType([]), dataset.partitions).add("row_count", "long")
    return spark.read.schema(counts).parquet(f"{root.rstrip('/')}/_written/{run}").orderBy(*dataset.partitions)


def upsert_candles(candles: DataFrame, root: str | None = None, allow_empty: bool = False, states: Sequence[State] = ()) -> DataFrame:
    return upsert(candles, root or configured_root(CANDLE_SET), CANDLE_SET, allow_empty, states)


def upsert_trades(trades: DataFrame, root: str | None = None, allow_empty: bool = False, states: Sequence[State] = ()) -> DataFrame:
    """As for candles; of trades with one identifier in the input, the later ingested counts."""
    return upsert(keep_last(trades, key=TRADE_KEY), root or configured_root(TRADE_SET), TRADE_SET, allow_empty, states)


def rebuild_states(spark: SparkSession, root: str, states: Sequence[State], dataset: Dataset = CANDLE_SET) -> None:
    """Computes states of a whole lake, where they are new or an upsert failed between data and states."""
    renew(read(spark, root, dataset), root, dataset.partitions, states)
