"""One row for each key, with a stated winner.

Aggregates by max_by would carry whole rows through a hash table; a ranked window sorts once and, with the limit of
one, drops the losers before the shuffle as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallow.schema import CANDLE_KEY


def _first(df: DataFrame, key: tuple[str, ...], order: list[Column]) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, order: tuple[str, ...] = ("page_no", "row_pos"), key: tuple[str, ...] = CANDLE_KEY) -> DataFrame:
    """The row that comes first in the given order."""
    return _first(df, key, [F.col(c) for c in order])


def keep_last(df: DataFrame, order: tuple[str, ...] = ("ingested_at",), key: tuple[str, ...] = CANDLE_KEY) -> DataFrame:
    """The row that comes last in the given order."""
    return _first(df, key, [F.desc(c) for c in order])


def merge_latest(existing: DataFrame, new: DataFrame, key: tuple[str, ...] = CANDLE_KEY) -> DataFrame:
    """Existing rows, replaced by new ones of the same key; among rows of one side the later ingested wins."""
    both = existing.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    return keep_last(both, ("_side", "ingested_at"), key).drop("_side")
