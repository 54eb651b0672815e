"""Windows over a long series in many tasks: stretches of time, each with copies of the rows beside it.

A stretch holds the candles of a fixed length of time. The first or last k rows of every stretch are aggregated to one
row a series, which tells each stretch the k rows before or behind it, however long a pause lies between; they are
exploded as copies into that stretch. A window that looks at most k rows back or ahead then needs its stretch alone,
and the copies are dropped behind it, so the longest series is as many groups as it has stretches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallow.operators.bars import micros_of
from tallow.schema import SERIES, TIMEFRAMES, millis_of

#: Candles that a stretch has where none is missing.
STRETCH = 4096
OWN = ("_stretch", "_copy")


def stretch_of(df: DataFrame, time: str) -> Column:
    """The number of a row's stretch. Its length follows the row's time frame; rows of an unknown one count as hourly."""
    micros = lambda t: F.lit(1000 * STRETCH * millis_of(t)).cast("long")
    length = micros("1h")
    if "timeframe" in df.columns:
        length = reduce(lambda other, t: F.when(F.col("timeframe") == t, micros(t)).otherwise(other), TIMEFRAMES, length)
    return F.floor(micros_of(df, time) / length)


def _edge(rows: DataFrame, key: Sequence[str], order: Column, k: int, side: str) -> DataFrame:
    """The first k rows of every stretch in the given order; Spark applies the limit before the shuffle, too."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key, "_stretch").orderBy(order)))
    return ranked.filter(F.col("_rank") <= k).drop("_rank").withColumn("_side", F.lit(side))


def with_halo(df: DataFrame, before: int = 0, after: int = 0, key: Sequence[str] = SERIES, time: str = "open_time") -> DataFrame:
    """df and copies: each stretch gets the last ``before`` rows that precede it and the first ``after`` that follow.

    Adds ``_stretch`` and ``_copy``. df should hold no more columns than the windows need.
    """
    rows = df.withColumn("_stretch", stretch_of(df, time))
    edges = [_edge(rows, key, o, k, s) for o, k, s in ((F.desc(time), before, "last"), (F.asc(time), after, "first")) if k]
    ends = reduce(DataFrame.unionByName, edges)
    # ordered by time, as it comes first in the struct
    whole = F.struct(F.col(time).alias("_time"), *(F.col(f"`{c}`") for c in df.columns))
    rows_of = lambda side: F.array_sort(F.collect_list(F.when(F.col("_side") == side, whole)))
    stretches = ends.groupBy(*key, "_stretch").agg(rows_of("last").alias("last"), rows_of("first").alias("first"))
    series = stretches.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_stretch", "last", "first"))).alias("_all"))
    every = F.col("_all")

    def beside(e: Column, i: Column) -> Column:
        # every stretch there is has a row, so k stretches hold k rows
        behind = F.flatten(F.transform(F.slice(every, F.greatest(i - before, F.lit(0)) + 1, F.least(i, F.lit(before))), lambda x: x["last"]))
        ahead = F.flatten(F.transform(F.slice(every, i + 2, F.lit(after)), lambda x: x["first"]))
        kept = F.slice(behind, F.greatest(F.size(behind) - before, F.lit(0)) + 1, F.lit(before))
        return F.struct(e["_stretch"].alias("_stretch"), F.concat(kept, F.slice(ahead, 1, after)).alias("_rows"))

    copies = series.select(F.inline(F.transform(every, beside))).select("_stretch", F.inline("_rows")).select(*df.columns, "_stretch", F.lit(True).alias("_copy"))
    return rows.withColumn("_copy", F.lit(False)).unionByName(copies)


def within(key: Sequence[str] = SERIES, time: str = "open_time") -> WindowSpec:
    """A stretch's rows and copies in order of time."""
    return Window.partitionBy(*key, "_stretch").orderBy(time)


def without_copies(df: DataFrame) -> DataFrame:
    return df.filter("NOT _copy").drop(*OWN)


def carried(df: DataFrame, value: Column, name: str, key: Sequence[str] = SERIES, time: str = "open_time") -> DataFrame:
    """df with ``_stretch``, and as ``name`` the sum of ``value`` over all earlier stretches of a row's series.

    What runs on from row to row then starts anew in every stretch. Only a row for each stretch meets in a series' window.
    """
    rows = df.withColumn("_stretch", stretch_of(df, time))
    totals = rows.groupBy(*key, "_stretch").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = totals.withColumn(name, F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    return joined(rows, sums, (*key, "_stretch"))


def numbered(df: DataFrame, name: str, key: Sequence[str] = SERIES, time: str = "open_time") -> DataFrame:
    """df with each row's number in its series from 0, by the rows of earlier stretches and its place in its own."""
    rows = carried(df, F.lit(1), "_before", key, time)
    place = F.col("_before") + F.row_number().over(within(key, time)) - 1
    return rows.withColumn(name, place).drop("_before", "_stretch")


def joined(rows: DataFrame, facts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with the facts of their key, where null is a key as any other."""
    named = facts.select(*(F.col(c).alias(f"_key_{c}") for c in key), *(c for c in facts.columns if c not in key))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key))
    return rows.join(named, same).drop(*(f"_key_{c}" for c in key))
