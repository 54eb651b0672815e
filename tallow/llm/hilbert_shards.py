"""Sharding along a Hilbert curve.

Several metadata columns are quantised to a few bits each, at their own quantiles, so that a hot value takes one
cell of one axis and no more. The Hilbert index of the cell orders the rows; runs of that order are the shards.
Rows near in the order are near in every dimension, so a reader prunes shard files by the minimum and maximum of
any of them.

Law of the cut: ``rows``. Row number g of n in curve order goes to shard g * shards div n, so counts are at most
one apart. Ties on the curve fall back on the text's checksum and the identifier, which keeps copies adjacent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

#: Bits of one axis and values kept by the quantile sketch, which bounds the sketch, not the rows it sees.
BITS, SKETCH = 6, 10_000
#: Ranges into which a string dimension's distinct values are dealt to find its cuts.
RANGES = 512


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of axes, which has a column of ``bits`` bits for each dimension.

    The curve is built by undoing, from the highest bit down, the exchange or inversion that each orthant
    applies to the lower bits, and by a Gray decode across the dimensions afterwards.
    """
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            inside = (x[d] >> level) & 1 == 1
            swap = np.where(inside, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flips = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flips ^= np.where((x[dims - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flips
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((x[d] >> level) & 1)
    return index


def axis(df: DataFrame, name: str) -> Column:
    """A column as a double in the column's order (numbers, times, booleans; null lowest), or as the string that it is shown by."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        number = value.cast("double")
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        number = F.unix_micros(value.cast("timestamp")).cast("double")
    else:
        return F.coalesce(value.cast("string"), F.lit(""))
    return F.coalesce(number, F.lit(float("-inf")))


def cuts(rows: DataFrame, columns: list[str]) -> list[np.ndarray]:
    """For each axis at most 2**BITS - 1 values that cut its rows into cells of about one size.

    Numbers are cut at quantiles. Whole strings are dealt out into RANGES ranges of distinct values; of the ranges'
    smallest values those are cuts before which about so many rows lie. The driver gets a row for each range.
    """
    cells = 1 << BITS
    kinds = dict(rows.dtypes)
    numbers = [c for c in columns if kinds[c] == "double"]
    at = [k / cells for k in range(1, cells)]
    found = rows.agg(*(F.percentile_approx(c, at, SKETCH).alias(c) for c in numbers)).first().asDict() if numbers else {}
    for c in columns:
        if c not in found:
            # values with their counts, so that a frequent one is a row like any other
            values = rows.groupBy(c).agg(F.count(F.lit(1)).alias("n")).repartitionByRange(RANGES, c)
            ranges = sorted(values.groupBy(F.spark_partition_id()).agg(F.min(c).alias("least"), F.sum("n").alias("n")).select("least", "n").collect())
            total, before, last, found[c] = sum(r["n"] for r in ranges), 0, 0, []
            for r in ranges:
                if before * cells // total > last:
                    last = before * cells // total
                    found[c].append(r["least"])
                before += r["n"]
    return [np.unique(np.array(found[c] or [], dtype=float if c in numbers else object)) for c in columns]


def hilbert_shards(
    docs: DataFrame,
    dims: tuple[str, ...] = ("lang", "source", "size", "doc_id"),
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard, curve.

    ``size`` is the text's UTF-8 bytes (a null text has none) plus 8 and may be named in dims; other dims are
    columns of docs, ordered by their values (numbers, times) or by whole strings; null ones sort lowest. Repeated rows are rows of their own. grown_shard is null under the
    law of rows. With fewer rows than shards some shards stay empty; an empty table gives an empty result.
    Columns of docs that aren't named play no part.
    """
    shared.ship(docs.sparkSession)
    body = shared.text_of(text_col)
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        *(axis(docs, d).alias(f"axis_{k}") for k, d in enumerate(dims) if d != "size"),
    )
    if "size" in dims:
        slim = slim.withColumn(f"axis_{dims.index('size')}", F.col("size").cast("double"))
    slim = shared.written(slim, "shard-rows")
    axes = [f"axis_{k}" for k in range(len(dims))]
    bounds = cuts(slim, axes)

    @F.pandas_udf("long")
    def curve(*axes: pd.Series) -> pd.Series:
        cells = [np.searchsorted(b, a.to_numpy(), side="right") for b, a in zip(bounds, axes, strict=True)]
        return pd.Series(hilbert_index(np.stack(cells, axis=1), BITS))

    ordered = ("curve", "text_crc32", "doc_id")
    rows = slim.select("doc_id", "size", "text_crc32", curve(*axes).alias("curve"))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    runs = rows.repartitionByRange(parts, *ordered).sortWithinPartitions(*ordered)
    kind = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("pos", T.LongType())])
    runs = shared.written(runs.mapInPandas(_numbered, kind), "shard-runs")

    # one row for each partition of the sort, however many rows there are
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = runs.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    offsets = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    n = runs.count()
    place = F.col("before") + F.col("pos")
    return (
        runs.join(F.broadcast(offsets), "part")
        .withColumn("shard", F.expr(f"int((before + pos) * {shards} div {max(n, 1)})"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (place - F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "curve",
        )
    )


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row's number within its partition of the sorted order."""
    seen, part = 0, TaskContext.get().partitionId()
    for rows in batches:
        yield rows.assign(part=part, pos=np.arange(seen, seen + len(rows)))
        seen += len(rows)


def op4_hilbert_shards(spark, sf_dir):
    return hilbert_shards(shared.table(spark, sf_dir, "documents"))
