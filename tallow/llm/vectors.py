"""Vectors as exact integers: rows that count, blocks of numpy rows, squared distances without rounding."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components beyond this, as integers, have squared distances that a long might not hold.
MOST = 2**27
#: Components of a block, which bounds a worker's memory.
BLOCK = 2**20


def finite(vector: Column) -> Column:
    """Whether a vector is there and all of its components are numbers; null components, NaN and infinities are none."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & F.forall(vector, number), F.lit(False))


def kept(df: DataFrame, *columns: str, components: int | None = None, vector: str = "embedding") -> DataFrame:
    """The named columns and ``vector`` (array<double>) of the rows whose vector counts, of any length or of the given one."""
    rows = df.select(*columns, F.col(vector).cast("array<double>").alias("vector")).filter(finite(F.col("vector")))
    return rows if components is None else rows.filter(F.size("vector") == components)


def blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The batches, put together to blocks of about BLOCK components."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows * max(width, 1) >= BLOCK:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def integers(vectors: pa.ListArray, scale: int, width: int) -> np.ndarray:
    """floor(scale * x) of every component, a row for each vector; zeros follow where a vector is shorter than ``width``."""
    values = np.floor(np.asarray(vectors.flatten(), dtype=np.float64) * scale)
    if values.size and np.abs(values).max() > MOST:
        raise ValueError(f"a component is beyond {MOST / scale:g}, so squared distances would not fit a long")
    lengths = np.asarray(pc.list_value_length(vectors), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(values.size) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[row, place] = values.astype(np.int64)
    return out


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of left to all of right: by a product of doubles where every step of it is exact, else in longs."""
    most = max((int(np.abs(m).max()) for m in (left, right) if m.size), default=0)
    if left.shape[1] * (2 * most) ** 2 < 2**52:
        a, b = left.astype(np.float64), right.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((left - r) ** 2).sum(1) for r in right], axis=1)


def summed(rows: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and componentwise sum of the rows of each group."""
    sums = np.zeros((groups, rows.shape[1]), dtype=np.int64)
    np.add.at(sums, group, rows)
    return np.bincount(group, minlength=groups), sums
