"""Clusters of vectors around centroids, assigned through a vector-approximation file.

Every dimension is cut into a few cells, and a vector's cells, packed into bits, are its approximation. Tables of the
squared distances between a centroid's component and the near and far end of every cell give an interval for the
distance of a vector to each centroid by lookups alone. Where only one centroid's interval reaches below the smallest
upper end, that centroid is the nearest; elsewhere the full vector is fetched and compared with those whose intervals
overlap, by exact integer distances, ties by their number.

Approximations and vectors are columns of one table in the shared folder, so a scan of the approximations reads no
vector. A centroid's sum changes only by vectors that move: a round scans the approximations under the centroids of
the round before and of its own, and joins the table again for the vectors that are open under either, or that move.
The first round, which sums every vector, and the last, which measures every vector, read them all. Only
sums for each centroid come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared, vectors

CENTROIDS, ROUNDS, SCALE, COMPONENTS = 16, 3, 64, 64
#: Bits of a cell's number, 8 at most, and deviations from the mean that the inner cells cover.
BITS, SPAN = 6, 3.0

Numbers = np.ndarray


def cell_bounds(low: Numbers, high: Numbers, mean: Numbers, deviation: Numbers, bits: int) -> tuple[Numbers, Numbers]:
    """Smallest and largest integer of each cell, a row for each dimension.

    Inner edges lie evenly within SPAN deviations of the dimension's mean, as wide cells make wide intervals; the outer
    cells reach to the least and largest value, so whatever the data, every value lies in its cell.
    """
    inner = np.floor(mean[:, None] + deviation[:, None] * np.linspace(-SPAN, SPAN, 2**bits - 1)).astype(np.int64).clip(low[:, None], high[:, None])
    first = np.concatenate([low[:, None], inner], axis=1)
    last = np.concatenate([inner - 1, high[:, None]], axis=1)
    # a cell without integers has no rows either
    return first, np.maximum(first, last)


def cells_of(block: Numbers, first: Numbers) -> Numbers:
    """The number of the cell of every component: the last one that starts at or below it."""
    return np.stack([np.searchsorted(first[j, 1:], block[:, j], side="right") for j in range(block.shape[1])], axis=1).astype(np.uint8)


def packed(cells: Numbers, bits: int) -> Numbers:
    """Cells as rows of bytes, without gaps between their bits."""
    return np.packbits((cells[:, :, None] >> np.arange(bits, dtype=np.uint8) & 1).reshape(len(cells), -1), axis=1)


def unpacked(rows: Numbers, bits: int, components: int) -> Numbers:
    each = np.unpackbits(rows, axis=1, count=bits * components).reshape(len(rows), components, bits)
    return np.bitwise_or.reduce(each << np.arange(bits, dtype=np.uint8), axis=2)


class Intervals:
    """Lookup tables of squared distances for each dimension, cell and centroid."""

    def __init__(self, centroids: Numbers, first: Numbers, last: Numbers):
        self.centroids = centroids
        c = centroids.T[:, None, :]
        to_first, to_last = (c - first[:, :, None]) ** 2, (c - last[:, :, None]) ** 2
        inside = (c >= first[:, :, None]) & (c <= last[:, :, None])
        self.near, self.far = np.where(inside, 0, np.minimum(to_first, to_last)), np.maximum(to_first, to_last)

    def candidates(self, cells: Numbers) -> Numbers:
        """Which centroids may be the nearest: those whose interval reaches down to the smallest upper end."""
        low = np.zeros((len(cells), len(self.centroids)), dtype=np.int64)
        high = np.zeros_like(low)
        for j in range(cells.shape[1]):
            low += self.near[j][cells[:, j]]
            high += self.far[j][cells[:, j]]
        return low <= high.min(1)[:, None]

    def assign(self, cells: Numbers, fetch: Callable[[Numbers], Numbers]) -> Numbers:
        """The nearest centroid of every row; ``fetch`` gives the vectors of the rows (by number) whose intervals overlap."""
        may = self.candidates(cells)
        out = may.argmax(1)
        open_rows = np.flatnonzero(may.sum(1) > 1)
        if open_rows.size:
            squares = np.where(may[open_rows], vectors.squared(fetch(open_rows), self.centroids), np.iinfo(np.int64).max)
            out[open_rows] = squares.argmin(1)
        return out


def _cell_column(batch: pa.RecordBatch, bits: int, components: int) -> Numbers:
    data = b"".join(batch.column("cells").to_pylist())
    return unpacked(np.frombuffer(data, dtype=np.uint8).reshape(batch.num_rows, -1), bits, components)


def _vector_column(batch: pa.RecordBatch, components: int) -> Numbers:
    return np.asarray(batch.column("vector").flatten(), dtype=np.int64).reshape(batch.num_rows, components)


def approximated(rows: DataFrame, scale: int, components: int, bits: int) -> tuple[DataFrame, Numbers, Numbers] | None:
    """rows (vec_id, vector) as a written table (place, vec_id, cells, vector), and the bounds of the cells; None without rows."""

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in vectors.blocks(batches, components):
            block = vectors.integers(batch.column("vector"), scale, components)
            now = block.min(0), block.max(0), block.sum(0).astype(float), (block.astype(float) ** 2).sum(0)
            low, high, total, square = now if not n else (np.minimum(low, now[0]), np.maximum(high, now[1]), total + now[2], square + now[3])
            n += len(block)
        if n:
            yield pa.RecordBatch.from_pydict({"k": np.arange(components, dtype=np.int32), "n": np.full(components, n), "low": low, "high": high, "total": total, "square": square})

    parts = shared.map_arrow(rows.select("vector"), extent, "k int, n long, low long, high long, total double, square double")
    sums = parts.groupBy("k").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"), F.sum("square").alias("square"))
    found = sorted(sums.collect())  # a row for each dimension
    if not found:
        return None
    n = found[0].n
    mean = np.array([r.total / n for r in found])
    deviation = np.sqrt(np.maximum(np.array([r.square / n for r in found]) - mean**2, 0))
    first, last = cell_bounds(np.array([r.low for r in found]), np.array([r.high for r in found]), mean, deviation, bits)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vectors.blocks(batches, components):
            block = vectors.integers(batch.column("vector"), scale, components)
            cells = packed(cells_of(block, first), bits)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(block) + 1, dtype=np.int32) * components), pa.array(block.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("vec_id"), pa.array([c.tobytes() for c in cells], pa.binary()), lists], names=["place", "vec_id", "cells", "vector"])

    placed = rows.select(F.monotonically_increasing_id().alias("place"), "vec_id", "vector")
    kind = rows.schema["vec_id"].dataType.simpleString()
    # numbers of rows hold once the table is written
    table = shared.written(shared.map_arrow(placed, encode, f"place long, vec_id {kind}, cells binary, vector array<int>"), "approximations")
    return table, first, last


def _start(table: DataFrame, centroids: int) -> Numbers:
    """The vectors of the smallest digests of their identifiers; of one identifier's the smaller vector goes first."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    return np.array([r.vector for r in table.orderBy(F.asc_nulls_last(digest), "vector").limit(centroids).select("vector").collect()], dtype=np.int64)


def _collected(partials: DataFrame, like: Numbers) -> tuple[Numbers, Numbers]:
    """Numbers and sums for each centroid, out of the partial ones of the tasks."""
    total = F.array(*(F.sum(F.col("sums")[k]) for k in range(like.shape[1]))).alias("sums")
    n, sums = np.zeros(len(like), dtype=np.int64), np.zeros_like(like)
    for r in partials.groupBy("cluster").agg(F.sum("n").alias("n"), total).collect():
        n[r.cluster], sums[r.cluster] = r.n, r.sums
    return n, sums


_PARTIAL = "cluster int, n long, sums array<long>"


def _partial(n: Numbers, sums: Numbers) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"cluster": np.arange(len(n), dtype=np.int32), "n": n, "sums": pa.array(sums.tolist(), pa.list_(pa.int64()))})


def _sums(table: DataFrame, now: Intervals, bits: int) -> tuple[Numbers, Numbers]:
    """Numbers and sums of the vectors nearest to each centroid."""
    k, components = now.centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, components), dtype=np.int64)
        for batch in vectors.blocks(batches, components):
            block = _vector_column(batch, components)
            more, total = vectors.summed(block, now.assign(_cell_column(batch, bits, components), block.__getitem__), k)
            n, sums = n + more, sums + total
        yield _partial(n, sums)

    return _collected(shared.map_arrow(table.select("cells", "vector"), add, _PARTIAL), now.centroids)


def unsettled(table: DataFrame, before: Intervals, now: Intervals, bits: int) -> DataFrame:
    """Places of the rows that intervals don't prove to stay where they were; reads the approximations alone."""
    components = now.centroids.shape[1]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vectors.blocks(batches, components):
            cells = _cell_column(batch, bits, components)
            old, new = before.candidates(cells), now.candidates(cells)
            stays = (old.sum(1) == 1) & (new.sum(1) == 1) & (old.argmax(1) == new.argmax(1))
            yield pa.RecordBatch.from_arrays([batch.column("place").filter(pa.array(~stays))], names=["place"])

    return shared.map_arrow(table.select("place", "cells"), settle, "place long")


def _moves(table: DataFrame, before: Intervals, now: Intervals, bits: int) -> tuple[Numbers, Numbers]:
    """By how much the numbers and sums of ``before`` change under ``now``; fetches the unsettled rows."""
    k, components = now.centroids.shape

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, components), dtype=np.int64)
        for batch in vectors.blocks(batches, components):
            block, cells = _vector_column(batch, components), _cell_column(batch, bits, components)
            for intervals, sign in ((before, -1), (now, 1)):
                more, total = vectors.summed(block, intervals.assign(cells, block.__getitem__), k)
                n, sums = n + sign * more, sums + sign * total
        yield _partial(n, sums)

    fetched = table.select("place", "cells", "vector").join(unsettled(table, before, now, bits), "place").select("cells", "vector")
    return _collected(shared.map_arrow(fetched, move, _PARTIAL), now.centroids)


def centroid_clusters(df: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, components: int = COMPONENTS, bits: int = BITS) -> tuple[DataFrame, Numbers]:
    """Rows (vec_id, cluster, distance) of all vectors that count, and the final centroids.

    df has vec_id and embedding. Rows without a vector, with another number of components, or with one that is null or not
    finite, are left out. Null identifiers, which come last when centroids start, and repeated rows are assigned like others;
    of fewer vectors than centroids each is a centroid's start, and no vectors give no rows. A component beyond vectors.MOST is an error.
    """
    rows = vectors.kept(df, "vec_id", components=components)
    made = approximated(rows, scale, components, bits)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    if made is None:
        return df.sparkSession.createDataFrame([], schema), np.zeros((0, components), dtype=np.int64)
    table, first, last = made
    now = Intervals(_start(table, centroids), first, last)
    before, n, sums = None, None, None
    for _ in range(rounds):
        if before is None:
            n, sums = _sums(table, now, bits)
        else:
            more, total = _moves(table, before, now, bits)
            n, sums = n + more, sums + total
        before = now
        # whole numbers, rounded down; an empty centroid stays
        now = Intervals(np.where(n[:, None] > 0, sums // np.maximum(n, 1)[:, None], now.centroids), first, last)
    final = now

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vectors.blocks(batches, components):
            block = _vector_column(batch, components)
            cluster = final.assign(_cell_column(batch, bits, components), block.__getitem__)
            distance = ((block - final.centroids[cluster]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return shared.map_arrow(table.select("vec_id", "cells", "vector"), measure, schema), final.centroids


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the whole table ``embeddings``: 16 centroids, three rounds."""
    found, centroids = centroid_clusters(shared.table(spark, sf_dir, "embeddings"))
    clusters = shared.written(found, "clusters")
    totals = {r.cluster: r.inertia for r in clusters.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # a row for each centroid
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = [totals.get(k, 0) for k in range(len(digests))]
    at = F.col("cluster") + 1
    of = lambda values, kind: F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), at)
    return clusters.select("vec_id", "cluster", "distance", of(inertia, "long").alias("cluster_inertia"), F.lit(sum(inertia)).cast("long").alias("inertia"), of(digests, "string").alias("centroid_sha256"))


def _sql() -> str:
    """The same in SQL: every distance of every round."""
    steps = [
        """kept AS (SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """components AS (SELECT vec_id, k AS place, CAST(floor(64 * CAST(embedding[k] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS k FROM kept))""",
        "starts AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM kept QUALIFY cluster < 16)",
        "center0 AS (SELECT cluster, place, x FROM components JOIN starts USING (vec_id))",
    ]
    for r in range(4):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT vec_id, cluster, distance FROM
  (SELECT c.vec_id, m.cluster, CAST(sum((c.x - m.x) * (c.x - m.x)) AS BIGINT) AS distance FROM components c JOIN center{r} m USING (place) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)"""
        )
        if r < 3:
            steps.append(
                f"""center{r + 1} AS MATERIALIZED (SELECT b.cluster, b.place, coalesce(m.x, b.x) AS x FROM center{r} b LEFT JOIN
  (SELECT n.cluster, c.place, CAST(floor(sum(c.x) / count(*)) AS BIGINT) AS x FROM near{r} n JOIN components c USING (vec_id) GROUP BY ALL) m USING (cluster, place))"""
            )
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near3 JOIN (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256 FROM center3 GROUP BY cluster) USING (cluster)"""


SQL = _sql()
