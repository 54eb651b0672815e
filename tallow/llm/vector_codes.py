"""Compression of vectors to short codes: a codebook for each part of a vector, trained and applied exactly.

Components are integers, so distances are too. The nearest entry is found in a geometric near-neighbour access tree
over the codebook's entries: split points keep the range of their distances to the entries of every child, and the
distances of a query to the split points eliminate whole children. Ranges are in doubles, widened by more than their
rounding, and a child goes only where it lies strictly beyond the best entry so far; entries that remain are compared
by integer distances, ties by their index. So the tree gives the same entries as comparing all would.

Spark runs over the table once for each round; a task hands on one sum for each part and entry, so neither a frequent
vector nor a frequent entry is a hot key, and the driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared, vectors

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Split points of a tree's node, and entries that need no split.
DEGREE, LEAF = 24, 24
#: Share by which distances are widened; the rounding of a few operations on doubles is below a thousandth of it.
SLACK = 1e-12


class Node(NamedTuple):
    """Split points with, for each of them and each child, the least and largest distance; a leaf has points alone."""

    ids: np.ndarray
    points: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    children: tuple[Node | None, ...] = ()


class Tree:
    """A geometric near-neighbour access tree over the rows of ``entries``."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        self.entries, self.degree, self.leaf = entries, degree, max(leaf, degree)
        # of equal entries only the first can be an answer
        self.root = self._node(np.sort(np.unique(entries, axis=0, return_index=True)[1]))
        #: Distances computed so far; comparing everything would be queries times entries.
        self.compared = 0

    def _node(self, ids: np.ndarray) -> Node:
        if len(ids) <= self.leaf:
            return Node(ids, self.entries[ids])
        # split points far from one another, from the first entry on
        chosen = [0]
        away = vectors.squared(self.entries[ids], self.entries[ids[:1]])[:, 0]
        while len(chosen) < self.degree:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, vectors.squared(self.entries[ids], self.entries[ids[chosen[-1:]]])[:, 0])
        splits, rest = np.sort(ids[chosen]), np.delete(ids, chosen)
        squares = vectors.squared(self.entries[rest], self.entries[splits])
        child, away = squares.argmin(1), np.sqrt(squares)
        low, high = np.zeros((2, self.degree, self.degree))
        children: list[Node | None] = []
        for j in range(self.degree):
            mine = child == j
            children.append(self._node(rest[mine]) if mine.any() else None)
            if mine.any():
                low[:, j], high[:, j] = away[mine].min(0), away[mine].max(0)
        return Node(splits, self.entries[splits], low, high, tuple(children))

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of every row, of equally near ones the smallest index."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        who = np.zeros(len(queries), dtype=np.int64)
        if len(queries):
            self._visit(self.root, queries, np.arange(len(queries)), best, who)
        return who, best

    def _visit(self, node: Node, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, who: np.ndarray) -> None:
        squares = vectors.squared(queries[rows], node.points)
        self.compared += squares.size
        # ids ascend in a node, so the first of equals has the smallest
        near = squares.argmin(1)
        value, entry = squares[np.arange(len(rows)), near], node.ids[near]
        better = (value < best[rows]) | ((value == best[rows]) & (entry < who[rows]))
        best[rows[better]], who[rows[better]] = value[better], entry[better]
        away = np.sqrt(squares) if node.children else None
        for first in (True, False):  # the nearest split's child makes the radius small for the others
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                radius = np.sqrt(best[rows])[:, None]
                slack = SLACK * (away + radius + node.high[:, j])
                beyond = (away - radius - slack > node.high[:, j]) | (away + radius + slack < node.low[:, j])
                go = ((near == j) == first) & ~beyond.any(1)
                if go.any():
                    self._visit(child, queries, rows[go], best, who)


def _assigned(block: np.ndarray, trees: list[Tree]) -> tuple[list[np.ndarray], np.ndarray]:
    """The entry of each part, and the squared distances summed over the parts."""
    width = block.shape[1] // len(trees)
    found = [tree.nearest(block[:, p * width : (p + 1) * width]) for p, tree in enumerate(trees)]
    return [who for who, _ in found], sum((d for _, d in found), np.zeros(len(block), dtype=np.int64))


def _first_books(rows: DataFrame, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """The codebooks of the start: parts of the vectors of the smallest identifiers; of one identifier's the smaller vector goes first."""
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return []
    width = max(-(-longest // parts), 1)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    whole = vectors.integers(pa.array([r.vector for r in first], pa.list_(pa.float64())), scale, width * parts)
    return [whole[:, p * width : (p + 1) * width] for p in range(parts)]


def _next_books(rows: DataFrame, books: list[np.ndarray], scale: int) -> list[np.ndarray]:
    """The codebooks after a round: every used entry becomes the mean, rounded down, of the parts nearest to it."""
    width, count = books[0].shape[1], len(books[0])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(b) for b in books]
        n, sums = np.zeros((len(books), count), dtype=np.int64), np.zeros((len(books), count, width), dtype=np.int64)
        for batch in vectors.blocks(batches, width * len(books)):
            block = vectors.integers(batch.column("vector"), scale, width * len(books))
            for p, entry in enumerate(_assigned(block, trees)[0]):
                more, total = vectors.summed(block[:, p * width : (p + 1) * width], entry, count)
                n[p] += more
                sums[p] += total
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"part": part.astype(np.int32), "entry": entry.astype(np.int32), "n": n[part, entry], "sums": pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))}
        )

    found = shared.map_arrow(rows.select("vector"), partial, "part int, entry int, n long, sums array<long>")
    total = F.array(*(F.sum(F.col("sums")[k]) for k in range(width))).alias("sums")
    out = [b.copy() for b in books]
    # a row for each part and entry
    for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), total).collect():
        out[r.part][r.entry] = [s // r.n for s in r.sums]
    return out


def train(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> list[np.ndarray]:
    """Codebooks, one for each part, of integer entries; none where no row has a vector. Arguments as for encode."""
    rows = vectors.kept(df, "vec_id")
    books = _first_books(rows, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = _next_books(rows, books, scale)
    return books


def encode(df: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """Codes of all rows whose vector counts: vec_id, label, code (two hexadecimal digits a part), error (squared distance).

    df has vec_id, embedding and label. Rows without a vector, or with a component that is null or not finite, are left out.
    Vectors shorter than the codebooks' (the longest of the table, rounded up to a multiple of the parts) count as followed
    by zeros. Null identifiers and labels, and repeated rows, are coded like others. A component beyond vectors.MOST is an error.
    """
    rows = vectors.kept(df, "vec_id", "label")
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"]]).add("code", "string").add("error", "long")
    if not books:
        return df.sparkSession.createDataFrame([], schema)
    width = books[0].shape[1] * len(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(b) for b in books]
        for batch in vectors.blocks(batches, width):
            entry, error = _assigned(vectors.integers(batch.column("vector"), scale, width), trees)
            text = np.stack(entry, axis=1).astype(np.uint8).tobytes().hex()
            step = 2 * len(books)
            codes = [text[i : i + step] for i in range(0, len(text), step)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return shared.map_arrow(rows, code, schema)


def decoded(code: str, books: list[np.ndarray]) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([book[entry] for book, entry in zip(books, bytes.fromhex(code), strict=True)])


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """coded with the sum of ``error`` over the rows of each label, null ones together.

    There may be as many labels as rows, so Spark chooses the join by the sizes that it finds; it streams over a frequent label's rows.
    """
    totals = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the whole table ``embeddings``: four parts, codebooks of 256 entries, four rounds."""
    table = shared.table(spark, sf_dir, "embeddings")
    books = train(table)
    coded = with_label_error(shared.written(encode(table, books), "vector-codes"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same in SQL: every distance of every round."""
    steps = [
        """kept AS (SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """components AS (SELECT vec_id, (k - 1) // (n // 4) AS part, (k - 1) % (n // 4) AS place, CAST(floor(1024 * CAST(embedding[k] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT vec_id, embedding, len(embedding) AS n, unnest(range(1, len(embedding) + 1)) AS k FROM kept))""",
        "starts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 256)",
        "book0 AS (SELECT part, entry, place, x FROM components JOIN starts USING (vec_id))",
    ]
    for r in range(5):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT vec_id, part, entry, d FROM
  (SELECT c.vec_id, c.part, b.entry, CAST(sum((c.x - b.x) * (c.x - b.x)) AS BIGINT) AS d FROM components c JOIN book{r} b USING (part, place) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)"""
        )
        if r < 4:
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN
  (SELECT n.part, n.entry, c.place, CAST(floor(sum(c.x) / count(*)) AS BIGINT) AS x FROM near{r} n JOIN components c USING (vec_id, part) GROUP BY ALL) m USING (part, entry, place))"""
            )
    return f"""WITH {", ".join(steps)},
codes AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near4 GROUP BY vec_id),
labels_error AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM codes JOIN kept USING (vec_id) GROUP BY label)
SELECT vec_id, code, error, label_error, (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book4) AS codebooks_sha256
FROM codes JOIN kept USING (vec_id) JOIN labels_error l ON l.label IS NOT DISTINCT FROM kept.label"""


SQL = _sql()
