"""Exact deduplication by a tree merge of sorted digest runs.

Every partition of the input becomes one run: its (digest, identifier) rows, sorted. Runs are then merged in rounds,
``fan_in`` at a time. In round r the runs of one number div fan_in**r meet, but no task gets a whole merged run: the
digests are split into fan_in**r ranges, and each task merges one range of fan_in runs. So pieces keep their size from
round to round, and the last round's are one sorted run in ranges. Equal digests lie side by side in a merged piece
and fold into one row that holds the smallest identifier and the count. A digest that a third of all rows share has
at most ``fan_in`` rows in a piece, so no task ever gets a hot group. Afterwards the winners go down the tree again:
first to the runs, then to the rows of each run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

#: A digest row stands for equal texts only if the two other measures agree, too.
KEY = ("digest", "check", "n_bytes")


def normalised(text_col: str) -> Column:
    return F.regexp_replace(shared.text_of(text_col), shared.SPACE, " ")


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (run, row, id, digest, check, n_bytes), one sorted run for each partition of docs."""
    rows = docs.select(
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        normalised(text_col).alias("norm"),
    ).select(
        "run",
        "row",
        "id",
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.xxhash64("norm").alias("check"),
        F.octet_length("norm").alias("n_bytes"),
    )
    return shared.written(rows.sortWithinPartitions(*KEY, "id"), "digest-runs")


def merged_pieces(rows: DataFrame, run: Column, ranges: int) -> DataFrame:
    """Rows dealt out by run and range of digests, in order of the key within each such piece.

    Sorted rows of several runs arrive one run behind the other, which Spark's sort merges; it spills what doesn't fit.
    """
    first = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    piece = rows.withColumns({"run": run.cast("int"), "range": F.floor(first * F.lit(min(ranges, 1 << 30)) / F.lit(1 << 32))})
    return piece.repartition("run", "range").sortWithinPartitions("run", "range", *KEY)


def merge_runs(runs: DataFrame, fan_in: int = 16) -> tuple[DataFrame, DataFrame]:
    """The runs after folding each one on its own, and the one run that all of them merge into.

    Columns: run, the key, best (the smallest identifier and its row) and copies.
    """
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("best")
    # folding asks for rows clustered and sorted by run, range and key, as the pieces are: no further shuffle or sort
    fold = ["run", "range", *KEY]
    folded = merged_pieces(runs, F.col("run"), 1).groupBy(fold).agg(best, F.count(F.lit(1)).alias("copies"))
    last = runs.agg(F.max("run")).first()[0] or 0
    merged, left, ranges = folded, last, 1
    while left > 0:
        left, ranges = left // fan_in, ranges * fan_in
        pieces = merged_pieces(merged, F.floor(F.col("run") / fan_in), ranges)
        merged = pieces.groupBy(fold).agg(F.min("best").alias("best"), F.sum("copies").alias("copies"))
    return folded.drop("range"), merged.drop("range")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 16) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256, key (a short hash of the text).

    Texts are equal when they are identical after each run of ASCII white space became one space; a null text
    counts as empty. Of equal texts the row with the smallest identifier stays (a null identifier is larger
    than all others; of repeated rows with one identifier, the first read stays). An empty table gives an empty
    result. Other columns of docs are ignored, whatever their names.
    """
    runs = digest_runs(docs, id_col, text_col)
    folded, merged = merge_runs(runs, fan_in)
    groups = merged.filter("copies > 1").select(*KEY, F.col("best").alias("winner"), F.col("copies").alias("group_size"))
    by_run = folded.select("run", *KEY).join(groups, list(KEY))
    same = reduce(lambda a, b: a & b, (F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("run", *KEY)))
    return (
        runs.alias("a")
        .join(by_run.alias("b"), same, "left")
        .select(
            F.col("a.id").alias("doc_id"),
            F.when(F.col("b.winner").isNull(), F.col("a.id")).otherwise(F.col("b.winner.id")).alias("keep_id"),
            F.coalesce("b.group_size", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("a.row") == F.col("b.winner.row"), F.lit(True)).alias("kept"),
            F.lower(F.hex("a.digest")).alias("text_sha256"),
            F.col("a.check").alias("key"),
        )
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of equal texts, all columns as they are."""
    return shared.keep_decided(docs, exact_dedup(docs, id_col, text_col), F.xxhash64(normalised(text_col)), id_col)


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup(shared.table(spark, sf_dir, "documents")).drop("key")


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
