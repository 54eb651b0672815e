"""Small tables with what the operators have to bear."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Names that operators use inside.
CLASHING = ("run", "row", "id", "key", "digest", "best", "kept", "block", "token", "text_id", "lost_id", "shard", "curve", "held", "node", "root")

LONG = "long words of many kinds " * 4000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away."),
    (2, "The  quick brown\tfox jumps over the lazy dog\nand runs away."),
    (3, None),
    (4, ""),
    (5, "   \n"),
    (6, LONG),
    (7, LONG),
    (8, "1234 !!"),
    (9, "Straße naïve façade 漢字 😀 end"),
    (10, "one"),
    (11, "one"),
    (12, "two words"),
    (12, "two words"),
    (None, "no identifier here"),
    (14, "The quick brown fox jumps over the lazy dog and runs far."),
]


def docs(spark, rows=ROWS, lang="en") -> DataFrame:
    """doc_id and text, the other columns of documents, and extra columns whose names clash."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    full = [(i, t, lang if i != 9 else None, "s", len(t or ""), *("x" for _ in CLASHING)) for i, t in rows]
    return spark.createDataFrame(full, schema).repartition(3)
