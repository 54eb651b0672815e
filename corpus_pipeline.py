"""A training corpus from ``documents``: language, exact copies, near copies, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallow.llm import exact_dedup, language_id, minhash_join, packing, shared

TOKENIZER = "byte_bpe_50k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language, mixed ones too; those without a letter go."""
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2, F.lit(True))
    return language_id.keep_identified(docs, language_id.train(docs, learn), least=0.0)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked texts (five-word shingles, Jaccard similarity of 0.8 or more), the document with the smallest doc_id stays."""
    return minhash_join.drop_near_copies(docs, percent=80, width=5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), with_ids=False, prompt=packing.first_line())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: SQL can express neither the language model nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
