"""What several operators need: a shared scratch folder, tables written to cut lineage, byte-level words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallow.scratch import application_dir
from tallow.shipping import ship

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Runs of ASCII white space, as in the operators' contracts.
SPACE = r"[\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: later steps read it instead of computing it again.

    Tables lie in one folder for each application, which scratch.clear deletes.
    """
    path = f"{application_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """mapInArrow with this package importable in the workers, and batches of fewer rows than Spark's default, as texts may be long."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    if conf.get(BATCH) == "10000":
        conf.set(BATCH, "1000")
    return df.mapInArrow(function, schema)


def text_of(column: str) -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def keep_decided(docs: DataFrame, decisions: DataFrame, key: Column, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs that decisions (doc_id, key, kept) keep; key is the same expression over a row of docs.

    Rows of one identifier and key are repeated rows, of which one stays if any is kept. Only keys that lose a row
    are joined, which Spark broadcasts where their table is small.
    """
    lost = decisions.groupBy(F.col("doc_id").alias("lost_id"), F.col("key").alias("lost_key")).agg(
        F.bool_or("kept").alias("lost_stays"), F.count(F.lit(1)).alias("lost_rows")
    )
    lost = written(lost.filter("NOT lost_stays OR lost_rows > 1"), "lost-keys")
    # the row as one value, so that no name of its columns clashes
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    rows = docs.select(whole, F.col(id_col).cast("long").alias("doc_id"), key.alias("key"))
    same = F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("key") == F.col("lost_key"))
    repeated = rows.join(lost.filter("lost_stays"), same, "left_semi").dropDuplicates(["doc_id", "key"])
    return rows.join(lost, same, "left_anti").unionByName(repeated).select("doc.*")


#: Bits of the filter of wanted rows; 4 MB when it is full.
FILTER_BITS = 1 << 25


def likely(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The rows whose key may be among the wanted ones, by one bit of its hash: what is broadcast has a fixed largest size.

    It keeps most of the others out of the shuffle of a join that follows.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1
    bits = wanted.groupBy(F.bitmap_bucket_number(bit(wanted_key)).alias("wanted_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit(wanted_key))).alias("wanted_bits"))
    place = F.bitmap_bit_position(bit(key))
    byte = F.conv(F.hex(F.substr("wanted_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    near = rows.join(F.broadcast(bits), F.bitmap_bucket_number(bit(key)) == F.col("wanted_bucket"))
    return near.filter(F.getbit(byte, (place % 8).cast("int")) == 1).select(rows.columns)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words ``[^\\x20\\x09-\\x0D]+``; bytes.lower and bytes.split know ASCII alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Kept(dict):
    """Results of ``make`` by key, in two generations of at most ``most`` keys: what a full generation leaves unused goes."""

    def __init__(self, make, most: int, longest: int):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found
