from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallow.sources import files, lake
from tests.test_quality import candles, hour


def stored(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet") and "/_" not in d)


def test_append_and_replace(spark, tmp_path):
    root = str(tmp_path / "lake")
    first = lake.append(candles(spark, hour(1), hour(2), hour(24 * 31)), root)
    assert [(r.year, r.month, r.row_count) for r in first.collect()] == [("2026", "01", 2), ("2026", "02", 1)]
    february = stored(root)[-1]
    lake.append(candles(spark, hour(3)), root)
    assert sorted(r.open_time.hour for r in lake.read_candles(spark, root).filter("month = '01'").collect()) == [1, 2, 3]
    lake.append(candles(spark, hour(5)), root, replace=True)
    rows = lake.read_candles(spark, root)
    assert sorted((r.month, r.open_time.hour) for r in rows.collect()) == [("01", 5), ("02", 0)]
    assert stored(root)[-1] == february and os.listdir(f"{root}/_writing") == []  # untouched; nothing left behind
    # an upsert goes on with what was appended
    lake.upsert_candles(candles(spark, hour(5, close=90100.0), hour(6)), root)
    assert {r.open_time.hour: r.close for r in lake.read_candles(spark, root).filter("month = '01'").collect()} == {5: 90100.0, 6: 90500.0}
    with pytest.raises(ValueError, match="high >= low"):
        lake.append(candles(spark, hour(7, high=1.0)), root)


def test_failing_task_leaves_no_file(spark, tmp_path):
    root = str(tmp_path / "lake")
    files.register(spark)
    rows = spark.range(4000, numPartitions=4).select("id", F.concat(F.lit("k"), F.col("id") % 3).alias("key"))
    write = lambda df, mode="append": df.write.format("lake_files").option("partitions", "key").mode(mode).save(root)
    write(rows)
    before = stored(root)
    broken = rows.withColumn("id", F.when(F.col("id") == 3999, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="broken"):
            write(broken, mode)
        assert stored(root) == before and os.listdir(f"{root}/_writing") == []
    assert spark.read.parquet(root).agg(F.count("*"), F.sum("id")).first()[:] == (4000, 3999 * 2000)
    with pytest.raises(Exception, match="partitions"):
        rows.write.format("lake_files").mode("append").save(root)


def test_folders_are_named_as_spark_does(spark, tmp_path):
    values = ["a/b", "50%", "x=y", "", None, "plain", "[z]", "ü"]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "n int, key string")
    files.register(spark)
    df.write.format("lake_files").option("partitions", "key").mode("append").save(str(tmp_path / "own"))
    df.write.partitionBy("key").parquet(str(tmp_path / "spark"))
    folders = lambda at: sorted(d for d in os.listdir(tmp_path / at) if "=" in d)
    assert folders("own") == folders("spark")
    read = lambda at: sorted(map(str, spark.read.parquet(str(tmp_path / at)).collect()))
    assert read("own") == read("spark")


def test_buffers_are_bounded(spark, tmp_path, monkeypatch):
    class Task:
        partitionId = taskAttemptId = staticmethod(lambda: 7)

    monkeypatch.setattr(files, "BUFFERED", 100)
    monkeypatch.setattr(files.TaskContext, "get", classmethod(lambda cls: Task))
    writer = files.PartitionWriter({"path": str(tmp_path), "partitions": "a,b"}, False)
    batches = [pa.RecordBatch.from_pydict({"n": list(range(90)), "a": ["x", "y", "z"] * 30, "b": [None, *"pq"] * 30}) for _ in range(5)]
    done = writer.write(iter(batches))
    assert sum(rows for _, _, rows in done.files) == 450 and max(rows for _, _, rows in done.files) <= 120
    assert {values for _, values, _ in done.files} == {("x", None), ("y", "p"), ("z", "q")}
    writer.commit([done, None])
    assert len(stored(tmp_path)) == len(done.files)
