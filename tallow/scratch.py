"""The folder for intermediate tables, which driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only a local session without that setting gets one of its own.

    The session's settings stay as they are.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _own[context.applicationId]


def application_dir(spark: SparkSession) -> str:
    """This application's part of the folder."""
    return f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables, once the results made of them have been read or written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(application_dir(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
