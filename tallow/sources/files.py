"""Parquet files in partition folders, as a Spark data source to write to.

    files.register(spark)
    df.write.format("lake_files").option("partitions", "exchange,symbol").mode("append").save(root)

Tasks write below ``_writing`` in the root, where readers don't look. The driver gets messages that name files and numbers
of rows, not rows; on commit it moves just the files of the tasks that succeeded into their folders and leaves a table of
what was written in ``_written``. On abort all that the run's tasks wrote is deleted, whichever of them failed.
"""

from __future__ import annotations

import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tallow.shipping import ship

#: Rows that a task holds at most before its largest partition becomes a file.
BUFFERED = 500_000
#: Signs that Spark's writer puts as % and two hexadecimal digits into the names of partition folders.
UNSAFE = r"[\x01-\x1f\x22\x23\x25\x27\x2a\x2f\x3a\x3d\x3f\x5c\x7b\x5b\x5d\x5e\x7f]"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

Values = tuple[str | None, ...]


@dataclass
class Written(WriterCommitMessage):
    """A task's files: name in the run's folder, partition values, rows."""

    files: list[tuple[str, Values, int]]


def file_system(root: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of an address, and the path in it; an address without a scheme is a local path."""
    return arrow_fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", root) if ":" in root.split("/")[0] else os.path.abspath(root))


def folder_of(partitions: list[str], values: Values) -> str:
    """The folder of partition values, named as Spark's writer does."""
    shown = [re.sub(UNSAFE, lambda m: f"%{ord(m[0]):02X}", v) if v else NO_VALUE for v in values]
    return "/".join(f"{c}={v}" for c, v in zip(partitions, shown, strict=True))


class PartitionWriter(DataSourceArrowWriter):
    """Writes a table's rows; with ``overwrite`` the partitions that it touches lose what they held before."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.root = options["path"].rstrip("/")
        self.partitions = [c.strip() for c in options.get("partitions", "").split(",") if c.strip()]
        if not self.partitions:
            raise ValueError("the option partitions must name a column")
        self.run = options.get("run") or uuid.uuid4().hex
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = file_system(self.root)
        folder = f"{root}/_writing/{self.run}"
        system.create_dir(folder, recursive=True)
        context = TaskContext.get()
        task = f"{context.partitionId():05d}-{context.taskAttemptId()}"
        held: dict[Values, list[pa.Table]] = {}
        counts: Counter[Values] = Counter()
        files: list[tuple[str, Values, int]] = []

        def flush(values: Values) -> None:
            name = f"part-{task}-{len(files):05d}-{self.run}.snappy.parquet"
            table = pa.concat_tables(held.pop(values)).drop_columns(self.partitions)
            pq.write_table(table, f"{folder}/{name}", filesystem=system, compression="snappy")
            files.append((name, values, counts.pop(values)))

        for batch in iterator:
            for values, part in self.split(pa.Table.from_batches([batch])):
                held.setdefault(values, []).append(part)
                counts[values] += part.num_rows
            while counts.total() > BUFFERED:
                flush(counts.most_common(1)[0][0])
        for values in list(held):
            flush(values)
        return Written(files)

    def split(self, table: pa.Table) -> Iterator[tuple[Values, pa.Table]]:
        """The table's rows by partition, in their order."""
        if not table.num_rows:
            return
        codes = np.zeros(table.num_rows, np.int64)
        for c in self.partitions:
            own = pc.dictionary_encode(table.column(c).combine_chunks(), null_encoding="encode")
            codes = np.unique(codes * len(own.dictionary) + own.indices.to_numpy(), return_inverse=True)[1]
        order = np.argsort(codes, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
            part = table.take(pa.array(rows))
            yield tuple(part.column(c)[0].as_py() for c in self.partitions), part

    def commit(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.root)
        files = [f for m in messages if m is not None for f in m.files]
        counts: Counter[Values] = Counter()
        folders = {values: f"{root}/{folder_of(self.partitions, values)}" for _, values, _ in files}
        before = [f.path for d in folders.values() for f in self.listed(system, d)] if self.overwrite else []
        for folder in folders.values():
            system.create_dir(folder, recursive=True)
        for name, values, rows in files:
            system.move(f"{root}/_writing/{self.run}/{name}", f"{folders[values]}/{name}")
            counts[values] += rows
        for path in before:
            system.delete_file(path)
        columns = [pa.array([v[k] for v in counts], pa.string()) for k in range(len(self.partitions))]
        report = pa.table([*columns, pa.array(list(counts.values()), pa.int64())], names=[*self.partitions, "row_count"])
        system.create_dir(f"{root}/_written/{self.run}", recursive=True)
        pq.write_table(report, f"{root}/_written/{self.run}/part-0.parquet", filesystem=system)
        self.clean(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self.clean(*file_system(self.root))

    def listed(self, system: arrow_fs.FileSystem, folder: str) -> list[arrow_fs.FileInfo]:
        found = system.get_file_info(arrow_fs.FileSelector(folder, allow_not_found=True))
        return [f for f in found if f.is_file and f.extension == "parquet"]

    def clean(self, system: arrow_fs.FileSystem, root: str) -> None:
        """Removes the run's folder, with the files of attempts that don't count."""
        if system.get_file_info(f"{root}/_writing/{self.run}").type == arrow_fs.FileType.Directory:
            system.delete_dir(f"{root}/_writing/{self.run}")


class LakeFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lake_files"

    def writer(self, schema, overwrite: bool) -> PartitionWriter:
        return PartitionWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Makes ``format("lake_files")`` known to the session."""
    ship(spark)
    spark.dataSource.register(LakeFiles)
