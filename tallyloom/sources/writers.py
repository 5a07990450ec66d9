"""Stored tables that survive failed and repeated writes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH = "_batch"


class _Files:
    """The file system that holds a path, wherever it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.path_of = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.system.exists(self.path_of(path))

    def move(self, old: str, new: str) -> None:
        if not self.system.rename(self.path_of(old), self.path_of(new)):
            raise OSError(f"cannot move {old} to {new}")

    def delete(self, path: str) -> None:
        self.system.delete(self.path_of(path), True)


def _write(df: DataFrame, path: str, partition_by: Sequence[str], mode: str, **options: str) -> None:
    writer = df.write.mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Put a new table in place of an old one. It is written beside it first and then moved, so a write that fails half-way leaves the old table whole; the new one may be made from the old.

    Moving a folder is one step on HDFS and local disks. Stores that copy instead are not atomic for readers in that moment; the old table is kept until the new one is in place.
    """
    files, mark = _Files(df.sparkSession, path), uuid.uuid4().hex
    stage, old = f"{path}__stage_{mark}", f"{path}__old_{mark}"
    try:
        _write(df, stage, partition_by, "error")
    except Exception:
        files.delete(stage)
        raise
    had = files.exists(path)
    if had:
        files.move(path, old)
    try:
        files.move(stage, path)
    except Exception:
        if had:
            files.move(old, path)
        raise
    if had:
        files.delete(old)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that df has rows of and leave all others as they are. Files move into place when all tasks have written theirs; a failed write leaves the table as it was."""
    _write(df, path, partition_by, "overwrite", partitionOverwriteMode="dynamic")


def append_batch(df: DataFrame, path: str, batch: str) -> None:
    """Add the rows of a batch. A batch that is sent again replaces its own rows, so it never counts twice; a batch that becomes empty leaves its old rows."""
    replace_partitions(df.withColumn(BATCH, F.lit(batch)), path, [BATCH])


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches."""
    return spark.read.parquet(path).drop(BATCH)
