"""Parquet sinks of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SNAPPY, ZSTD = "snappy", "zstd"


def write_layer(
    df: DataFrame,
    path: str,
    codec: str = ZSTD,
    partition_by: tuple[str, ...] = (),
    rebalance: bool = False,
    max_records_per_file: int = 0,
) -> None:
    """Write a layer, replacing what is at ``path``; with ``partition_by``, replacing only the partitions in ``df``.

    ``rebalance`` is for output that follows a shuffle on another key: adaptive execution then regroups rows by the
    partition columns into files of the advisory size and splits a partition that is too big for one task.
    Row groups are sized in bytes (``parquet.block.size``); ``max_records_per_file`` bounds the rows of a file.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("compression", codec)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def delete(spark: SparkSession, folder: str) -> None:
    """Remove a folder of data files, through the file system that Spark would use."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
