"""Parquet datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> tuple[int, int]:
    """Overwrite a dataset; returns its rows and columns.

    The rows are summed from the file footers, so no data is read again, and
    tasks that ran twice after a failure are not counted twice.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count(), len(df.columns)


def arranged(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Rows grouped for writing into folders, sorted within each file.

    The rebalance keeps the rows of one folder together but splits a folder that
    holds much of the data over many tasks and merges small ones, so neither a
    busy month nor a thousand tasks per folder shape the files.
    """
    rebalanced = df.hint("rebalance", *[F.col(c) for c in partition_by])
    return rebalanced.sortWithinPartitions(*partition_by, *sort_by)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> None:
    """Overwrite a dataset laid out by folder."""
    writer = arranged(df, partition_by, sort_by).write.mode("overwrite")
    writer.partitionBy(*partition_by).parquet(path)


def remove_folder(path: str) -> None:
    """Delete a folder and all in it, wherever Spark can write; nothing if it is not there."""
    jvm = SparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(SparkContext._active_spark_context._jsc.hadoopConfiguration()).delete(folder, True)
