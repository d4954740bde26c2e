"""Session settings the pipeline is written for, and sizing by input."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Adaptive execution merges small shuffle partitions, splits skewed ones in joins
# and rebalances before partitioned writes. Event times carry no zone; UTC only
# fixes how the ingest stamp is shown.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

SPLIT_BYTES = 128 * 1024**2
MOST_TASKS = 100_000
MOST_PARTITIONS = 50_000


def sizes(input_bytes: int) -> tuple[int, int]:
    """Bytes per scan task and number of shuffle partitions for an input of this size.

    Both aim at 128 MB. Beyond the caps tasks grow instead of multiplying: the
    number of shuffle blocks is their product, and a shuffle partition of 2 GB
    still sorts and spills well.
    """
    split = max(SPLIT_BYTES, math.ceil(input_bytes / MOST_TASKS))
    return split, min(max(1, math.ceil(input_bytes / SPLIT_BYTES)), MOST_PARTITIONS)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files under a folder, from their listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def size_for(spark: SparkSession, input_bytes: int) -> None:
    """Raise split size and initial shuffle partitions to what the input needs.

    Never lowers a setting. Adaptive execution merges partitions that turn out small.
    """
    split, partitions = sizes(input_bytes)
    if split > SPLIT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    if partitions > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)


def local_session(cpus: int | str = "*", **extra: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bankmart")
    for name, value in {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
