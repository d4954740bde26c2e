"""Column handling that no extra or clashing column can upset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns. Others may repeat names or differ from them in case alone."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{df.columns.index(n)}").alias(n) for n in names])


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """All columns renamed by position, and the new names of the named ones."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain, [f"c{df.columns.index(n)}" for n in names]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
