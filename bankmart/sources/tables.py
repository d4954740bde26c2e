"""The cleaned Parquet zone and the named base tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from bankmart.schemas import BASE_TABLES


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def base_tables(
    spark: SparkSession, database: str | None = None, names: Iterable[str] = tuple(BASE_TABLES)
) -> dict[str, DataFrame]:
    """Tables by name, from a catalog database or from temporary views."""
    prefix = f"`{database}`." if database else ""
    return {name: spark.table(f"{prefix}`{name}`") for name in names}


def constant_rows(spark: SparkSession, column: str, *values: int | None) -> DataFrame:
    """A one-column model of given values, one row each; ``None`` is null."""
    return spark.createDataFrame([(value,) for value in values], f"`{column}` int")
