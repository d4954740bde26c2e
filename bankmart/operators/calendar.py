"""Calendar rows between the first and the last date of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine(df: DataFrame, column: str, output: str) -> DataFrame:
    """One row per calendar day from min to max of ``column``, none for no dates.

    Both ends come from a single pass, and the result has one row per day
    whatever the number of input rows.
    """
    ends = df.agg(F.min(column).alias("_first"), F.max(column).alias("_last"))
    return ends.select(F.explode(F.sequence("_first", "_last")).alias(output))
