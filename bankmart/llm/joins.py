"""Joins whose small side is broadcast only after its size is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_BYTES = 32 << 20


def small(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """A stored frame, marked for broadcast if its rows take ``SMALL_BYTES`` at most; else Spark joins it by shuffle.

    ``row_bytes`` is an upper bound for rows of fixed width, or else a column that gives each row's own.
    """
    taken = df.count() * row_bytes if isinstance(row_bytes, int) else df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if taken <= SMALL_BYTES else df
