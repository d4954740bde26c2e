"""Null-key filter and keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Position of a row in its source, added by the raw CSV scan.
SOURCE_ORDER = "_source_order"


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in which no key is null; plain null tests, which reach the scan."""
    return reduce(lambda rows, key: rows.filter(F.col(key).isNotNull()), keys, df)


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first in ``order_by``, nulls first.

    By default that is the source position when the frame carries one, and
    otherwise the smallest row over all other columns, so the choice never
    depends on task order. Spark limits each group to one row before the shuffle
    (``WindowGroupLimit``), so a key with very many copies sends at most one row
    per map task.
    """
    if order_by is None:
        has_position = SOURCE_ORDER in df.columns
        order_by = [SOURCE_ORDER] if has_position else [c for c in df.columns if c not in keys]
    ordering = [F.col(c).asc_nulls_first() for c in order_by] or [F.lit(0)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")
