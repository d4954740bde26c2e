"""Dashboard filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_date_range(
    df: DataFrame, first: dt.date | None, last: dt.date | None, column: str = "date_key"
) -> DataFrame:
    """Rows from ``first`` to ``last``, both included; an open end is ``None``.

    When the frame has ``year`` and ``month`` columns (the fact is partitioned by
    them) the implied bounds on both are added, so that the files of other months
    are never listed.
    """
    folders = {"year", "month"} <= set(df.columns)
    year, month = F.col("year"), F.col("month")
    if first is not None:
        df = df.filter(F.col(column) >= F.lit(first))
        if folders:
            df = df.filter((year > first.year) | ((year == first.year) & (month >= first.month)))
    if last is not None:
        df = df.filter(F.col(column) <= F.lit(last))
        if folders:
            df = df.filter((year < last.year) | ((year == last.year) & (month <= last.month)))
    return df


def of_account_type(df: DataFrame, account_types: Collection[str], column: str = "account_type") -> DataFrame:
    """Rows of the chosen account types; choosing none means all."""
    return df.filter(F.col(column).isin(*account_types)) if account_types else df
