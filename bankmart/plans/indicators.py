"""Dashboard indicators over the star schema.

The tables hold no branch and no balance history. A branch is the customer's
region, and the rolling average is one of daily account volumes, not of a ledger
balance.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.operators.filters import in_date_range, of_account_type
from bankmart.operators.windows import rolling_average
from bankmart.plans.analytics import TOTAL

OPEN = "OPEN"


def daily_volume(
    transactions: DataFrame, calendar: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Transactions and amount per calendar day; days without any show 0."""
    per_day = (
        in_date_range(transactions, first, last)
        .groupBy("date_key")
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("transaction_amount").alias("total_amount"))
    )
    days = in_date_range(calendar, first, last).select("date_key")
    return days.join(per_day, "date_key", "left").select(
        "date_key",
        F.coalesce("txn_count", F.lit(0)).cast("bigint").alias("txn_count"),
        F.coalesce("total_amount", F.lit(0)).cast(TOTAL).alias("total_amount"),
    )


def undated_volume(transactions: DataFrame) -> DataFrame:
    """Transactions without a date and their amount, which ``daily_volume`` and ``rolling_30d`` leave out."""
    undated = transactions.filter(F.col("date_key").isNull())
    return undated.agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.coalesce(F.sum("transaction_amount"), F.lit(0)).cast(TOTAL).alias("total_amount"),
    )


def branch_liquidity(accounts: DataFrame) -> DataFrame:
    """Balance of open accounts per region."""
    return (
        accounts.filter(F.col("account_status") == OPEN)
        .groupBy("customer_region")
        .agg(F.count(F.lit(1)).alias("open_accounts"), F.sum("balance").cast(TOTAL).alias("total_balance"))
    )


def balance_distribution(accounts: DataFrame, width: int = 50_000) -> DataFrame:
    """Accounts per type and balance bucket ``[bucket_from, bucket_from + width)``."""
    bucket = (F.floor(F.col("balance") / F.lit(width)) * width).cast("bigint")
    return accounts.groupBy("account_type", bucket.alias("bucket_from")).agg(
        F.count(F.lit(1)).alias("account_count")
    )


def rolling_30d(
    transactions: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
    days: int = 30,
) -> DataFrame:
    """Average daily volume per account over the ``days`` calendar days up to each day.

    A chosen range selects output days. The input reaches ``days - 1`` further
    back, so that the first days of the range see their whole window.
    """
    reach = None if first is None else first - dt.timedelta(days=days - 1)
    per_day = (
        in_date_range(transactions, reach, last)
        .filter(F.col("date_key").isNotNull())
        .groupBy("account_id", "date_key")
        .agg(F.sum("transaction_amount").cast(TOTAL).alias("daily_amount"))
    )
    rolled = rolling_average(per_day, "account_id", "date_key", "daily_amount", days, "rolling_avg")
    return in_date_range(rolled, first, None)


def branch_volume_rank(
    transactions: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Regions ranked by transaction amount. The ranking sees one row per region."""
    by_amount = Window.orderBy(F.col("total_amount").desc_nulls_first())
    return (
        in_date_range(transactions, first, last)
        .groupBy("customer_region")
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("transaction_amount").cast(TOTAL).alias("total_amount"))
        .withColumn("volume_rank", F.rank().over(by_amount).cast("bigint"))
    )


def account_type_breakdown(accounts: DataFrame, account_types: Collection[str] = ()) -> DataFrame:
    """Accounts and balance per type, for the chosen types or all."""
    return (
        of_account_type(accounts, account_types)
        .groupBy("account_type")
        .agg(F.count(F.lit(1)).alias("account_count"), F.sum("balance").cast(TOTAL).alias("total_balance"))
    )
