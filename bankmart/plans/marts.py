"""Star schema: four dimensions and the transaction fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart.functions import dates
from bankmart.functions.dates import AsOf
from bankmart.functions.text import hierarchy_label
from bankmart.operators.balance import NONE_HOT, HotKeys, balanced_left_join
from bankmart.operators.calendar import date_spine

# Upper age bound (not included) and label of each bucket.
AGE_BUCKETS = ((25, "18-24"), (35, "25-34"), (50, "35-49"), (65, "50-64"))
OLDEST_BUCKET = "65+"
UNKNOWN_AGE = "Unknown"

# Statuses behind the fact's flags, as spelled after staging. The second is a default.
FAILED_STATUS = "FAILED"
COMPLETED_STATUS = "COMPLETED"


def _age_bucket(born: Column, on: Column) -> Column:
    """Bucket of the age in whole years; a missing or unreadable date is unknown."""
    age = dates.whole_years(born, on)
    bucket = F.when(born.isNull(), UNKNOWN_AGE)
    for bound, label in AGE_BUCKETS:
        bucket = bucket.when(age < bound, label)
    return bucket.otherwise(OLDEST_BUCKET)


def dim_customer(stg_customers: DataFrame, as_of: AsOf = None) -> DataFrame:
    born = dates.birth_date(F.col("date_of_birth"))
    return stg_customers.select(
        "customer_id", "full_name", "date_of_birth", "gender", "region", "email", "status", "join_date",
        _age_bucket(born, dates.today(as_of)).alias("age_bucket"),
    )


def dim_account(
    stg_accounts: DataFrame, customers: DataFrame, as_of: AsOf = None, hot_customers: HotKeys = NONE_HOT
) -> DataFrame:
    """Accounts with their customer's name, region and status, and their age."""
    owner = customers.select(
        "customer_id",
        F.col("full_name").alias("customer_name"),
        F.col("region").alias("customer_region"),
        F.col("status").alias("customer_status"),
    )
    age = dates.today(as_of).cast("timestamp_ntz") - F.col("open_date")
    return balanced_left_join(stg_accounts, owner, "customer_id", "account_id", hot_customers).select(
        "account_id", "customer_id", "customer_name", "customer_region", "account_type",
        "open_date", "closed_date", F.col("status").alias("account_status"), "customer_status",
        "registration_id", "balance", age.alias("account_age_days"),
    )


def dim_product(stg_products: DataFrame) -> DataFrame:
    label = hierarchy_label(F.col("category_name"), F.col("sub_category_name"), F.col("product_name"))
    return stg_products.select("*", label.alias("product_hierarchy"))


def _calendar_columns(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "month_name": dates.padded_name(date, "MMMM"),
        "day": F.dayofmonth(date),
        "day_of_week": dates.day_of_week(date),
        "day_name": dates.padded_name(date, "EEEE"),
        "quarter": F.quarter(date),
        "quarter_label": dates.quarter_label(date),
        "week_of_year": F.weekofyear(date),
        "is_weekend": dates.is_weekend(date),
    }


def dim_date(transactions: DataFrame, date: str = "transaction_date") -> DataFrame:
    """One row per calendar day of the transaction date range, gaps filled."""
    spine = date_spine(transactions, date, "date_key")
    columns = [column.alias(name) for name, column in _calendar_columns(F.col("date_key")).items()]
    return spine.select("date_key", F.col("date_key").alias("full_date"), *columns)


def fact_transactions(
    stg_transactions: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    calendar: DataFrame | None = None,
    hot_accounts: HotKeys = NONE_HOT,
    hot_products: HotKeys = NONE_HOT,
    completed_status: str = COMPLETED_STATUS,
    hot_dates: HotKeys = NONE_HOT,
) -> DataFrame:
    """One row per transaction with the attributes of its account, product and day.

    The calendar dimension spans exactly the dates of these transactions, so its
    attributes are computed from the date itself: the same rows without reading
    the fact a second time for its date range and without a join. Pass
    ``calendar`` to join a stored calendar with other contents instead.

    The account and product sides keep no ``broadcast`` hint: Spark broadcasts
    them below its size threshold and otherwise shuffles, where busy accounts and
    products are split if their keys are given.
    """
    account = accounts.select("account_id", "customer_id", "account_type", "account_status", "customer_region")
    product = products.select("product_id", "product_name", "sub_category_name", "category_name")
    rows = stg_transactions.withColumnRenamed("status", "transaction_status")
    rows = balanced_left_join(rows, account, "account_id", "transaction_id", hot_accounts)
    rows = balanced_left_join(rows, product, "product_id", "transaction_id", hot_products)
    day_columns = ["year", "month", "quarter", "quarter_label", "is_weekend"]
    if calendar is None:
        derived = _calendar_columns(F.col("transaction_date"))
        rows = rows.withColumns({name: derived[name] for name in day_columns})
    else:
        days = calendar.select(F.col("date_key").alias("transaction_date"), *day_columns)
        rows = balanced_left_join(rows, days, "transaction_date", "transaction_id", hot_dates)

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    return rows.select(
        "transaction_id", "account_id", "customer_id", "product_id",
        F.col("transaction_date").alias("date_key"),
        "transaction_type", "transaction_channel", "transaction_status",
        "account_type", "account_status", "customer_region",
        "product_name", "sub_category_name", "category_name", *day_columns,
        "transaction_amount",
        flag(F.col("transaction_status") == FAILED_STATUS).alias("is_failed"),
        flag(F.col("transaction_status") == completed_status).alias("is_completed"),
        flag(F.col("is_weekend")).alias("is_weekend_txn"),
    )
