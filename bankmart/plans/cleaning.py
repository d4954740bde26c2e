"""Cleaning jobs: raw text columns in, typed base table rows out.

Each job takes the frame of ``sources.raw.read_csv`` (or any frame of text
columns with the same names). Types are applied before the deduplication, so
``7`` and ``7.0`` are one key and the shuffle carries typed columns. An ``observation``
counts the values per column that could not be read, in the same pass.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bankmart.operators.dedup import SOURCE_ORDER, drop_null_keys, keep_first
from bankmart.schemas import INGESTED_AT
from bankmart.sources.raw import typed


def _stamped(df: DataFrame) -> DataFrame:
    return df.drop(SOURCE_ORDER).withColumn(INGESTED_AT, F.current_timestamp())


# What an account is told apart by. By customer, all but one of a customer's accounts are dropped.
ACCOUNT_KEYS = ("AccountID", "CustomerID")


def clean_account(
    raw: DataFrame, key: str = "AccountID", date_format: str | None = None, observation: Observation | None = None
) -> DataFrame:
    """Accounts with a customer; first row per ``key``; missing balance is 0.

    ``key="CustomerID"`` keeps one account per customer and drops their others.
    """
    rows = drop_null_keys(typed(raw, "DimAccount", date_format, observation=observation), "CustomerID", key)
    rows = keep_first(rows, [key])
    return _stamped(rows.withColumn("Balance", F.coalesce("Balance", F.lit(0.0))))


def clean_customer(
    raw: DataFrame, date_format: str | None = None, table: str = "DimCustomer", observation: Observation | None = None
) -> DataFrame:
    """First row per customer id; rows without one are dropped."""
    rows = drop_null_keys(typed(raw, table, date_format, observation=observation), "CustomerID")
    return _stamped(keep_first(rows, ["CustomerID"]))


clean_customer_usa = partial(clean_customer, table="DimCustomerUSA")


def clean_transaction(
    raw: DataFrame, date_format: str | None = None, observation: Observation | None = None
) -> DataFrame:
    """First row per transaction id; rows without one are dropped."""
    rows = drop_null_keys(typed(raw, "FactTransaction", date_format, observation=observation), "TransactionID")
    return _stamped(keep_first(rows, ["TransactionID"]))


def _unchanged(raw: DataFrame, table: str, observation: Observation | None = None) -> DataFrame:
    return typed(raw, table, observation=observation).drop(SOURCE_ORDER)


clean_product = partial(_unchanged, table="DimProduct")
clean_product_sub_category = partial(_unchanged, table="DimProductSubCategory")
clean_product_category = partial(_unchanged, table="DimProductCategory")

CLEANING_JOBS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "DimProductCategory": clean_product_category,
    "DimProductSubCategory": clean_product_sub_category,
    "DimProduct": clean_product,
    "DimCustomer": clean_customer,
    "DimCustomerUSA": clean_customer_usa,
    "DimAccount": clean_account,
    "FactTransaction": clean_transaction,
}
