"""Staging models: base tables renamed, trimmed and typed. Lazy, no shuffle but the product joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.functions.numbers import money
from bankmart.functions.text import lower_trimmed, trimmed, upper_trimmed
from bankmart.operators.balance import NONE_HOT, HotKeys, balanced_left_join
from bankmart.schemas import INGESTED_AT


def stg_transactions(transactions: DataFrame) -> DataFrame:
    """Transactions that have an id, an account and an amount."""
    complete = transactions.filter(
        F.col("TransactionID").isNotNull()
        & F.col("AccountID").isNotNull()
        & F.col("TransactionAmount").isNotNull()
    )
    return complete.select(
        F.col("TransactionID").alias("transaction_id"),
        F.col("AccountID").alias("account_id"),
        F.col("ProductID").alias("product_id"),
        F.col("TransactionDate").cast("date").alias("transaction_date"),
        money(F.col("TransactionAmount")).alias("transaction_amount"),
        upper_trimmed(F.col("TransactionType")).alias("transaction_type"),
        upper_trimmed(F.col("TransactionChannel")).alias("transaction_channel"),
        upper_trimmed(F.col("Status")).alias("status"),
        F.col(INGESTED_AT),
    )


def stg_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.filter(F.col("AccountID").isNotNull()).select(
        F.col("AccountID").alias("account_id"),
        F.col("CustomerID").alias("customer_id"),
        trimmed(F.col("AccountType")).alias("account_type"),
        F.col("OpenDate").alias("open_date"),
        F.col("ClosedDate").alias("closed_date"),
        upper_trimmed(F.col("Status")).alias("status"),
        F.col("RegistrationID").alias("registration_id"),
        money(F.col("Balance")).alias("balance"),
        F.col(INGESTED_AT),
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("CustomerID").isNotNull()).select(
        F.col("CustomerID").alias("customer_id"),
        trimmed(F.col("FullName")).alias("full_name"),
        F.col("DOB").alias("date_of_birth"),
        trimmed(F.col("Gender")).alias("gender"),
        trimmed(F.col("Region")).alias("region"),
        lower_trimmed(F.col("Email")).alias("email"),
        upper_trimmed(F.col("Status")).alias("status"),
        F.col("JoinDate").alias("join_date"),
        F.col(INGESTED_AT),
    )


def stg_products(
    products: DataFrame, sub_categories: DataFrame, categories: DataFrame, hot_sub_categories: HotKeys = NONE_HOT
) -> DataFrame:
    """Products with their sub-category and category, both optional.

    The category is joined to the sub-categories first: two short tables, and
    the products are joined once. Hot sub-categories, and products without one,
    are dealt out if given.
    """
    category = categories.select(
        F.col("ProductCategoryID").alias("category_id"),
        trimmed(F.col("ProductCategoryName")).alias("category_name"),
    )
    sub_category = sub_categories.select(
        F.col("ProductSubCategoryID").alias("sub_category_id"),
        trimmed(F.col("ProductSubCategoryName")).alias("sub_category_name"),
        F.col("ProductCategoryID").alias("_category"),
    ).join(category, F.col("_category") == F.col("category_id"), "left")
    product = products.filter(F.col("ProductID").isNotNull()).select(
        F.col("ProductID").alias("product_id"),
        trimmed(F.col("ProductName")).alias("product_name"),
        F.col("ProductSubcategoryID").alias("_sub_category"),
    )
    keyed = sub_category.withColumn("_sub_category", F.col("sub_category_id"))
    return balanced_left_join(product, keyed, "_sub_category", "product_id", hot_sub_categories).select(
        "product_id", "product_name", "sub_category_id", "sub_category_name", "category_id", "category_name"
    )
