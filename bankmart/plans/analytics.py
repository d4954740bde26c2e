"""Analytical queries over the base tables.

Each aggregates the fact by the fact's own key before any join, so a transaction
row crosses the network at most once, as a partial aggregate: a very busy account
or product leaves a map task as one row, and the joins see one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart.functions.dates import month_start
from bankmart.functions.numbers import exact_average, exact_ratio, money, percent
from bankmart.operators.windows import rank_and_percentile, rank_within, running_total, top_with_percentile
from bankmart.store import written

# Transaction outcomes as spelled in the base tables, and as
# spelled in the variant that ranks by sub-category.
SUCCESS, FAILED = "Success", "Failed"
COMPLETED_UPPER, FAILED_UPPER = "COMPLETED", "FAILED"

TOTAL = "decimal(25,2)"


def _sum(value: str | Column) -> Column:
    return F.sum(value).cast(TOTAL)


def _count_where(condition: Column, value: str) -> Column:
    return F.count(F.when(condition, F.col(value)))


def report_order(name: str) -> list[Column]:
    """The order of a report's rows, total if product names are unique within their sub-category."""
    first, last = lambda c: F.col(c).asc_nulls_first(), lambda c: F.col(c).asc_nulls_last()
    largest = lambda c: F.col(c).desc_nulls_first()
    orders = {
        "monthly_revenue": [last("month"), last("transactiontype")],
        "top_customers": [first("spend_rank"), first("CustomerID")],
        "customer_percentiles": [first("spend_rank"), first("CustomerID")],
        "failure_risk": [largest("failure_rate_pct"), first("category"), first("sub_category"), first("productname")],
        "product_volume_rank": [largest("total_txns"), first("category"), first("productname")],
        "product_volume_rank_sub": [largest("total_txns"), first("category"), first("sub_category"), first("productname")],
    }
    if name not in orders:
        raise ValueError(f"{name} has no order")
    return orders[name]


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    """Successful amounts per month and type, with running totals.

    The monthly sums are written, since two branches read them and a lazy plan
    would scan the fact for each. The overall total runs over one row per
    calendar month, never over the types.
    """
    monthly = written(
        transactions.filter((F.col("Status") == SUCCESS) & F.col("TransactionDate").isNotNull())
        .select(
            month_start(F.col("TransactionDate")).alias("month"),
            F.col("TransactionType").alias("transactiontype"),
            money(F.col("TransactionAmount")).alias("amount"),
        )
        .groupBy("month", "transactiontype")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.sum("amount").alias("total_amount"),
            F.count("amount").alias("amount_count"),
        ),
        "monthly",
    )
    overall = (
        monthly.groupBy("month")
        .agg(F.sum("total_amount").alias("month_total"))
        .select("month", running_total("month_total", "month").cast(TOTAL).alias("overall_running_total"))
    )
    by_type = monthly.withColumn(
        "running_total_by_type", running_total("total_amount", "month", "transactiontype").cast(TOTAL)
    )
    return (
        by_type.join(overall, "month")
        .select(
            "month", "transactiontype", "txn_count", "total_amount",
            exact_average(F.col("total_amount"), F.col("amount_count")).alias("avg_amount"),
            "running_total_by_type", "overall_running_total",
        )
        .orderBy(*report_order("monthly_revenue"))
    )


def customer_spend(transactions: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Successful spend per customer: per account first, then per customer, then the names."""
    per_account = (
        transactions.filter(F.col("Status") == SUCCESS)
        .groupBy("AccountID")
        .agg(
            F.count("TransactionID").alias("txn_count"),
            F.sum(money(F.col("TransactionAmount"))).alias("total_spent"),
            F.count("TransactionAmount").alias("amount_count"),
            F.max("TransactionDate").alias("last_transaction_date"),
        )
    )

    def merged(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.sum("txn_count").alias("txn_count"),
            _sum("total_spent").alias("total_spent"),
            F.sum("amount_count").alias("amount_count"),
            F.max("last_transaction_date").alias("last_transaction_date"),
        )

    per_customer = merged(per_account.join(accounts.select("AccountID", "CustomerID"), "AccountID"), "CustomerID")
    named = per_customer.join(
        customers.select("CustomerID", "FullName", "Region", F.col("Status").alias("customer_status")), "CustomerID"
    )
    # Needs no further shuffle; it only matters if a customer id is not unique.
    return merged(named, "CustomerID", "FullName", "Region", "customer_status")


def top_customers(transactions: DataFrame, accounts: DataFrame, customers: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` customers who spent most, with rank and spend percentile.

    The spend per customer is written before the top-k reads it again.
    """
    spend = written(customer_spend(transactions, accounts, customers), "customer-spend")
    ranked = top_with_percentile(spend, "total_spent", k, "CustomerID", "spend_rank", "spend_percentile")
    return _spend_report(ranked).orderBy(*report_order("top_customers"))


def _spend_report(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        "CustomerID", "FullName", "Region", "customer_status", "txn_count", "total_spent",
        exact_average(F.col("total_spent"), F.col("amount_count")).alias("avg_txn_amount"),
        "last_transaction_date", "spend_rank", "spend_percentile",
    )


def customer_percentiles(transactions: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Every customer with successful spend, with rank and spend percentile among all of them.

    Not sorted: there are as many rows as customers.
    """
    spend = written(customer_spend(transactions, accounts, customers), "customer-spend")
    return _spend_report(rank_and_percentile(spend, "total_spent", "spend_rank", "spend_percentile"))


def product_outcomes(
    keys: list[str],
    transactions: DataFrame,
    products: DataFrame,
    sub_categories: DataFrame,
    categories: DataFrame,
    completed: str,
    failed: str,
) -> DataFrame:
    """Transaction outcomes per product attributes: the fact by product, then the hierarchy.

    Column names are lowered to join by name: the product table spells the
    sub-category key differently.
    """
    is_failed = F.col("Status") == failed
    per_product = (
        transactions.filter(F.col("ProductID").isNotNull())
        .select("TransactionID", "ProductID", "Status", money(F.col("TransactionAmount")).alias("amount"))
        .groupBy(F.col("ProductID").alias("productid"))
        .agg(
            F.count("TransactionID").alias("total_txns"),
            _count_where(F.col("Status") == completed, "TransactionID").alias("completed"),
            _count_where(is_failed, "TransactionID").alias("failed"),
            F.sum("amount").alias("total_volume"),
            F.sum(F.when(is_failed, F.col("amount"))).alias("failed_volume"),
        )
    )
    category = categories.select(
        F.col("ProductCategoryID").alias("categoryid"), F.col("ProductCategoryName").alias("category")
    )
    hierarchy = sub_categories.select(
        F.col("ProductSubCategoryID").alias("subcategoryid"),
        F.col("ProductCategoryID").alias("categoryid"),
        F.col("ProductSubCategoryName").alias("sub_category"),
    ).join(category, "categoryid")
    product = products.select(
        F.col("ProductID").alias("productid"),
        F.col("ProductSubcategoryID").alias("subcategoryid"),
        F.col("ProductName").alias("productname"),
    )
    return (
        per_product.join(product, "productid")
        .join(hierarchy, "subcategoryid")
        .groupBy(*keys)
        .agg(
            F.sum("total_txns").alias("total_txns"),
            F.sum("completed").alias("completed"),
            F.sum("failed").alias("failed"),
            _sum("total_volume").alias("total_volume"),
            _sum("failed_volume").alias("failed_volume"),
        )
    )


def failure_risk(
    transactions: DataFrame, products: DataFrame, sub_categories: DataFrame, categories: DataFrame
) -> DataFrame:
    """Failure rate per product, ranked within its category; failed volume is null without failures."""
    outcomes = product_outcomes(
        ["category", "sub_category", "productname"],
        transactions, products, sub_categories, categories, SUCCESS, FAILED,
    )
    ratio = exact_ratio(F.col("failed"), F.col("total_txns"))
    return rank_within(written(outcomes, "outcomes"), "category", ratio, "risk_rank_in_category").select(
        "category", "sub_category", "productname", "total_txns", "completed", "failed",
        percent(F.col("failed"), F.col("total_txns"), 2).alias("failure_rate_pct"),
        "total_volume", "failed_volume", "risk_rank_in_category",
    ).orderBy(*report_order("failure_risk"))


def product_volume_rank(
    transactions: DataFrame, products: DataFrame, sub_categories: DataFrame, categories: DataFrame
) -> DataFrame:
    """Products ranked by number of transactions within their category."""
    outcomes = product_outcomes(
        ["category", "productname"],
        transactions, products, sub_categories, categories, SUCCESS, FAILED,
    )
    return rank_within(written(outcomes, "outcomes"), "category", F.col("total_txns"), "volume_rank").select(
        "category", "productname", "total_txns", "failed", "total_volume", "volume_rank"
    ).orderBy(*report_order("product_volume_rank"))


def product_volume_rank_sub(
    transactions: DataFrame,
    products: DataFrame,
    sub_categories: DataFrame,
    categories: DataFrame,
    completed: str = COMPLETED_UPPER,
    failed: str = FAILED_UPPER,
) -> DataFrame:
    """As ``product_volume_rank``, per sub-category too and with completed counts."""
    outcomes = product_outcomes(
        ["category", "sub_category", "productname"],
        transactions, products, sub_categories, categories, completed, failed,
    )
    return rank_within(written(outcomes, "outcomes"), "category", F.col("total_txns"), "volume_rank").select(
        "category", "sub_category", "productname", "total_txns", "completed", "failed", "total_volume", "volume_rank"
    ).orderBy(*report_order("product_volume_rank_sub"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
