"""Aggregating before the joins must equal joining first, for any keys: missing, repeated or without a partner."""

from helpers import base, rows
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bankmart.functions.numbers import money
from bankmart.plans import analytics

FEW = hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
KEY = st.one_of(st.none(), st.integers(1, 4))
TRANSACTIONS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(1, 99)), KEY, KEY, st.one_of(st.none(), st.integers(-500, 500)),
        st.sampled_from(["Success", "Failed", "Other", None]),
    ),
    max_size=25,
)
LINKS = st.lists(st.tuples(KEY, KEY), max_size=8)


def transactions(spark, records):
    return base(
        spark, "FactTransaction",
        *[
            {"TransactionID": i, "AccountID": a, "ProductID": p, "TransactionAmount": c and c / 100, "Status": s}
            for i, a, p, c, s in records
        ],
    )


@FEW
@given(TRANSACTIONS, LINKS, st.lists(KEY, max_size=6))
def test_customer_spend(spark, records, links, customer_ids):
    facts = transactions(spark, records)
    accounts = base(spark, "DimAccount", *[{"AccountID": a, "CustomerID": c} for a, c in links])
    customers = base(
        spark, "DimCustomer", *[{"CustomerID": c, "FullName": f"n{i % 2}"} for i, c in enumerate(customer_ids)]
    )
    literal = (
        facts.filter("Status = 'Success'")
        .join(accounts.select("AccountID", "CustomerID"), "AccountID")
        .join(customers.select("CustomerID", "FullName"), "CustomerID")
        .groupBy("CustomerID", "FullName")
        .agg(
            F.count("TransactionID").alias("n"),
            F.sum(money(F.col("TransactionAmount"))).cast("decimal(25,2)").alias("total"),
            F.count("TransactionAmount").alias("amounts"),
        )
    )
    early = analytics.customer_spend(facts, accounts, customers)
    assert rows(early, "CustomerID", "FullName", "txn_count", "total_spent", "amount_count") == rows(literal)


@FEW
@given(TRANSACTIONS, LINKS, LINKS, st.lists(KEY, max_size=4))
def test_product_outcomes(spark, records, products, sub_categories, categories):
    facts = transactions(spark, records)
    product = base(
        spark, "DimProduct",
        *[{"ProductID": p, "ProductSubcategoryID": s, "ProductName": f"p{i % 2}"} for i, (p, s) in enumerate(products)],
    )
    sub_category = base(
        spark, "DimProductSubCategory",
        *[{"ProductSubCategoryID": s, "ProductCategoryID": c, "ProductSubCategoryName": f"s{i % 2}"}
          for i, (s, c) in enumerate(sub_categories)],
    )
    category = base(
        spark, "DimProductCategory", *[{"ProductCategoryID": c, "ProductCategoryName": "c"} for c in categories]
    )
    failed = F.col("Status") == "Failed"
    literal = (
        facts.join(product.select("ProductID", F.col("ProductSubcategoryID").alias("sub"), "ProductName"), "ProductID")
        .join(sub_category, F.col("sub") == F.col("ProductSubCategoryID"))
        .join(category, "ProductCategoryID")
        .groupBy("ProductCategoryName", "ProductSubCategoryName", "ProductName")
        .agg(
            F.count("TransactionID"),
            F.count(F.when(F.col("Status") == "Success", F.col("TransactionID"))),
            F.count(F.when(failed, F.col("TransactionID"))),
            F.sum(money(F.col("TransactionAmount"))).cast("decimal(25,2)"),
            F.sum(F.when(failed, money(F.col("TransactionAmount")))).cast("decimal(25,2)"),
        )
    )
    early = analytics.product_outcomes(
        ["category", "sub_category", "productname"], facts, product, sub_category, category, "Success", "Failed"
    )
    assert rows(early) == rows(literal)
