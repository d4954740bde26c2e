import datetime as dt

from helpers import base, day, money, plan_of, rows, settings
from pyspark.sql import Window
from pyspark.sql import functions as F

from bankmart.plans import analytics


def transactions(spark, *records):
    return base(spark, "FactTransaction", *records)


def test_monthly_revenue(spark):
    def txn(date, kind, amount, status="Success"):
        return {"TransactionDate": date and day(date), "TransactionType": kind, "TransactionAmount": amount, "Status": status}

    df = transactions(
        spark,
        txn("2024-01-05", "credit", 10.0), txn("2024-01-31 23:59:59", "credit", 0.01), txn("2024-01-07", "debit", 5.0),
        txn("2024-03-01", "credit", 1.0), txn("2024-03-01", None, 2.0), txn("2024-03-02", "debit", None),
        txn("2024-02-01", "credit", 99.0, "Failed"), txn(None, "credit", 99.0), txn("2024-02-01", "credit", 9.0, "SUCCESS"),
    )
    january, march = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)
    got = [tuple(r) for r in analytics.monthly_revenue(df).collect()]
    m = money
    assert got == [
        (january, "credit", 2, m("10.01"), m("5.01"), m("10.01"), m("15.01")),
        (january, "debit", 1, m("5.00"), m("5.00"), m("5.00"), m("15.01")),
        (march, "credit", 1, m("1.00"), m("1.00"), m("11.01"), m("18.01")),
        (march, "debit", 1, None, None, m("5.00"), m("18.01")),
        (march, None, 1, m("2.00"), m("2.00"), m("2.00"), m("18.01")),
    ]


def test_last_running_total_is_the_grand_total(spark):
    df = spark.range(500).select(
        F.lit(1).alias("AccountID"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 400).cast("int")).cast("timestamp_ntz").alias("TransactionDate"),
        (F.col("id") * 1.25).alias("TransactionAmount"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("TransactionType"),
        F.lit("Success").alias("Status"),
    )
    last = analytics.monthly_revenue(df).collect()[-1]
    assert last.overall_running_total == money(f"{sum(i * 1.25 for i in range(500)):.2f}")


def customer_case(spark):
    """25 customers with one account, 24..0 in spend; the 20th and 21st tie. A 26th has no success."""
    accounts = [{"AccountID": 100 + c, "CustomerID": c} for c in range(26)]
    accounts += [{"AccountID": 999, "CustomerID": None}, {"AccountID": 500, "CustomerID": 0}]
    customers = [{"CustomerID": c, "FullName": f"N{c}", "Region": "R", "Status": "Active"} for c in range(26)]
    spends = {c: float(100 - c) for c in range(25)} | {20: 81.0}
    records = [
        {"TransactionID": c, "AccountID": 100 + c, "TransactionAmount": spend, "Status": "Success",
         "TransactionDate": day("2024-01-01")}
        for c, spend in spends.items()
    ]
    records += [
        {"TransactionID": 200, "AccountID": 500, "TransactionAmount": 50.0, "Status": "Success",
         "TransactionDate": day("2024-02-02")},
        {"TransactionID": 201, "AccountID": 125, "TransactionAmount": 9999.0, "Status": "Failed"},
        {"TransactionID": 202, "AccountID": 999, "TransactionAmount": 9999.0, "Status": "Success"},
        {"TransactionID": 203, "AccountID": None, "TransactionAmount": 9999.0, "Status": "Success"},
    ]
    return transactions(spark, *records), base(spark, "DimAccount", *accounts), base(spark, "DimCustomer", *customers)


def test_top_customers_over_several_accounts_with_a_tie_at_the_cut(spark):
    got = analytics.top_customers(*customer_case(spark)).collect()
    assert len(got) == 20
    first = got[0]
    assert (first.CustomerID, first.txn_count, first.total_spent, first.avg_txn_amount) == (
        0, 2, money("150.00"), money("75.00"),
    )
    assert (first.last_transaction_date, first.spend_rank, first.spend_percentile) == (day("2024-02-02"), 1, money("100.0"))
    # Customers 19 and 20 both spent 81: the smaller id is kept, and 4 of the other 24 spent less.
    assert (got[-1].CustomerID, got[-1].spend_rank, got[-1].spend_percentile) == (19, 20, money("16.7"))


def test_top_customers_equals_the_literal_windows(spark):
    tables = customer_case(spark)
    spend = analytics.customer_spend(*tables)
    literal = spend.select(
        "CustomerID",
        F.rank().over(Window.orderBy(F.col("total_spent").desc_nulls_first())).alias("r"),
        F.round(F.percent_rank().over(Window.orderBy(F.col("total_spent").asc_nulls_last())) * 100, 1).alias("p"),
    ).orderBy("r", "CustomerID").limit(20)
    scaled = analytics.top_customers(*tables).select("CustomerID", "spend_rank", F.col("spend_percentile").cast("double"))
    assert rows(literal) == rows(scaled)


def test_customer_spend_shuffles_only_aggregated_transactions(spark):
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        plan = plan_of(analytics.customer_spend(*customer_case(spark)))
    # per account, accounts, per customer, customers; the last grouping adds none
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("SortMergeJoin") == 2


def product_case(spark):
    products = base(
        spark, "DimProduct",
        {"ProductID": 1, "ProductSubcategoryID": 10, "ProductName": "A"},
        {"ProductID": 2, "ProductSubcategoryID": 10, "ProductName": "B"},
        {"ProductID": 3, "ProductSubcategoryID": 10, "ProductName": "C"},
        {"ProductID": 4, "ProductSubcategoryID": 11, "ProductName": "A"},
        {"ProductID": 5, "ProductSubcategoryID": None, "ProductName": "outside"},
    )
    sub_categories = base(
        spark, "DimProductSubCategory",
        {"ProductSubCategoryID": 10, "ProductCategoryID": 7, "ProductSubCategoryName": "S"},
        {"ProductSubCategoryID": 11, "ProductCategoryID": 7, "ProductSubCategoryName": "T"},
    )
    categories = base(spark, "DimProductCategory", {"ProductCategoryID": 7, "ProductCategoryName": "Cat"})
    outcomes = {1: "SSF", 2: "SSSSFF", 3: "SS", 4: "F", 5: "F", None: "F", 77: "F"}
    names = {"S": "Success", "F": "Failed"}
    records = [
        {"TransactionID": i * 100 + (product or 0), "ProductID": product, "TransactionAmount": 1.5, "Status": names[o]}
        for product, text in outcomes.items() for i, o in enumerate(text)
    ]
    records.append({"TransactionID": None, "ProductID": 3, "TransactionAmount": 4.0, "Status": "Failed"})
    return transactions(spark, *records), products, sub_categories, categories


def test_failure_risk(spark):
    got = [tuple(r) for r in analytics.failure_risk(*product_case(spark)).collect()]
    m = money
    assert sorted(got, key=lambda r: (-r[6], r[2])) == [
        ("Cat", "T", "A", 1, 0, 1, m("100.00"), m("1.50"), m("1.50"), 1),
        ("Cat", "S", "A", 3, 2, 1, m("33.33"), m("4.50"), m("1.50"), 2),
        ("Cat", "S", "B", 6, 4, 2, m("33.33"), m("9.00"), m("3.00"), 2),
        ("Cat", "S", "C", 2, 2, 0, m("0.00"), m("7.00"), m("4.00"), 4),
    ]
    assert [r[6] for r in got] == sorted([r[6] for r in got], reverse=True)


def test_failed_volume_is_null_without_failures_and_rate_null_without_ids(spark):
    _, *hierarchy = product_case(spark)
    df = transactions(
        spark,
        {"TransactionID": 1, "ProductID": 1, "TransactionAmount": 2.0, "Status": "Success"},
        {"TransactionID": None, "ProductID": 2, "TransactionAmount": 2.0, "Status": "Success"},
    )
    got = analytics.failure_risk(df, *hierarchy)
    assert rows(got, "productname", "total_txns", "failure_rate_pct", "failed_volume", "risk_rank_in_category") == [
        ("A", 1, money("0.00"), None, 2), ("B", 0, None, None, 1),
    ]


def test_product_volume_rank_merges_equal_names(spark):
    got = [tuple(r) for r in analytics.product_volume_rank(*product_case(spark)).collect()]
    assert got == [
        ("Cat", "B", 6, 2, money("9.00"), 1),
        ("Cat", "A", 4, 2, money("6.00"), 2),
        ("Cat", "C", 2, 0, money("7.00"), 3),
    ]


def test_product_volume_rank_sub_looks_for_upper_case_outcomes(spark):
    tables = product_case(spark)
    got = analytics.product_volume_rank_sub(*tables)
    assert rows(got.select("completed", "failed").distinct()) == [(0, 0)]
    spelled = analytics.product_volume_rank_sub(*tables, completed="Success", failed="Failed")
    assert [tuple(r) for r in spelled.select("sub_category", "productname", "completed", "failed", "volume_rank").collect()] == [
        ("S", "B", 4, 2, 1), ("S", "A", 2, 1, 2), ("S", "C", 2, 0, 3), ("T", "A", 0, 1, 4),
    ]


def test_row_counts(spark):
    assert rows(analytics.row_counts({"A": spark.range(3), "B": spark.range(0)})) == [("A", 3), ("B", 0)]
