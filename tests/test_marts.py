import datetime as dt

import pytest
from helpers import base, day, money, one, rows
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from test_staging import product_tables

from bankmart.plans import marts, staging

AS_OF = dt.date(2025, 6, 15)


@pytest.mark.parametrize(
    "born, bucket",
    [
        (None, "Unknown"),
        ("31/02/1990", "Unknown"),
        ("1/2/2020", "18-24"),
        ("16/06/2000", "18-24"),
        ("15/06/2000", "25-34"),
        ("14/06/2000", "25-34"),
        ("15/6/1990", "35-49"),
        ("16/06/1990", "25-34"),
        ("15/06/1975", "50-64"),
        ("16/06/1960", "50-64"),
        ("15/06/1960", "65+"),
    ],
)
def test_age_bucket(spark, born, bucket):
    customers = staging.stg_customers(base(spark, "DimCustomer", {"CustomerID": 1, "DOB": born}))
    assert one(marts.dim_customer(customers, AS_OF).select("date_of_birth", "age_bucket")) == (born, bucket)


def staged_accounts(spark):
    return staging.stg_accounts(
        base(
            spark, "DimAccount",
            {"AccountID": 1, "CustomerID": 7, "OpenDate": day("2025-06-01"), "Status": "open", "Balance": 1.0},
            {"AccountID": 2, "CustomerID": 8, "Status": "closed", "Balance": 2.0},
        )
    )


def test_account_has_owner_and_age(spark):
    customers = marts.dim_customer(
        staging.stg_customers(
            base(spark, "DimCustomer", {"CustomerID": 7, "FullName": "A", "Region": "West", "Status": "Active"})
        ),
        AS_OF,
    )
    accounts = marts.dim_account(staged_accounts(spark), customers, AS_OF)
    assert rows(accounts, "account_id", "customer_name", "customer_region", "customer_status", "account_status") == [
        (1, "A", "West", "ACTIVE", "OPEN"), (2, None, None, None, "CLOSED"),
    ]
    assert [r.account_age_days for r in accounts.orderBy("account_id").collect()] == [dt.timedelta(days=14), None]
    assert len(accounts.columns) == 12


def test_product_hierarchy_is_null_with_a_missing_part(spark):
    products = marts.dim_product(staging.stg_products(*product_tables(spark)))
    assert rows(products, "product_id", "product_hierarchy") == [
        (1, "Retail > Cards > Card"), (2, None), (3, None), (4, None),
    ]


def staged_transactions(spark, *dates_and_statuses):
    return staging.stg_transactions(
        base(
            spark, "FactTransaction",
            *[
                {"TransactionID": i, "AccountID": 1, "ProductID": 1, "TransactionAmount": 10.0,
                 "TransactionDate": date and day(date), "Status": status}
                for i, (date, status) in enumerate(dates_and_statuses)
            ],
        )
    )


def test_calendar_fills_gaps_and_crosses_years(spark):
    dates = marts.dim_date(staged_transactions(spark, ("2020-12-31", "x"), ("2021-01-04", "x"), (None, "x")))
    assert len(dates.columns) == 12
    got = rows(
        dates, "date_key", "year", "month", "month_name", "day", "day_of_week", "day_name", "quarter_label",
        "week_of_year", "is_weekend",
    )
    assert got == [
        (dt.date(2020, 12, 31), 2020, 12, "December ", 31, 4, "Thursday ", "Q4", 53, False),
        (dt.date(2021, 1, 1), 2021, 1, "January  ", 1, 5, "Friday   ", "Q1", 53, False),
        (dt.date(2021, 1, 2), 2021, 1, "January  ", 2, 6, "Saturday ", "Q1", 53, True),
        (dt.date(2021, 1, 3), 2021, 1, "January  ", 3, 0, "Sunday   ", "Q1", 53, True),
        (dt.date(2021, 1, 4), 2021, 1, "January  ", 4, 1, "Monday   ", "Q1", 1, False),
    ]


def test_calendar_of_one_day_and_of_none(spark):
    assert marts.dim_date(staged_transactions(spark, ("2024-02-29", "x"))).count() == 1
    assert marts.dim_date(staged_transactions(spark, (None, "x"))).isEmpty()


def dimensions(spark):
    customers = marts.dim_customer(staging.stg_customers(base(spark, "DimCustomer")), AS_OF)
    accounts = marts.dim_account(staged_accounts(spark), customers, AS_OF)
    return accounts, marts.dim_product(staging.stg_products(*product_tables(spark)))


def test_fact_flags_and_missing_dates(spark):
    staged = staged_transactions(
        spark, ("2024-01-06", "failed"), ("2024-01-05", "Completed"), (None, "SUCCESS"), ("2024-01-05", None)
    )
    fact = marts.fact_transactions(staged, *dimensions(spark))
    assert len(fact.columns) == 23
    assert rows(fact, "transaction_id", "year", "is_weekend", "is_failed", "is_completed", "is_weekend_txn") == [
        (0, 2024, True, 1, 0, 1), (1, 2024, False, 0, 1, 0), (2, None, None, 0, 0, 0), (3, 2024, False, 0, 0, 0),
    ]


def test_successful_transactions_are_not_counted_as_completed(spark):
    fact = marts.fact_transactions(staged_transactions(spark, ("2024-01-06", "Success")), *dimensions(spark))
    assert one(fact.select("transaction_status", "is_completed")) == ("SUCCESS", 0)


def test_derived_calendar_equals_joined_calendar(spark):
    staged = staged_transactions(spark, ("2020-12-31", "a"), ("2021-01-03", "b"), (None, "c"))
    dims = dimensions(spark)
    derived = marts.fact_transactions(staged, *dims)
    joined = marts.fact_transactions(staged, *dims, calendar=marts.dim_date(staged))
    assert derived.schema == joined.schema or derived.columns == joined.columns
    assert rows(derived) == rows(joined)


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5)), min_size=1, max_size=20))
def test_fact_keeps_every_staged_row(spark, keys):
    staged = staging.stg_transactions(
        base(
            spark, "FactTransaction",
            *[{"TransactionID": i, "AccountID": a, "ProductID": p or None, "TransactionAmount": 1.0}
              for i, (a, p) in enumerate(keys)],
        )
    )
    fact = marts.fact_transactions(staged, *dimensions(spark))
    assert fact.count() == len(keys)
    assert fact.groupBy().sum("transaction_amount").collect()[0][0] == money(f"{len(keys)}.00")
