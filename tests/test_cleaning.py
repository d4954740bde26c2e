from helpers import day, raw, rows

from bankmart.plans import cleaning
from bankmart.schemas import BASE_TABLES, base_schema


def test_account_keys(spark):
    df = raw(
        spark, "DimAccount",
        {"AccountID": "1", "CustomerID": "7.0", "OpenDate": "2020-01-01", "Balance": None},
        {"AccountID": "2", "CustomerID": "7", "OpenDate": "bad", "Balance": "5.5"},
        {"AccountID": "3", "CustomerID": None, "Balance": "1"},
        {"AccountID": "4", "CustomerID": "8", "ClosedDate": "2021-02-03", "Balance": "2"},
    )
    per_customer = cleaning.clean_account(df, key="CustomerID")
    assert rows(per_customer, "AccountID", "CustomerID", "OpenDate", "ClosedDate", "Balance") == [
        (1, 7, day("2020-01-01"), None, 0.0), (4, 8, None, day("2021-02-03"), 2.0),
    ]
    assert per_customer.filter("ingested_at is null").isEmpty()
    assert rows(cleaning.clean_account(df), "AccountID") == [(1,), (2,), (4,)]


def test_customer_keys_and_dates(spark):
    records = (
        {"CustomerID": "1.0", "FullName": "b", "JoinDate": "31/12/2020"},
        {"CustomerID": "1", "FullName": "a", "JoinDate": "31/12/2020"},
        {"CustomerID": None, "FullName": "c"},
        {"CustomerID": "2", "FullName": " D ", "JoinDate": "12/31/2020"},
    )
    for table, job in (("DimCustomer", cleaning.clean_customer), ("DimCustomerUSA", cleaning.clean_customer_usa)):
        cleaned = job(raw(spark, table, *records), date_format="dd/MM/yyyy")
        assert rows(cleaned, "CustomerID", "FullName", "JoinDate") == [
            (1, "a", day("2020-12-31")), (2, " D ", None),
        ]


def test_transaction_rows_without_an_account_or_amount_stay(spark):
    df = raw(
        spark, "FactTransaction",
        {"TransactionID": "1", "TransactionDate": "2024-01-01", "TransactionAmount": "10"},
        {"TransactionID": "1", "TransactionDate": "2024-01-02", "TransactionAmount": "10"},
        {"TransactionID": None, "TransactionAmount": "3"},
        {"TransactionID": "2", "AccountID": "9", "TransactionDate": None},
    )
    assert rows(cleaning.clean_transaction(df), "TransactionID", "AccountID", "TransactionDate", "TransactionAmount") == [
        (1, None, day("2024-01-01"), 10.0), (2, 9, None, None),
    ]


def test_product_jobs_change_nothing_and_add_no_stamp(spark):
    df = raw(spark, "DimProduct", {"ProductID": None, "ProductName": " x "}, {"ProductID": "1"}, {"ProductID": "1"})
    assert rows(cleaning.clean_product(df)) == [(None, None, " x "), (1, None, None), (1, None, None)]
    sub = raw(spark, "DimProductSubCategory", {"ProductSubCategoryID": "3", "ProductCategoryID": "1.0"})
    assert rows(cleaning.clean_product_sub_category(sub)) == [(3, 1, None)]
    category = raw(spark, "DimProductCategory", {"ProductCategoryID": "1", "ProductCategoryName": "Loans"})
    assert rows(cleaning.clean_product_category(category)) == [(1, "Loans")]


def test_every_job_yields_its_base_schema(spark):
    for table in BASE_TABLES:
        cleaned = cleaning.CLEANING_JOBS[table](raw(spark, table))
        expected = [(f.name, f.dataType) for f in base_schema(table).fields]
        assert [(f.name, f.dataType) for f in cleaned.schema.fields] == expected
