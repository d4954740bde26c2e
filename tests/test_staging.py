import datetime as dt

from helpers import base, day, money, rows

from bankmart.plans import staging


def test_transactions_need_id_account_and_amount_but_no_date(spark):
    df = base(
        spark, "FactTransaction",
        {"TransactionID": 1, "AccountID": 2, "TransactionAmount": 1.005, "Status": " Success ",
         "TransactionType": "credit", "TransactionChannel": " atm", "TransactionDate": day("2024-05-06 07:08:09")},
        {"TransactionID": 2, "AccountID": 2, "TransactionAmount": 5.0},
        {"AccountID": 2, "TransactionAmount": 5.0},
        {"TransactionID": 3, "TransactionAmount": 5.0},
        {"TransactionID": 4, "AccountID": 2},
    )
    staged = staging.stg_transactions(df)
    assert rows(staged.drop("ingested_at")) == [
        (1, 2, None, dt.date(2024, 5, 6), money("1.01"), "CREDIT", "ATM", "SUCCESS"),
        (2, 2, None, None, money("5.00"), None, None, None),
    ]
    assert staged.schema["transaction_amount"].dataType.simpleString() == "decimal(15,2)"


def test_accounts(spark):
    df = base(
        spark, "DimAccount",
        {"AccountID": 1, "AccountType": " Savings ", "Status": " open", "Balance": 10.456},
        {"CustomerID": 5},
    )
    assert rows(staging.stg_accounts(df), "account_id", "account_type", "status", "balance") == [
        (1, "Savings", "OPEN", money("10.46")),
    ]


def test_customers(spark):
    df = base(
        spark, "DimCustomer",
        {"CustomerID": 1, "FullName": " A B ", "Email": " X@Y.Z ", "Status": "active ", "DOB": "1/2/2000",
         "Gender": " F", "Region": "West "},
        {"FullName": "nobody"},
    )
    assert rows(staging.stg_customers(df).drop("join_date", "ingested_at")) == [
        (1, "A B", "1/2/2000", "F", "West", "x@y.z", "ACTIVE"),
    ]


def product_tables(spark):
    products = base(
        spark, "DimProduct",
        {"ProductID": 1, "ProductName": " Card ", "ProductSubcategoryID": 10},
        {"ProductID": 2, "ProductName": "Loan", "ProductSubcategoryID": 20},
        {"ProductID": 3, "ProductName": "Loose"},
        {"ProductID": 4, "ProductName": "Lost", "ProductSubcategoryID": 99},
        {"ProductName": "no id", "ProductSubcategoryID": 10},
    )
    sub_categories = base(
        spark, "DimProductSubCategory",
        {"ProductSubCategoryID": 10, "ProductCategoryID": 100, "ProductSubCategoryName": " Cards"},
        {"ProductSubCategoryID": 20, "ProductSubCategoryName": "Loans"},
    )
    categories = base(spark, "DimProductCategory", {"ProductCategoryID": 100, "ProductCategoryName": "Retail "})
    return products, sub_categories, categories


def test_products_keep_those_without_a_category(spark):
    assert rows(staging.stg_products(*product_tables(spark))) == [
        (1, "Card", 10, "Cards", 100, "Retail"),
        (2, "Loan", 20, "Loans", None, None),
        (3, "Loose", None, None, None, None),
        (4, "Lost", None, None, None, None),
    ]
