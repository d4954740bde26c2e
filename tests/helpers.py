"""Small frames in, plain rows out."""

from __future__ import annotations

import contextlib
import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame

from bankmart.schemas import BASE_TABLES, INGESTED_AT, base_schema

STAMP = dt.datetime(2024, 1, 1)

# A raw zone: file name and content of each base table.
CUSTOMER_HEADER = "CustomerID,FullName,DOB,Gender,Region,Email,Status,JoinDate\n"
FILES = {
    "DimProductCategory": ("categories.csv", "ProductCategoryID,ProductCategoryName\n1,Retail \n"),
    "DimProductSubCategory": (
        "subs.txt", "ProductSubCategoryID,ProductCategoryID,ProductSubCategoryName\n10,1,Cards\n11,NA,Loose\n",
    ),
    "DimProduct": ("products.csv", "ProductID,ProductSubcategoryID,ProductName\n5,10.0, Gold\n6,11.0,Odd\n"),
    "DimCustomer": (
        "customers.csv",
        CUSTOMER_HEADER
        + "1,Ann, 1/2/1990,F,West,ANN@x.y,Active,2020-01-01\n".replace(", 1/2", ",1/2")
        + "1,Ann again,1/2/1990,F,West,,Active,2020-01-01\n,Nobody,,,,,,\n2,Bob,NA,M,East,b@x.y,Dormant,bad\n",
    ),
    "DimCustomerUSA": ("usa.csv", CUSTOMER_HEADER + "1,Ann,1/2/1990,F,West,ANN@x.y,Active,2020-01-01\n"),
    "DimAccount": (
        "accounts.csv",
        "AccountID,CustomerID,AccountType,OpenDate,ClosedDate,Status,RegistrationID,Balance\n"
        "100,1,Savings,2023-12-01,,Open,1,10.5\n101,1,Current,2023-12-01,,Open,2,\n102,2,Savings,bad,,Closed,3,nan\n",
    ),
    "FactTransaction": (
        "transactions.csv",
        "TransactionID,AccountID,TransactionDate,TransactionAmount,TransactionType,TransactionChannel,ProductID,Status\n"
        "1,100,2023-12-30,5.25,credit,atm,5,Success\n1,100,2023-12-31,7,credit,atm,5,Success\n"
        "2,101,2024-01-01,1,debit, web ,6,Failed\n3,102,bad,2,debit,web,9,Success\n4,,2024-01-01,3,debit,web,5,Success\n",
    ),
}


def day(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def money(text: str) -> Decimal:
    return Decimal(text)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows sorted with nulls first, all columns unless some are named."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is not None, str(type(v)), v if v is not None else 0) for v in r])


def one(df: DataFrame) -> tuple:
    (row,) = df.collect()
    return tuple(row)


def base(spark, table: str, *records: dict) -> DataFrame:
    """A base table from partial records; absent columns are null."""
    schema = base_schema(table)
    filled = [
        tuple(STAMP if name == INGESTED_AT else record.get(name) for name in schema.fieldNames()) for record in records
    ]
    return spark.createDataFrame(filled, schema)


def raw(spark, table: str, *records: dict) -> DataFrame:
    """A raw file of text columns from partial records."""
    names = BASE_TABLES[table].fieldNames()
    return spark.createDataFrame(
        [tuple(record.get(name) for name in names) for record in records], ", ".join(f"{name} string" for name in names)
    )


@contextlib.contextmanager
def settings(spark, **values):
    """Session settings for the length of a block; underscores stand for dots."""
    names = {name.replace("_", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def plan_of(df: DataFrame) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
