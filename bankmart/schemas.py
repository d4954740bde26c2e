"""Column names and types of the seven base tables.

Text columns stay text, money arrives as double and is made ``decimal(15,2)`` in
staging, event dates are ``timestamp_ntz`` because they carry no zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Text that counts as a missing value in a raw CSV field.
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

MONEY = T.DecimalType(15, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_KEY, _TEXT, _DATE, _AMOUNT = T.LongType(), T.StringType(), T.TimestampNTZType(), T.DoubleType()

_CUSTOMER = _table(
    CustomerID=_KEY, FullName=_TEXT, DOB=_TEXT, Gender=_TEXT, Region=_TEXT,
    Email=_TEXT, Status=_TEXT, JoinDate=_DATE,
)

# Base table and column names (one key is spelled
# ProductSubcategoryID in DimProduct and ProductSubCategoryID elsewhere).
BASE_TABLES: dict[str, T.StructType] = {
    "DimProductCategory": _table(ProductCategoryID=_KEY, ProductCategoryName=_TEXT),
    "DimProductSubCategory": _table(
        ProductSubCategoryID=_KEY, ProductCategoryID=_KEY, ProductSubCategoryName=_TEXT,
    ),
    "DimProduct": _table(ProductID=_KEY, ProductSubcategoryID=_KEY, ProductName=_TEXT),
    "DimCustomer": _CUSTOMER,
    "DimCustomerUSA": _CUSTOMER,
    "DimAccount": _table(
        AccountID=_KEY, CustomerID=_KEY, AccountType=_TEXT, OpenDate=_DATE,
        ClosedDate=_DATE, Status=_TEXT, RegistrationID=_KEY, Balance=_AMOUNT,
    ),
    "FactTransaction": _table(
        TransactionID=_KEY, AccountID=_KEY, TransactionDate=_DATE,
        TransactionAmount=_AMOUNT, TransactionType=_TEXT, TransactionChannel=_TEXT,
        ProductID=_KEY, Status=_TEXT,
    ),
}

# The cleaning jobs that stamp rows add this column; the product jobs do not.
INGESTED_AT = "ingested_at"
STAMPED_TABLES = ("DimCustomer", "DimCustomerUSA", "DimAccount", "FactTransaction")


def base_schema(table: str) -> T.StructType:
    """Schema of a loaded base table, with the ingest stamp where there is one."""
    schema = T.StructType(list(BASE_TABLES[table].fields))
    return schema.add(INGESTED_AT, T.TimestampType()) if table in STAMPED_TABLES else schema
