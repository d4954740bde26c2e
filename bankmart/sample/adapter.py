"""The test tables read as the raw files of the seven base tables.

All columns are text, as in a CSV, and carry what raw files carry: missing-value
markers, keys written as ``7.0``, stray blanks, mixed case, unreadable dates and
repeated transaction ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.functions.text import null_if_marker


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _every(key: str | Column, n: int) -> Column:
    return (F.col(key) if isinstance(key, str) else key) % n == 0


def _float_text(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit(".0"))


def _iso(value: Column) -> Column:
    return value.cast("date").cast("string")


def _as_csv(df: DataFrame, **columns: Column) -> DataFrame:
    """Text columns with markers read as null, as the CSV reader delivers them."""
    text = df.select(*[value.cast("string").alias(name) for name, value in columns.items()])
    return text.select(*[null_if_marker(F.col(name)).alias(name) for name in columns])


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem")
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    returned = F.col("l_returnflag") == "R"
    status = (
        F.when(returned & _every(number, 7), "FAILED")
        .when(returned, "Failed")
        .when(_every(number, 11), "COMPLETED")
        .when(_every(number, 17), " success ")
        .otherwise("Success")
    )
    return _as_csv(
        lines,
        TransactionID=F.when(_every("l_partkey", 503), "NA").otherwise(_float_text(number)),
        AccountID=F.when(_every(number, 401), "").otherwise(_float_text(F.col("l_orderkey"))),
        TransactionDate=F.when(_every(number, 307), "unknown").otherwise(_iso(F.col("l_shipdate"))),
        TransactionAmount=F.when(_every(number, 211), "N/A").otherwise(F.col("l_extendedprice").cast("string")),
        TransactionType=F.col("l_linestatus"),
        TransactionChannel=F.concat(F.lit(" ch"), (F.col("l_suppkey") % 4).cast("string"), F.lit(" ")),
        ProductID=F.col("l_partkey"),
        Status=status,
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    closed = F.col("o_orderstatus") == "F"
    return _as_csv(
        orders,
        AccountID=F.col("o_orderkey"),
        CustomerID=F.when(_every("o_orderkey", 499), "").otherwise(_float_text(F.col("o_custkey"))),
        AccountType=F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")),
        OpenDate=F.when(_every("o_orderkey", 389), "n/a").otherwise(_iso(F.col("o_orderdate"))),
        ClosedDate=F.when(closed, _iso(F.date_add(F.col("o_orderdate").cast("date"), 365))).otherwise(""),
        Status=F.when(closed, " closed").otherwise("Open "),
        RegistrationID=F.col("o_orderkey") + 1_000_000,
        Balance=F.when(_every("o_orderkey", 97), "NULL").otherwise(F.col("o_totalprice").cast("string")),
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    located = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return _read(spark, sf_dir, "customer").join(located, F.col("c_nationkey") == F.col("n_nationkey"))


def _customer_file(rows: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    born = F.make_date((key % 70 + 1940).cast("int"), (key % 12 + 1).cast("int"), (key % 28 + 1).cast("int"))
    segment = F.col("c_mktsegment")
    return _as_csv(
        rows,
        CustomerID=key,
        FullName=F.concat(F.lit("  "), "c_name", F.lit(" ")),
        DOB=F.when(_every(key, 50), "NA")
        .when(_every(key, 3), F.date_format(born, "d/M/yyyy"))
        .otherwise(F.date_format(born, "dd/MM/yyyy")),
        Gender=F.when(key % 3 == 0, "Male").when(key % 3 == 1, " Female").otherwise(""),
        Region=F.concat("r_name", F.lit(" ")),
        Email=F.concat(F.lit(" User"), key.cast("string"), F.lit("@Example.COM")),
        Status=F.when(segment == "AUTOMOBILE", " Active")
        .when(segment == "BUILDING", "INACTIVE ")
        .when(segment == "FURNITURE", "suspended")
        .when(segment == "MACHINERY", "active")
        .otherwise("Dormant"),
        JoinDate=_iso(F.date_add(F.lit("2010-01-01").cast("date"), (key % 3650).cast("int"))),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_file(_customers(spark, sf_dir))


def customers_usa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_file(_customers(spark, sf_dir).filter("r_name = 'AMERICA'"))


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type's id is its smallest part key: unique without numbering all types."""
    return _read(spark, sf_dir, "part").groupBy("p_type").agg(F.min("p_partkey").alias("category"))


def _sub_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _read(spark, sf_dir, "part")
    return parts.groupBy("p_type", "p_brand").agg(F.min("p_partkey").alias("sub_category"))


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_csv(
        _categories(spark, sf_dir),
        ProductCategoryID=F.col("category"),
        ProductCategoryName=F.concat("p_type", F.lit(" ")),
    )


def product_sub_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sub_categories(spark, sf_dir).join(_categories(spark, sf_dir), "p_type")
    return _as_csv(
        rows,
        ProductSubCategoryID=F.col("sub_category"),
        ProductCategoryID=F.when(_every("sub_category", 41), "NaN").otherwise(_float_text(F.col("category"))),
        ProductSubCategoryName=F.concat(F.lit(" "), "p_brand"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "part").join(_sub_categories(spark, sf_dir), ["p_type", "p_brand"])
    return _as_csv(
        rows,
        ProductID=F.col("p_partkey"),
        ProductSubcategoryID=F.when(_every("p_partkey", 97), "").otherwise(_float_text(F.col("sub_category"))),
        ProductName=F.concat(F.lit(" "), "p_name", F.lit(" ")),
    )


RAW_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "DimProductCategory": product_categories,
    "DimProductSubCategory": product_sub_categories,
    "DimProduct": products,
    "DimCustomer": customers,
    "DimCustomerUSA": customers_usa,
    "DimAccount": accounts,
    "FactTransaction": transactions,
}
