"""The stages of the pipeline put together."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bankmart.functions.dates import AsOf
from bankmart.operators import balance
from bankmart.operators.balance import NONE_HOT, HotKeys, find_hot_keys
from bankmart.plans import marts, staging
from bankmart.plans.cleaning import CLEANING_JOBS
from bankmart.sinks.files import write_parquet
from bankmart.sinks.load import LOAD_ORDER
from bankmart.sinks.tables import Layout, as_table, as_view
from bankmart.sources.raw import REJECT, REJECTED, STOP, read_raw_table, split_rejected
from bankmart.sources.tables import base_tables

Save = Callable[[str, DataFrame], DataFrame]
FindHot = Callable[..., tuple[HotKeys, ...]]

# The fact is pruned by month, and within a month's files by account.
FACT_LAYOUT = Layout(partition_by=("year", "month"), sort_by=("account_id",))


def clean_zone(
    spark: SparkSession,
    raw_root: str,
    cleaned_root: str,
    file_names: Mapping[str, str | Sequence[str]],
    options: Mapping[str, Mapping[str, str]] | None = None,
    same_name: str = STOP,
    unreadable: dict[str, dict[str, int]] | None = None,
    rejected_root: str | None = None,
    rejected: dict[str, int] | None = None,
) -> dict[str, tuple[int, int]]:
    """Clean the raw files of each base table into a Parquet dataset; returns shapes.

    ``options`` are passed to a table's cleaning job, such as its date format.
    ``unreadable`` gets, by table and column, the values that could not be read.

    A row that does not fit its file's header stops the job. With ``rejected_root`` it goes
    to a dataset there instead, with file, position, text and reason, and ``rejected`` gets
    the number of such rows by table. They are counted in the pass that cleans the others;
    only where there are any is a table's raw data read again to write them.
    """
    datasets = {table: name for name, table in LOAD_ORDER}
    shapes = {}
    for table, names in file_names.items():
        seen = Observation(f"unreadable {table}")
        raw = read_raw_table(spark, raw_root, names, same_name, malformed=REJECT if rejected_root else STOP)
        aside = Observation(f"rejected {table}")
        if rejected_root:
            raw = raw.observe(aside, F.count(REJECTED).alias("rows"))
        fitting = split_rejected(raw)[0] if rejected_root else raw
        cleaned = CLEANING_JOBS[table](fitting, observation=seen, **(options or {}).get(table, {}))
        shapes[table] = write_parquet(cleaned, f"{cleaned_root.rstrip('/')}/{datasets[table]}")
        if rejected_root:
            count = aside.get["rows"]
            if count:
                again = read_raw_table(spark, raw_root, names, same_name, malformed=REJECT)
                write_parquet(split_rejected(again)[1], f"{rejected_root.rstrip('/')}/{datasets[table]}")
            if rejected is not None:
                rejected[table] = count
        if unreadable is not None:
            unreadable[table] = {column: count for column, count in seen.get.items() if count}
    return shapes


def staging_models(base: Mapping[str, DataFrame], hot_sub_categories: HotKeys = NONE_HOT) -> dict[str, DataFrame]:
    return {
        "stg_transactions": staging.stg_transactions(base["FactTransaction"]),
        "stg_accounts": staging.stg_accounts(base["DimAccount"]),
        "stg_customers": staging.stg_customers(base["DimCustomer"]),
        "stg_products": staging.stg_products(
            base["DimProduct"], base["DimProductSubCategory"], base["DimProductCategory"], hot_sub_categories
        ),
    }


def _keep_lazy(_name: str, df: DataFrame) -> DataFrame:
    return df


def _none_hot(_df: DataFrame, *keys: str) -> tuple[HotKeys, ...]:
    return (NONE_HOT,) * len(keys)


def star_schema(
    base: Mapping[str, DataFrame],
    as_of: AsOf = None,
    save_staging: Save = _keep_lazy,
    save_mart: Save = _keep_lazy,
    find_hot: FindHot = _none_hot,
    completed_status: str = marts.COMPLETED_STATUS,
    stored: bool = False,
    hot_sub_categories: HotKeys = NONE_HOT,
    join_calendar: bool = False,
) -> dict[str, DataFrame]:
    """All nine models; each is saved before the models that read it are built.

    Lazy by default. ``find_hot`` runs a job to find the keys that the joins split: one
    for the accounts and one for all keys of the transactions together.
    ``stored``: ``save_mart`` returns marts that are written, so that they are read
    rather than the transactions. ``join_calendar``: the calendar is built first and its
    columns are joined, with days split as the other keys are, instead of computed.
    """
    models = {name: save_staging(name, df) for name, df in staging_models(base, hot_sub_categories).items()}
    transactions, accounts = models["stg_transactions"], models["stg_accounts"]
    models["dim_customer"] = save_mart("dim_customer", marts.dim_customer(models["stg_customers"], as_of))
    models["dim_account"] = save_mart(
        "dim_account",
        marts.dim_account(accounts, models["dim_customer"], as_of, *find_hot(accounts, "customer_id")),
    )
    models["dim_product"] = save_mart("dim_product", marts.dim_product(models["stg_products"]))
    if join_calendar:
        models["dim_date"] = save_mart("dim_date", marts.dim_date(transactions, "transaction_date"))
        hot_accounts, hot_products, hot_dates = find_hot(transactions, "account_id", "product_id", "transaction_date")
    else:
        hot_accounts, hot_products = find_hot(transactions, "account_id", "product_id")
        hot_dates = NONE_HOT
    models["fact_transactions"] = save_mart(
        "fact_transactions",
        marts.fact_transactions(
            transactions, models["dim_account"], models["dim_product"], models.get("dim_date"),
            hot_accounts=hot_accounts, hot_products=hot_products, completed_status=completed_status, hot_dates=hot_dates,
        ),
    )
    if join_calendar:
        return models
    # A stored fact has the dates of all transactions in one short column.
    dated = (models["fact_transactions"], "date_key") if stored else (transactions, "transaction_date")
    models["dim_date"] = save_mart("dim_date", marts.dim_date(*dated))
    return models


MARTS = ("dim_customer", "dim_account", "dim_product", "dim_date", "fact_transactions")


def published(base: Mapping[str, DataFrame], database: str) -> dict[str, DataFrame]:
    """The nine models for reading: staging over the base tables, marts as stored."""
    return staging_models(base) | base_tables(base["FactTransaction"].sparkSession, database, MARTS)


def publish(
    base: Mapping[str, DataFrame],
    database: str,
    as_of: AsOf = None,
    completed_status: str = marts.COMPLETED_STATUS,
    join_calendar: bool = False,
) -> dict[str, DataFrame]:
    """Register staging views and write the marts as tables of ``database``.

    Every join by which a model is built is given the hot keys of its own column.
    """

    def save_mart(name: str, df: DataFrame) -> DataFrame:
        layout = FACT_LAYOUT if name == "fact_transactions" else Layout()
        return as_table(df, f"`{database}`.`{name}`", layout)

    products = base["DimProduct"].filter(F.col("ProductID").isNotNull())
    (hot_sub_categories,) = balance.find_hot_keys(products, "ProductSubcategoryID")
    return star_schema(
        base, as_of, lambda name, df: as_view(df, name), save_mart, find_hot_keys, completed_status, stored=True,
        hot_sub_categories=hot_sub_categories, join_calendar=join_calendar,
    )
