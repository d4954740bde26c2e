"""Queries over the test tables, by name.

As in production, raw data is cleaned and loaded once and the marts are written
once; queries then read stored columns. Both happen on first use, per table, in
the shared folder (``bankmart.store``). The ``clean_*``, ``stg_*``, ``dim_*`` and
``fact_*`` entries compute their model rather than reading a stored one.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.operators.balance import HotKeys, find_hot_keys
from bankmart.operators.quality import run_checks
from bankmart.operators.windows import with_position
from bankmart.plans import analytics, cleaning, indicators, marts, staging
from bankmart.plans.checks import CHECKS
from bankmart.plans.pipeline import FACT_LAYOUT, publish
from bankmart.sample import adapter
from bankmart.schemas import BASE_TABLES, INGESTED_AT, STAMPED_TABLES
from bankmart.session import folder_bytes, size_for
from bankmart.sinks.files import write_parquet, write_partitioned
from bankmart.sinks.ledger import resume_load
from bankmart.sinks.load import LOAD_ORDER, load_tables, outcome_frame, raise_on_failure
from bankmart.sinks.tables import refresh_table
from bankmart.sources.raw import REJECT, REJECTED, read_csv, read_raw_table, typed
from bankmart.sources.tables import base_tables
from bankmart.store import TableStore, written

AS_OF = dt.date(2024, 1, 1)
FIRST, LAST = dt.date(1997, 3, 1), dt.date(1998, 2, 28)
TYPES = ("1-URGENT", "5-LOW")

# The columns that the model joins go by, looked through together.
HOT_KEYS = {"stg_transactions": ("account_id", "product_id"), "stg_accounts": ("customer_id",)}

# The fact and the product hierarchy, in the order the product queries take them.
PRODUCT_TABLES = ("FactTransaction", "DimProduct", "DimProductSubCategory", "DimProductCategory")

# Keys called hot to have the split joins run whatever the data: keys by number of pieces, and pieces of nulls.
CALLED_HOT = HotKeys({4: (1, 2, 3, 4, 5), 16: (7, 32, 33)}, 8)
CALLED_HOT_DAYS = HotKeys({4: (dt.date(1996, 1, 1), dt.date(1997, 3, 1))}, 8)

# The test tables are compressed Parquet; as text rows they are several times larger.
TEXT_GROWTH = 4


class Bank:
    """The models of one test data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        size_for(spark, TEXT_GROWTH * folder_bytes(spark, sf_dir))
        self._store = TableStore(spark, "sample")
        self._name = uuid.uuid4().hex
        self._hot: dict[tuple[str, str], HotKeys] = {}

    def raw(self, table: str) -> DataFrame:
        return adapter.RAW_TABLES[table](self._spark, self._sf_dir)

    def cleaned(self, table: str, **options: object) -> DataFrame:
        return cleaning.CLEANING_JOBS[table](self.raw(table), **options)

    def raw_zone(self, table: str) -> DataFrame:
        """A raw table written as a folder of CSV files and scanned back, positions included.

        The files hold the rows in ascending order, nulls first, so the first row
        of a key in file order is also its smallest.
        """
        raw = self.raw(table)
        typed_columns = BASE_TABLES[table].fieldNames()
        sortable = raw.select(F.struct(*typed_columns).alias("text"), "*")
        ordered = typed(sortable, table, keep=["text"]).orderBy(*[F.col(c).asc_nulls_first() for c in typed_columns])

        def write(path: str) -> None:
            ordered.select("text.*").write.mode("overwrite").csv(
                path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
            )

        return read_csv(self._spark, self._store.path(f"raw_{table}", write))

    def raw_zone_in_parts(self, table: str) -> DataFrame:
        """As ``raw_zone``, in several folders whose files have their columns in different orders."""
        raw = self.raw(table)
        typed_columns = BASE_TABLES[table].fieldNames()
        key, names = typed_columns[0], {1: typed_columns, 2: typed_columns[::-1]}

        def write(path: str) -> None:
            # Written, as each of the two sorts reads its rows twice: once for its ranges.
            ranked = written(typed(raw.select(F.struct(*typed_columns).alias("text"), "*"), table, keep=["text"]), "ranked")
            # All copies of a key lie in one part, whose files hold the rows in ascending order.
            for part, columns in names.items():
                own = ranked.filter(F.coalesce(F.col(key), F.lit(0)) % 2 == part - 1)
                ordered = own.orderBy(*[F.col(c).asc_nulls_first() for c in typed_columns])
                ordered.select(*[f"text.{c}" for c in columns]).write.mode("overwrite").csv(
                    f"{path}/{part}", header=True, escape='"',
                    ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                )

        root = self._store.path(f"parts_{table}", write)
        return read_raw_table(self._spark, root, ["1/", "2/"])

    def raw_zone_rejects(self) -> DataFrame:
        """Transactions as CSV files in which some lines lack a field, have one more or an open quote: kept and rejected rows."""
        raw, names = self.raw("FactTransaction"), BASE_TABLES["FactTransaction"].fieldNames()
        fields = F.concat_ws(",", *[F.coalesce(name, F.lit("")) for name in names])
        product = F.col("ProductID").cast("bigint")
        line = (
            F.when(product % 29 == 0, F.substring_index(fields, ",", len(names) - 1))
            .when(product % 31 == 0, F.concat(fields, F.lit(",more")))
            .when(product % 37 == 0, F.concat(fields, F.lit(',"open')))
            .otherwise(fields)
        )

        def write(path: str) -> None:
            # One column, whose name is the header line and whose values are lines, with nothing quoted.
            raw.select(line.alias(",".join(names))).write.mode("overwrite").csv(
                path, header=True, sep="\u0001", quote="\u0000", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
            )

        read = read_csv(self._spark, self._store.path("raw_rejects", write), malformed=REJECT)
        reason = F.col(f"{REJECTED}.reason")
        outcome = F.when(reason.isNull(), "kept").otherwise("rejected")
        return read.groupBy(outcome.alias("outcome"), reason.alias("reason")).agg(F.count(F.lit(1)).alias("rows"))

    def base(self, table: str) -> DataFrame:
        """A loaded base table."""
        return self._store.table(table, lambda: self.cleaned(table))

    def hot(self, model: str, key: str) -> HotKeys:
        """Keys with a large share of a staging model's rows, looked for once."""
        if (model, key) not in self._hot:
            keys = HOT_KEYS[model]
            self._hot |= {(model, k): hot for k, hot in zip(keys, find_hot_keys(getattr(self, model)(), *keys))}
        return self._hot[model, key]

    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.base("FactTransaction"))

    def stg_accounts(self) -> DataFrame:
        return staging.stg_accounts(self.base("DimAccount"))

    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.base("DimCustomer"))

    def stg_products(self) -> DataFrame:
        return staging.stg_products(
            self.base("DimProduct"), self.base("DimProductSubCategory"), self.base("DimProductCategory")
        )

    def dim_customer(self) -> DataFrame:
        return marts.dim_customer(self.stg_customers(), AS_OF)

    def dim_account(self) -> DataFrame:
        hot = self.hot("stg_accounts", "customer_id")
        return marts.dim_account(self.stg_accounts(), self.mart("dim_customer"), AS_OF, hot)

    def dim_product(self) -> DataFrame:
        return marts.dim_product(self.stg_products())

    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.stg_transactions())

    def fact_transactions(self, joined_calendar: bool = False) -> DataFrame:
        calendar = self.mart("dim_date") if joined_calendar else None
        return marts.fact_transactions(
            self.stg_transactions(), self.mart("dim_account"), self.mart("dim_product"), calendar,
            self.hot("stg_transactions", "account_id"), self.hot("stg_transactions", "product_id"),
        )

    def fact_transactions_split(self) -> DataFrame:
        """The fact with hot keys in each of its joins, the calendar's included."""
        products = marts.dim_product(staging.stg_products(
            *[self.base(t) for t in ("DimProduct", "DimProductSubCategory", "DimProductCategory")], CALLED_HOT
        ))
        accounts = marts.dim_account(self.stg_accounts(), self.mart("dim_customer"), AS_OF, CALLED_HOT)
        return marts.fact_transactions(
            self.stg_transactions(), accounts, products, self.mart("dim_date"), CALLED_HOT, CALLED_HOT,
            hot_dates=CALLED_HOT_DAYS,
        )

    def load_outcomes(self) -> DataFrame:
        """All base tables cleaned to Parquet and loaded in order, with the outcome of each."""
        outcomes = load_tables(self._spark, self.cleaned_zone(), self.refresh)
        raise_on_failure(outcomes)
        return outcome_frame(self._spark, outcomes)

    def cleaned_zone(self) -> str:
        return self._store.path("cleaned", lambda path: [
            write_parquet(self.cleaned(table), f"{path}/{name}") for name, table in LOAD_ORDER
        ])

    def refresh(self, df: DataFrame, table: str) -> None:
        refresh_table(df, f"{self.database()}.{table}")

    def resumed_load(self) -> DataFrame:
        """The outcomes of a load in which the products were refused, and of the next one, which goes on from there."""
        ledger = f"{self._store.path('ledgers', lambda path: None)}/{uuid.uuid4().hex}"

        def refuse_products(df: DataFrame, table: str) -> None:
            if table == "DimProduct":
                raise ValueError("refused")
            self.refresh(df, table)

        runs = [
            outcome_frame(self._spark, resume_load(self._spark, self.cleaned_zone(), load, ledger)).select(F.lit(run).alias("run"), "*")
            for run, load in ((1, refuse_products), (2, self.refresh))
        ]
        return runs[0].unionByName(runs[1])

    def database(self) -> str:
        """A catalog database of this folder's own, in the shared folder."""
        name = f"bankmart_{self._name}"
        self._store.path("database", lambda path: self._spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{path}'"))
        return name

    def published_fact(self) -> DataFrame:
        """The fact as a published table, from base tables loaded before."""
        self.load_outcomes()
        base = base_tables(self._spark, self.database())
        return publish(base, self.database(), AS_OF)["fact_transactions"]

    def published_fact_joined_calendar(self) -> DataFrame:
        """As ``published_fact``, in a database of its own, with a join for each column's source and hot keys in all of them."""
        self.load_outcomes()
        name = f"bankmart_joined_{self._name}"
        self._store.path("joined", lambda path: self._spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{path}'"))
        return publish(base_tables(self._spark, self.database()), name, AS_OF, join_calendar=True)["fact_transactions"]

    def in_order(self, report: str, *tables: str) -> DataFrame:
        """A report with each row's place in its order."""
        build = getattr(analytics, report)
        return with_position(build(*[self.base(t) for t in tables]), analytics.report_order(report))

    def ingest_stamps(self) -> DataFrame:
        """For each stamped table its rows, those with a stamp, and whether there is one stamp."""
        stamp = F.col(INGESTED_AT)
        frames = [
            self.base(table).agg(F.count(F.lit(1)).alias("rows"), F.count(stamp).alias("stamped"), (F.min(stamp) == F.max(stamp)).alias("one_stamp"))
            .select(F.lit(table).alias("table_name"), "rows", "stamped", "one_stamp")
            for table in STAMPED_TABLES
        ]
        return reduce(DataFrame.unionByName, frames)

    def mart(self, name: str) -> DataFrame:
        """A stored dimension or the stored fact."""
        if name == "fact_transactions":
            layout = partial(
                write_partitioned, partition_by=FACT_LAYOUT.partition_by, sort_by=FACT_LAYOUT.sort_by
            )
            return self._store.table(name, self.fact_transactions, layout)
        return self._store.table(name, getattr(self, name))

    def models(self) -> Mapping[str, DataFrame]:
        """Staging views over stored base tables, and stored marts."""
        staged = ("stg_transactions", "stg_customers", "stg_accounts", "stg_products")
        stored = ("dim_customer", "dim_account", "dim_product", "dim_date", "fact_transactions")
        return {name: getattr(self, name)() for name in staged} | {name: self.mart(name) for name in stored}

    def product_tables(self) -> list[DataFrame]:
        """The fact and the product hierarchy, in the order the product queries take them."""
        return [self.base(t) for t in PRODUCT_TABLES]


_banks: dict[tuple[str, str], Bank] = {}


def bank(spark: SparkSession, sf_dir: str) -> Bank:
    """The models of a folder, shared by all queries of the application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _banks:
        _banks[key] = Bank(spark, sf_dir)
    return _banks[key]


def _unstamped(df: DataFrame) -> DataFrame:
    """Without the ingest time, which differs on every run."""
    return df.drop(INGESTED_AT)


def _age_in_days(accounts: DataFrame) -> DataFrame:
    """The age interval as whole days, which both engines can compare."""
    days = F.extract(F.lit("day"), F.col("account_age_days")).cast("bigint")
    return accounts.withColumn("account_age_days", days)


def _cleaning_queries() -> dict[str, Callable[[Bank], DataFrame]]:
    names = {
        "clean_product_category": "DimProductCategory",
        "clean_product_sub_category": "DimProductSubCategory",
        "clean_product": "DimProduct",
        "clean_customer": "DimCustomer",
        "clean_customer_usa": "DimCustomerUSA",
        "clean_account_by_id": "DimAccount",
        "dedup_transactions": "FactTransaction",
    }
    jobs = {name: lambda b, t=table: _unstamped(b.cleaned(t)) for name, table in names.items()}
    jobs["raw_zone_accounts"] = lambda b: _unstamped(cleaning.clean_account(b.raw_zone("DimAccount"), key="CustomerID"))
    jobs["raw_zone_transactions"] = lambda b: _unstamped(cleaning.clean_transaction(b.raw_zone_in_parts("FactTransaction")))
    jobs["dedup_accounts_per_customer"] = lambda b: _unstamped(b.cleaned("DimAccount", key="CustomerID"))
    return jobs


BANK_QUERIES: dict[str, Callable[[Bank], DataFrame]] = {
    # The flagship comes first.
    "failure_risk": lambda b: analytics.failure_risk(*b.product_tables()),
    "monthly_revenue": lambda b: analytics.monthly_revenue(b.base("FactTransaction")),
    "top_customers": lambda b: analytics.top_customers(
        b.base("FactTransaction"), b.base("DimAccount"), b.base("DimCustomer")
    ),
    "customer_percentiles": lambda b: analytics.customer_percentiles(
        b.base("FactTransaction"), b.base("DimAccount"), b.base("DimCustomer")
    ),
    "product_volume_rank": lambda b: analytics.product_volume_rank(*b.product_tables()),
    "product_volume_rank_sub": lambda b: analytics.product_volume_rank_sub(*b.product_tables()),
    "row_counts": lambda b: analytics.row_counts({name: b.base(name) for name in BASE_TABLES}),
    "monthly_revenue_in_order": lambda b: b.in_order("monthly_revenue", "FactTransaction"),
    "top_customers_in_order": lambda b: b.in_order("top_customers", "FactTransaction", "DimAccount", "DimCustomer"),
    "failure_risk_in_order": lambda b: b.in_order("failure_risk", *PRODUCT_TABLES),
    "product_volume_rank_in_order": lambda b: b.in_order("product_volume_rank", *PRODUCT_TABLES),
    "product_volume_rank_sub_in_order": lambda b: b.in_order("product_volume_rank_sub", *PRODUCT_TABLES),
    **_cleaning_queries(),
    "stg_transactions": lambda b: _unstamped(b.stg_transactions()),
    "stg_accounts": lambda b: _unstamped(b.stg_accounts()),
    "stg_customers": lambda b: _unstamped(b.stg_customers()),
    "stg_products": Bank.stg_products,
    "dim_customer": Bank.dim_customer,
    "dim_account": lambda b: _age_in_days(b.dim_account()),
    "dim_product": Bank.dim_product,
    "dim_date": Bank.dim_date,
    "fact_transactions": Bank.fact_transactions,
    "fact_transactions_joined_calendar": lambda b: b.fact_transactions(joined_calendar=True),
    "fact_transactions_split": Bank.fact_transactions_split,
    "published_fact": Bank.published_fact,
    "published_fact_joined_calendar": Bank.published_fact_joined_calendar,
    "load_outcomes": Bank.load_outcomes,
    "resumed_load": Bank.resumed_load,
    "raw_zone_rejects": Bank.raw_zone_rejects,
    "ingest_stamps": Bank.ingest_stamps,
    "undated_volume": lambda b: indicators.undated_volume(b.mart("fact_transactions")),
    "dq_results": lambda b: run_checks(b.models(), CHECKS),
    "daily_volume": lambda b: indicators.daily_volume(b.mart("fact_transactions"), b.mart("dim_date")),
    "daily_volume_in_range": lambda b: indicators.daily_volume(
        b.mart("fact_transactions"), b.mart("dim_date"), FIRST, LAST
    ),
    "branch_liquidity": lambda b: indicators.branch_liquidity(b.mart("dim_account")),
    "balance_distribution": lambda b: indicators.balance_distribution(b.mart("dim_account")),
    "rolling_30d": lambda b: indicators.rolling_30d(b.mart("fact_transactions")),
    "rolling_30d_in_range": lambda b: indicators.rolling_30d(b.mart("fact_transactions"), FIRST, LAST),
    "branch_volume_rank": lambda b: indicators.branch_volume_rank(b.mart("fact_transactions")),
    "branch_volume_rank_in_range": lambda b: indicators.branch_volume_rank(
        b.mart("fact_transactions"), FIRST, LAST
    ),
    "account_type_breakdown": lambda b: indicators.account_type_breakdown(b.mart("dim_account")),
    "account_type_breakdown_filtered": lambda b: indicators.account_type_breakdown(b.mart("dim_account"), TYPES),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: lambda spark, sf_dir, query=query: query(bank(spark, sf_dir)) for name, query in BANK_QUERIES.items()
    }
