"""Ordered load of the cleaned zone into the base tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

from bankmart.sources.tables import read_parquet

# Cleaned dataset and base table, parents before children.
LOAD_ORDER: tuple[tuple[str, str], ...] = (
    ("dim_product_category", "DimProductCategory"),
    ("dim_product_sub_category", "DimProductSubCategory"),
    ("dim_product", "DimProduct"),
    ("dim_customer", "DimCustomer"),
    ("dim_customer_usa", "DimCustomerUSA"),
    ("dim_account", "DimAccount"),
    ("fact_transaction", "FactTransaction"),
)

SUCCESS, FAILED = "SUCCESS", "FAILED"
# Of a resumed load: nothing to do, and not tried.
LOADED_BEFORE, PARENT_FAILED = "LOADED_BEFORE", "PARENT_FAILED"


@dataclass(frozen=True)
class LoadOutcome:
    name: str
    table: str
    status: str
    rows: int | None = None
    columns: int | None = None
    error: str | None = None


OUTCOME_SCHEMA = "name string, table string, status string, rows bigint, columns int, error string"


class LoadFailed(Exception):
    """Raised after all tables were tried, when some could not be loaded."""

    def __init__(self, outcomes: list[LoadOutcome]):
        self.outcomes = outcomes
        failed = [o.name for o in outcomes if o.status in (FAILED, PARENT_FAILED)]
        super().__init__(f"tables not loaded: {', '.join(failed)}")


def load_tables(
    spark: SparkSession,
    cleaned_root: str,
    load: Callable[[DataFrame, str], object],
    tables: Iterable[tuple[str, str]] = LOAD_ORDER,
) -> list[LoadOutcome]:
    """Load each cleaned dataset with ``load(df, table)``; a failure does not stop the rest.

    Row counts come from the datasets' file footers.
    """
    outcomes = []
    for name, table in tables:
        try:
            df = read_parquet(spark, f"{cleaned_root.rstrip('/')}/{name}")
            load(df, table)
            outcomes.append(LoadOutcome(name, table, SUCCESS, df.count(), len(df.columns)))
        except Exception as error:  # noqa: BLE001 - recorded per table, raised at the end
            outcomes.append(LoadOutcome(name, table, FAILED, error=str(error)))
    return outcomes


def outcome_frame(spark: SparkSession, outcomes: Iterable[LoadOutcome]) -> DataFrame:
    return spark.createDataFrame([astuple(o) for o in outcomes], OUTCOME_SCHEMA)


def raise_on_failure(outcomes: list[LoadOutcome]) -> None:
    if any(o.status == FAILED for o in outcomes):
        raise LoadFailed(outcomes)
