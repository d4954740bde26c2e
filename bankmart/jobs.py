"""The pipeline as jobs: ``spark-submit bankmart/jobs.py <clean|load|publish|check|report> ...``."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bankmart.operators.quality import raise_on_error, run_checks
from bankmart.operators.windows import with_position
from bankmart.plans import analytics, indicators
from bankmart.plans.checks import CHECKS
from bankmart.plans.cleaning import ACCOUNT_KEYS
from bankmart.plans.marts import COMPLETED_STATUS
from bankmart.plans.pipeline import clean_zone, publish, published
from bankmart.schemas import BASE_TABLES
from bankmart.session import SETTINGS, folder_bytes, size_for
from bankmart.sinks.ledger import resume_load
from bankmart.sinks.load import load_tables, outcome_frame, raise_on_failure
from bankmart.sinks.tables import refresh_database_table, refresh_table
from bankmart.sources.raw import ALL, LAST_WINS, STOP
from bankmart.sources.tables import base_tables
from bankmart.store import written

Models = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Selection:
    """The dashboard's choices: a date range, both ends included, and account types; none means all."""

    first: dt.date | None = None
    last: dt.date | None = None
    account_types: tuple[str, ...] = ()


def _products(base: Models) -> tuple[DataFrame, ...]:
    return tuple(base[t] for t in ("FactTransaction", "DimProduct", "DimProductSubCategory", "DimProductCategory"))


# Reports by name: base tables, models and the selection in, one result out.
REPORTS: dict[str, Callable[[Models, Models, Selection], DataFrame]] = {
    "monthly_revenue": lambda base, _, __: analytics.monthly_revenue(base["FactTransaction"]),
    "top_customers": lambda base, _, __: analytics.top_customers(
        base["FactTransaction"], base["DimAccount"], base["DimCustomer"]
    ),
    "failure_risk": lambda base, _, __: analytics.failure_risk(*_products(base)),
    "customer_percentiles": lambda base, _, __: analytics.customer_percentiles(
        base["FactTransaction"], base["DimAccount"], base["DimCustomer"]
    ),
    "product_volume_rank": lambda base, _, __: analytics.product_volume_rank(*_products(base)),
    "product_volume_rank_sub": lambda base, _, __: analytics.product_volume_rank_sub(*_products(base)),
    "row_counts": lambda base, _, __: analytics.row_counts(base),
    "daily_volume": lambda _, models, chosen: indicators.daily_volume(
        models["fact_transactions"], models["dim_date"], chosen.first, chosen.last
    ),
    "undated_volume": lambda _, models, __: indicators.undated_volume(models["fact_transactions"]),
    "branch_liquidity": lambda _, models, __: indicators.branch_liquidity(models["dim_account"]),
    "balance_distribution": lambda _, models, __: indicators.balance_distribution(models["dim_account"]),
    "rolling_30d": lambda _, models, chosen: indicators.rolling_30d(
        models["fact_transactions"], chosen.first, chosen.last
    ),
    "branch_volume_rank": lambda _, models, chosen: indicators.branch_volume_rank(
        models["fact_transactions"], chosen.first, chosen.last
    ),
    "account_type_breakdown": lambda _, models, chosen: indicators.account_type_breakdown(
        models["dim_account"], chosen.account_types
    ),
}


def _pair(text: str) -> tuple[str, str]:
    name, separator, value = text.partition("=")
    if not separator or name not in BASE_TABLES:
        raise argparse.ArgumentTypeError(f"expected <base table>=<value>, got {text}")
    return name, value


def _sized(spark: SparkSession, args: argparse.Namespace, measured: Callable[[], int]) -> None:
    """Size the session by the bytes given, or else by what the job reads."""
    size_for(spark, args.input_bytes or measured())


def _stored_bytes(spark: SparkSession, database: str) -> int:
    """Bytes of the base tables that are there, by their locations."""
    names = [t for t in BASE_TABLES if spark.catalog.tableExists(f"{database}.{t}")]
    details = [spark.sql(f"DESCRIBE FORMATTED `{database}`.`{t}`").filter("col_name = 'Location'").first() for t in names]
    return sum(folder_bytes(spark, row["data_type"]) for row in details if row is not None)


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    _sized(spark, args, lambda: folder_bytes(spark, args.raw))
    options: dict[str, dict[str, str]] = {}
    for table, pattern in args.date_format:
        options.setdefault(table, {})["date_format"] = pattern
    options.setdefault("DimAccount", {})["key"] = args.account_key
    files: dict[str, list[str]] = {}
    for table, name in args.file:
        files.setdefault(table, []).append(name)
    unreadable: dict[str, dict[str, int]] = {}
    rejected: dict[str, int] = {}
    shapes = clean_zone(
        spark, args.raw, args.cleaned, files, options, args.same_name, unreadable, args.rejected, rejected
    )
    for table, (rows, columns) in shapes.items():
        print(f"{table}: {rows} rows, {columns} columns")
        if rejected.get(table):
            print(f"  {rejected[table]} rows do not fit their header and are under {args.rejected}")
        for column, count in unreadable[table].items():
            print(f"  {column}: {count} values could not be read and are null")


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    _sized(spark, args, lambda: folder_bytes(spark, args.cleaned))
    if args.jdbc_url:
        properties = dict(args.jdbc_property)

        def is_there(table: str) -> bool:
            return True  # A database table that is gone fails to be emptied, at its next load.

        def refresh(df: DataFrame, table: str) -> None:
            refresh_database_table(df, args.jdbc_url, table, properties, args.connections)
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{args.database}`")

        def refresh(df: DataFrame, table: str) -> None:
            refresh_table(df, f"{args.database}.{table}")

        def is_there(table: str) -> bool:
            return spark.catalog.tableExists(f"{args.database}.{table}")

    if args.ledger:
        outcomes = resume_load(spark, args.cleaned, refresh, args.ledger, is_there)
    else:
        outcomes = load_tables(spark, args.cleaned, refresh)
    outcome_frame(spark, outcomes).show(truncate=False)
    raise_on_failure(outcomes)


def build(spark: SparkSession, args: argparse.Namespace) -> None:
    _sized(spark, args, lambda: _stored_bytes(spark, args.database))
    publish(base_tables(spark, args.database), args.database, args.as_of, args.completed_status, args.join_calendar)


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    _sized(spark, args, lambda: _stored_bytes(spark, args.database))
    results = written(run_checks(published(base_tables(spark, args.database), args.database), CHECKS), "checks")
    results.filter("not passed").show(len(CHECKS), truncate=False)
    raise_on_error(results)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    _sized(spark, args, lambda: _stored_bytes(spark, args.database))
    base = base_tables(spark, args.database)
    chosen = Selection(args.first, args.last, tuple(args.account_type))
    result = REPORTS[args.name](base, published(base, args.database), chosen)
    if args.positions:
        result = with_position(result, analytics.report_order(args.name))
    result.write.mode("overwrite").parquet(args.output)


def _property(text: str) -> tuple[str, str]:
    name, separator, value = text.partition("=")
    if not separator:
        raise argparse.ArgumentTypeError(f"expected <name>=<value>, got {text}")
    return name, value


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="bankmart")
    jobs = top.add_subparsers(required=True)

    def job(name: str, run: Callable[[SparkSession, argparse.Namespace], None]) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        sub.add_argument("--input-bytes", type=int, default=0, help="overrides the measured size of the input")
        return sub

    sub = job("clean", clean)
    sub.add_argument("--raw", required=True, help="folder tree; its size is measured")
    sub.add_argument("--cleaned", required=True)
    sub.add_argument(
        "--file", type=_pair, action="append", required=True, metavar="TABLE=FILE",
        help="a file name, or a folder under --raw ending in a slash; repeatable per table",
    )
    sub.add_argument(
        "--same-name", choices=[STOP, LAST_WINS, ALL], default=STOP, help="files of one name in several folders"
    )
    sub.add_argument(
        "--account-key", choices=ACCOUNT_KEYS, default=ACCOUNT_KEYS[0], help="CustomerID keeps one account per customer"
    )
    sub.add_argument("--rejected", help="folder for rows that do not fit their header; without it they stop the job")
    sub.add_argument("--date-format", type=_pair, action="append", default=[], metavar="TABLE=PATTERN")
    sub = job("load", load)
    sub.add_argument("--cleaned", required=True)
    target = sub.add_mutually_exclusive_group(required=True)
    target.add_argument("--database", help="catalog database")
    target.add_argument("--jdbc-url", help="database whose tables are there already")
    sub.add_argument("--jdbc-property", type=_property, action="append", default=[], metavar="NAME=VALUE")
    sub.add_argument("--connections", type=int, default=8)
    sub.add_argument("--ledger", help="dataset of outcomes; tables loaded before and unchanged since are left alone")
    sub = job("publish", build)
    sub.add_argument("--database", required=True)
    sub.add_argument("--as-of", type=dt.date.fromisoformat)
    sub.add_argument("--completed-status", default=COMPLETED_STATUS, help="status that is_completed looks for")
    sub.add_argument("--join-calendar", action="store_true", help="join the calendar to the fact instead of computing its columns")
    sub = job("check", check)
    sub.add_argument("--database", required=True)
    sub = job("report", report)
    sub.add_argument("--database", required=True)
    sub.add_argument("--name", required=True, choices=sorted(REPORTS))
    sub.add_argument("--output", required=True)
    sub.add_argument("--first", type=dt.date.fromisoformat, help="first day, for reports over days")
    sub.add_argument("--last", type=dt.date.fromisoformat, help="last day")
    sub.add_argument("--account-type", action="append", default=[], help="for account_type_breakdown; repeatable")
    sub.add_argument("--positions", action="store_true", help="add each row's place, for reports that have an order")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("bankmart").getOrCreate()
    for name, value in SETTINGS.items():
        # Static settings are the cluster's.
        if spark.conf.isModifiable(name):
            spark.conf.set(name, value)
    args.run(spark, args)


if __name__ == "__main__":
    main()
