"""Loads that go on where an earlier one stopped."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import astuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from bankmart.sinks.load import (
    FAILED, LOAD_ORDER, LOADED_BEFORE, OUTCOME_SCHEMA, PARENT_FAILED, SUCCESS, LoadOutcome, load_tables,
)

# Base tables and the ones they refer to.
PARENTS: dict[str, tuple[str, ...]] = {
    "DimProductSubCategory": ("DimProductCategory",),
    "DimProduct": ("DimProductSubCategory",),
    "DimAccount": ("DimCustomer",),
    "FactTransaction": ("DimAccount", "DimProduct"),
}

LEDGER_SCHEMA = f"{OUTCOME_SCHEMA}, fingerprint string, at timestamp"


def fingerprint(spark: SparkSession, path: str) -> str:
    """A short text that changes with the names, sizes or times of a dataset's files; none of them is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    mark = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(20,0)")
    row = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.sum(mark).alias("marks")).first()
    return f"{row['files']}:{row['bytes']}:{row['marks']}"


def last_outcomes(spark: SparkSession, ledger: str) -> dict[str, Row]:
    """The last recorded outcome of each dataset; none if there is no ledger yet."""
    try:
        entries = spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except Exception as error:  # noqa: BLE001 - only an absent ledger is as good as an empty one
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return {}
    last = entries.groupBy("name").agg(F.max_by(F.struct("status", "rows", "columns", "fingerprint"), "at").alias("last"))
    return {row["name"]: row["last"] for row in last.collect()}  # one per dataset


def _record(spark: SparkSession, ledger: str, outcome: LoadOutcome, mark: str | None) -> None:
    entry = (*astuple(outcome), mark, dt.datetime.now(dt.timezone.utc))
    spark.createDataFrame([entry], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(ledger)


def resume_load(
    spark: SparkSession,
    cleaned_root: str,
    load: Callable[[DataFrame, str], object],
    ledger: str,
    is_there: Callable[[str], bool] = lambda table: True,
    tables: Iterable[tuple[str, str]] = LOAD_ORDER,
    parents: Mapping[str, tuple[str, ...]] = PARENTS,
) -> list[LoadOutcome]:
    """As ``load_tables``, with a record of every outcome in the dataset ``ledger``.

    A dataset is left alone (``LOADED_BEFORE``) if its last load succeeded, its files are the same
    since, its table is still there, and no table it refers to was loaded anew now: emptying a parent
    empties its children in a database. A table is not tried (``PARENT_FAILED``) while one that it
    refers to could not be loaded. Outcomes are recorded one by one, so a run that is cut off has kept
    what it did; a load whose record is missing is done again, which changes nothing.
    """
    before = last_outcomes(spark, ledger)
    outcomes, renewed, missing = [], set(), set()
    for name, table in tables:
        broken = [parent for parent in parents.get(table, ()) if parent in missing]
        if broken:
            outcome, mark = LoadOutcome(name, table, PARENT_FAILED, error=f"not loaded: {', '.join(broken)}"), None
        else:
            outcome, mark = _load_one(spark, cleaned_root, load, name, table, before.get(name), is_there, renewed & set(parents.get(table, ())))
        if outcome.status == SUCCESS:
            renewed.add(table)
        elif outcome.status in (FAILED, PARENT_FAILED):
            missing.add(table)
        if outcome.status != LOADED_BEFORE:
            _record(spark, ledger, outcome, mark)
        outcomes.append(outcome)
    return outcomes


def _load_one(
    spark: SparkSession,
    cleaned_root: str,
    load: Callable[[DataFrame, str], object],
    name: str,
    table: str,
    last: Row | None,
    is_there: Callable[[str], bool],
    renewed_parents: set[str],
) -> tuple[LoadOutcome, str | None]:
    """The outcome of one table, and the fingerprint of what was loaded."""
    try:
        # Taken before the load: files that change meanwhile are loaded again next time.
        mark = fingerprint(spark, f"{cleaned_root.rstrip('/')}/{name}")
    except Exception as error:  # noqa: BLE001 - recorded per table, as in a load
        return LoadOutcome(name, table, FAILED, error=str(error)), None
    done = last is not None and last["status"] == SUCCESS and last["fingerprint"] == mark
    if done and not renewed_parents and is_there(table):
        return LoadOutcome(name, table, LOADED_BEFORE, last["rows"], last["columns"]), mark
    (outcome,) = load_tables(spark, cleaned_root, load, [(name, table)])
    return outcome, mark
