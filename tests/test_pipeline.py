"""CSV files to checked star schema, end to end."""

import datetime as dt
from functools import partial

import pytest
from helpers import FILES, money, rows

from bankmart import jobs
from bankmart.operators.balance import find_hot_keys
from bankmart.operators.quality import ChecksFailed, run_checks
from bankmart.plans import pipeline
from bankmart.plans.checks import CHECKS
from bankmart.plans.marts import dim_date as marts_dim_date
from bankmart.plans.pipeline import clean_zone, publish, star_schema
from bankmart.sinks.load import load_tables, raise_on_failure
from bankmart.sinks.tables import refresh_table
from bankmart.sources.tables import base_tables

AS_OF = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("bank")
    for name, text in FILES.values():
        folder = root / "raw" / name.split(".")[0]
        folder.mkdir(parents=True)
        (folder / name).write_text(text)
    shapes = clean_zone(
        spark, str(root / "raw"), str(root / "cleaned"), {table: name for table, (name, _) in FILES.items()}
    )
    assert shapes["DimAccount"] == (3, 9) and shapes["FactTransaction"] == (4, 9) and shapes["DimProduct"] == (2, 3)
    spark.sql("CREATE DATABASE bank_pipeline")
    outcomes = load_tables(
        spark, str(root / "cleaned"), lambda df, table: refresh_table(df, f"bank_pipeline.{table}")
    )
    raise_on_failure(outcomes)
    assert {o.table: o.rows for o in outcomes}["DimCustomer"] == 2
    yield "bank_pipeline"
    spark.sql("DROP DATABASE bank_pipeline CASCADE")


def test_published_models(spark, database):
    models = publish(base_tables(spark, database), database, AS_OF)
    fact = spark.table(f"{database}.fact_transactions")
    # The first row of transaction 1 wins; a customer's second account stays.
    assert rows(fact, "transaction_id", "customer_id", "transaction_amount", "product_name", "category_name", "year") == [
        (1, 1, money("5.25"), "Gold", "Retail", 2023),
        (2, 1, money("1.00"), "Odd", None, 2024),
        (3, 2, money("2.00"), None, None, None),
    ]
    assert rows(models["dim_date"], "date_key") == [(dt.date(2023, 12, 30) + dt.timedelta(days=i),) for i in range(3)]
    assert rows(models["dim_customer"], "customer_id", "age_bucket") == [(1, "25-34"), (2, "Unknown")]
    assert spark.table("stg_transactions").count() == 3
    results = run_checks(models, CHECKS)
    failed = {r.test_name: r.failures for r in results.filter("not passed").collect()}
    assert failed == {
        "not_null_stg_transactions_transaction_date": 1,
        "accepted_values_dim_customer_status": 1,
        "not_null_dim_product_category_name": 1,
        "not_null_fact_transactions_date_key": 1,
        "relationships_fact_transactions_product_id": 1,
    }
    assert results.count() == 42


def test_lazy_models_equal_published_ones(spark, database):
    lazy = star_schema(base_tables(spark, database), AS_OF)
    published = publish(base_tables(spark, database), database, AS_OF)
    for name in ("dim_account", "dim_product", "dim_date", "fact_transactions"):
        assert rows(lazy[name]) == rows(published[name])


def test_publish_reads_the_transactions_twice(spark, database, monkeypatch):
    """Once for hot keys and once for the fact; the calendar reads the stored fact."""
    seen = []
    monkeypatch.setattr(pipeline, "find_hot_keys", lambda df, *keys: seen.append(keys) or find_hot_keys(df, *keys))
    monkeypatch.setattr(pipeline.marts, "dim_date", lambda df, date: seen.append(date) or marts_dim_date(df, date))
    publish(base_tables(spark, database), database, AS_OF)
    assert seen == [("customer_id",), ("account_id", "product_id"), "date_key"]


def test_publishing_again_replaces(spark, database):
    publish_again = partial(publish, base_tables(spark, database), database, AS_OF)
    first = publish_again()["fact_transactions"].count()
    assert publish_again()["fact_transactions"].count() == first


def test_jobs_run_the_whole_pipeline(spark, tmp_path, capsys):
    raw, cleaned, output = (str(tmp_path / name) for name in ("raw", "cleaned", "report"))
    for name, text in FILES.values():
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / name).write_text(text)
    files = [part for table, (name, _) in FILES.items() for part in ("--file", f"{table}={name}")]
    target = ["--database", "bank_jobs"]
    jobs.main(["clean", "--raw", raw, "--cleaned", cleaned, *files, "--date-format", "DimCustomer=yyyy-MM-dd"])
    assert "FactTransaction: 4 rows, 9 columns" in capsys.readouterr().out
    jobs.main(["load", "--cleaned", cleaned, *target])
    jobs.main(["publish", *target, "--as-of", "2024-01-01"])
    with pytest.raises(ChecksFailed, match="not_null_stg_transactions_transaction_date: 1"):
        jobs.main(["check", *target])
    expected = {"row_counts": 7, "failure_risk": 1, "top_customers": 2, "daily_volume": 3, "rolling_30d": 2}
    for name, count in expected.items():
        jobs.main(["report", *target, "--name", name, "--output", output])
        assert spark.read.parquet(output).count() == count
    chosen = {
        "daily_volume": (["--first", "2023-12-31", "--last", "2024-01-01"], 2),
        "account_type_breakdown": (["--account-type", "Savings"], 1),
    }
    for name, (arguments, count) in chosen.items():
        jobs.main(["report", *target, "--name", name, "--output", output, *arguments])
        assert spark.read.parquet(output).count() == count
    spark.sql("DROP DATABASE bank_jobs CASCADE")


def test_job_arguments_are_checked():
    with pytest.raises(SystemExit):
        jobs.main(["clean", "--raw", "r", "--cleaned", "c", "--file", "Unknown=x.csv"])
    with pytest.raises(SystemExit):
        jobs.main(["report", "--database", "d", "--name", "unknown", "--output", "o"])
