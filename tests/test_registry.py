"""Every registered query against DuckDB on the same files."""

import compare
import pytest

import __spark_entry__ as entry
from bankmart.sample import oracle, registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.duckdb_on(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got, expected = compare.spark_table(df), compare.duckdb_table(duck, ORACLE[name])
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert got[1] == expected[1]


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["category", "sub_category", "productname"] and not df.isEmpty()
