import pytest
from helpers import one, plan_of, rows

from bankmart.operators import quality as q
from bankmart.operators.quality import Check
from bankmart.plans.checks import CHECKS


def parent_and_child(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    child = spark.createDataFrame([(1, "A"), (2, "b"), (3, "x"), (3, "x"), (None, None)], "pid int, v string")
    return {"parent": parent, "child": child}


@pytest.mark.parametrize(
    "check, failures",
    [
        (Check("parent", "id", q.UNIQUE), 1),
        (Check("child", "pid", q.UNIQUE), 1),
        (Check("child", "pid", q.NOT_NULL), 1),
        (Check("parent", "id", q.NOT_NULL), 0),
        (Check("child", "v", q.ACCEPTED_VALUES, values=("A", "b")), 1),
        (Check("child", "v", q.ACCEPTED_VALUES, values=("A",)), 2),
        (Check("child", "v", q.ACCEPTED_VALUES, values=("A", "b", "x")), 0),
        (Check("child", "pid", q.RELATIONSHIPS, parent="parent", parent_column="id"), 2),
        (Check("parent", "id", q.RELATIONSHIPS, parent="child", parent_column="pid"), 0),
    ],
)
def test_kinds(spark, check, failures):
    result = q.run_checks(parent_and_child(spark), [check])
    assert result.columns == list(q.RESULT_COLUMNS)
    assert one(result) == (check.name, check.model, check.column, check.kind, "error", failures, failures == 0)


def test_empty_models_pass(spark):
    models = {name: df.limit(0) for name, df in parent_and_child(spark).items()}
    checks = [
        Check("child", "pid", q.UNIQUE), Check("child", "pid", q.NOT_NULL),
        Check("child", "v", q.ACCEPTED_VALUES, values=("A",)),
        Check("child", "pid", q.RELATIONSHIPS, parent="parent", parent_column="id"),
    ]
    assert rows(q.run_checks(models, checks), "failures") == [(0,)] * 4


def test_only_errors_raise(spark):
    models = parent_and_child(spark)
    warning = Check("child", "pid", q.RELATIONSHIPS, q.WARN, parent="parent", parent_column="id")
    results = q.run_checks(models, [warning, Check("parent", "id", q.NOT_NULL)])
    q.raise_on_error(results)
    with pytest.raises(q.ChecksFailed, match="unique_parent_id: 1"):
        q.raise_on_error(q.run_checks(models, [warning, Check("parent", "id", q.UNIQUE)]))


def test_declared_checks():
    kinds = [check.kind for check in CHECKS]
    assert len(CHECKS) == 42 and len({check.name for check in CHECKS}) == 42
    assert [kinds.count(k) for k in (q.NOT_NULL, q.UNIQUE, q.ACCEPTED_VALUES, q.RELATIONSHIPS)] == [25, 9, 4, 4]
    assert [c.name for c in CHECKS if c.severity == q.WARN] == ["relationships_fact_transactions_account_id"]


def test_one_read_of_a_model_for_all_its_checks(spark, tmp_path):
    """Plans: the fact once; each parent once for itself and once as the fact's parent."""
    fact = spark.range(100).selectExpr("id AS k", "id % 7 AS a", "cast(id % 3 AS string) AS b", "date'2024-01-01' AS d")
    fact.write.parquet(str(tmp_path / "fact"))
    spark.range(5).selectExpr("cast(id AS int) AS a", "date'2024-01-01' AS d").write.parquet(str(tmp_path / "dim"))
    models = {name: spark.read.parquet(str(tmp_path / name)) for name in ("fact", "dim")}
    checks = [
        Check("fact", "k", q.UNIQUE), Check("fact", "k", q.NOT_NULL), Check("fact", "a", q.NOT_NULL),
        Check("fact", "b", q.ACCEPTED_VALUES, values=("0", "1")),
        Check("fact", "a", q.RELATIONSHIPS, parent="dim", parent_column="a"),
        Check("fact", "d", q.RELATIONSHIPS, parent="dim", parent_column="d"),
    ]
    result = q.run_checks(models, checks)
    plan = plan_of(result)
    assert sum("FileScan" in line and "/fact]" in line for line in plan.splitlines()) == 1
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    # 5 and 6 have no parent: 14 rows each; "2" is not accepted.
    assert [r.failures for r in result.collect()] == [0, 0, 0, 1, 28, 0]


def test_keys_of_any_type_are_compared_as_a_join_would(spark):
    parent = spark.sql("SELECT * FROM VALUES (1, 1.50, '1') AS t(i, m, s)")
    child = spark.sql("SELECT * FROM VALUES (1L, 1.5, '1'), (2L, 1.25, '01'), (NULL, NULL, NULL) AS t(i, m, s)")
    for column in ("i", "m", "s"):
        check = Check("child", column, q.RELATIONSHIPS, parent="parent", parent_column=column)
        assert one(q.run_checks({"parent": parent, "child": child}, [check]))[5] == 1


def test_checks_are_compiled_and_dates_compared_as_numbers(spark):
    days = spark.sql("SELECT explode(array(date'2024-01-01', date'2024-01-02', date'1969-12-31', NULL)) AS d")
    models = {"days": days, "known": days.where("d > date'2024-01-01'")}
    checks = [
        Check("days", "d", q.UNIQUE), Check("days", "d", q.NOT_NULL),
        Check("days", "d", q.RELATIONSHIPS, parent="known", parent_column="d"),
    ]
    result = q.run_checks(models, checks)
    assert rows(result, "failures") == [(0,), (1,), (2,)]
    plan = plan_of(result)
    assert "lambda" not in plan and "unix_date" in plan and "cast(d#" not in plan
