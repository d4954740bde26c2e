from collections import Counter

from helpers import plan_of, rows
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bankmart.operators.dedup import SOURCE_ORDER, drop_null_keys, keep_first

FEW = hypothesis_settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def test_drop_null_keys(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (2, 2)], "a int, b int")
    assert rows(drop_null_keys(df, "a")) == [(1, None), (2, 2)]
    assert rows(drop_null_keys(df, "a", "b")) == [(2, 2)]


def test_position_decides_when_there_is_one(spark):
    df = spark.createDataFrame([(1, "late", 9), (1, "early", 3), (2, "only", 5)], f"k int, v string, {SOURCE_ORDER} int")
    assert rows(keep_first(df, ["k"]), "k", "v") == [(1, "early"), (2, "only")]


def test_smallest_row_with_nulls_first_without_a_position(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, None, 9), (2, "x", 2), (2, "x", 1)], "k int, v string, w int")
    assert rows(keep_first(df, ["k"])) == [(1, None, 9), (2, "x", 1)]


@FEW
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5), st.sampled_from("abc")), max_size=30))
def test_matches_brute_force(spark, records):
    df = spark.createDataFrame(records, "k int, v int, w string").repartition(3)
    expected = {}
    for record in sorted(records):
        expected.setdefault(record[0], record)
    assert rows(keep_first(df, ["k"])) == sorted(expected.values())


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    kept = keep_first(hot, ["k"])
    plan = plan_of(kept)
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    counts = Counter(k for k, _ in rows(kept))
    assert len(counts) == 20_001 and set(counts.values()) == {1}
    assert kept.filter("k = -1").collect()[0].v == 0
