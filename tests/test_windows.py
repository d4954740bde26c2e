import datetime as dt
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from helpers import money, plan_of, rows
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from bankmart.operators.windows import (
    rank_and_percentile, rank_within, rolling_average, running_total, top_with_percentile, with_position,
)
from bankmart.store import written

FEW = hypothesis_settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def test_running_total_includes_peers(spark):
    df = spark.createDataFrame([("a", 1, 10), ("b", 1, 5), ("a", 2, 1), ("a", 1, 2)], "g string, m int, v int")
    overall = df.withColumn("t", running_total("v", "m"))
    assert rows(overall, "m", "t") == [(1, 17), (1, 17), (1, 17), (2, 18)]
    by_group = df.withColumn("t", running_total("v", "m", "g"))
    assert rows(by_group, "g", "m", "t") == [("a", 1, 12), ("a", 1, 12), ("a", 2, 13), ("b", 1, 5)]


@FEW
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 4))), min_size=1, max_size=25
    )
)
def test_rank_equals_the_window_function(spark, records):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(records)], "id int, g string, v int")
    window = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first())
    literal = df.withColumn("r", F.rank().over(window).cast("bigint"))
    assert rows(rank_within(df, "g", F.col("v"), "r")) == rows(literal)


def test_no_group_is_ranked_in_one_task(spark):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("g"), (F.col("id") % 700).alias("v"))
    ranked = rank_within(df, "g", F.col("v"), "r")
    plan = plan_of(ranked)
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # One window counts within a range, the other adds up one row per group and range.
    assert len(windows) == 2 and sum("_range" in line.split("], [")[1] for line in windows) == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    literal = F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())).cast("bigint")
    assert rows(ranked) == rows(df.withColumn("r", literal))


def literal_top(scores, k):
    """The two global windows by definition: id, score, rank, percentile."""
    n = len(scores)

    def above(a, b):
        return (a is None and b is not None) or (a is not None and b is not None and a > b)

    result = []
    for i, score in scores:
        rank = 1 + sum(above(other, score) for _, other in scores)
        smaller = sum(above(score, other) for _, other in scores)
        share = Fraction(100 * smaller, n - 1) if n > 1 else Fraction(0)
        tenths = Decimal(share.numerator) / Decimal(share.denominator)
        result.append((rank, i, score, tenths.quantize(Decimal("0.1"), ROUND_HALF_UP)))
    return sorted(result)[:k]


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=25), st.integers(1, 8))
def test_top_with_percentile_equals_global_windows(spark, values, k):
    scores = [(i, None if v is None else money(f"{v}.00")) for i, v in enumerate(values)]
    df = spark.createDataFrame(scores, "id int, score decimal(25,2)")
    top = top_with_percentile(df, "score", k, "id", "rank", "percentile")
    got = sorted((r["rank"], r["id"], r["score"], r["percentile"]) for r in top.collect())
    assert [g[:2] + g[3:] for g in got] == [e[:2] + e[3:] for e in literal_top(scores, k)]


def test_top_with_percentile_moves_only_top_rows_to_one_task(spark):
    df = spark.range(1000).select("id", (F.col("id") % 50).cast("decimal(25,2)").alias("score"))
    plan = plan_of(top_with_percentile(df, "score", 20, "id", "rank", "percentile"))
    assert "TakeOrderedAndProject" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    single = plan.index("Exchange SinglePartition")
    assert plan.index("HashAggregate(keys=[_top", single) < plan.index("Range (", single)


@FEW
@given(
    st.dictionaries(
        st.tuples(st.integers(1, 3), st.integers(0, 80)), st.integers(1, 10_000), min_size=1, max_size=40
    ),
    st.integers(1, 40),
)
def test_rolling_average_equals_brute_force(spark, cents, days):
    start = dt.date(2024, 1, 1)
    records = [(k, start + dt.timedelta(days=d), Decimal(c).scaleb(-2)) for (k, d), c in cents.items()]
    df = spark.createDataFrame(records, "k int, d date, v decimal(25,2)")
    expected = []
    for (k, d), _ in cents.items():
        window = [c for (k2, d2), c in cents.items() if k2 == k and d - days < d2 <= d]
        mean = Decimal(sum(window)) / Decimal(100 * len(window))
        expected.append((k, start + dt.timedelta(days=d), mean.quantize(Decimal("0.01"), ROUND_HALF_UP)))
    assert rows(rolling_average(df, "k", "d", "v", days, "avg"), "k", "d", "avg") == sorted(expected)


@pytest.mark.parametrize("scores", [[5, 3, 3, 1, None, 5, 2], [1], [2] * 50, [None, None], [], list(range(100)) + [7] * 60])
def test_rank_and_percentile_of_every_row(spark, scores):
    stored = written(spark.createDataFrame(list(enumerate(scores)), "id int, score int"))
    ranked = rank_and_percentile(stored, "score", "r", "p")
    by_size = [float("inf") if s is None else s for s in scores]
    expected = []
    for i, s in enumerate(by_size):
        smaller, others = sum(x < s for x in by_size), len(scores) - 1
        share = Decimal(100 * smaller) / Decimal(others) if others else Decimal(0)
        expected.append((i, scores[i], 1 + sum(x > s for x in by_size), share.quantize(Decimal("0.1"), ROUND_HALF_UP)))
    assert rows(ranked, "id", "score", "r", "p") == sorted(expected)


def test_no_task_ranks_all_rows(spark):
    stored = written(spark.range(1000).select("id", (F.col("id") % 300).alias("score")))
    plan = plan_of(rank_and_percentile(stored, "score", "r", "p"))
    assert "SinglePartition" not in plan and "Window" in plan


def test_position_is_the_place_in_the_order(spark):
    stored = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("id"), (F.col("id") % 3).alias("k"))
    order = [F.col("k").desc_nulls_first(), F.col("id").asc()]
    placed = with_position(stored, order)
    expected = sorted(((r.id, r.k) for r in stored.collect()), key=lambda r: (-r[1], r[0]))
    got = placed.collect()
    assert [(r.id, r.k) for r in got] == expected and [r.position for r in got] == list(range(1, 5001))
    assert "SinglePartition" not in plan_of(placed) and with_position(stored.limit(0), order).isEmpty()
