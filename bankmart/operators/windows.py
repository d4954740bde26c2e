"""Running totals, ranks and rolling averages.

All of them work on aggregated rows; the raw fact never enters a window.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankmart.functions.numbers import exact_average, percent
from bankmart.store import written


def running_total(value: str, order_by: str, *partition_by: str) -> Column:
    """Sum up to and including the current row and its peers."""
    frame = Window.partitionBy(*partition_by).orderBy(F.col(order_by).asc_nulls_last())
    return F.sum(value).over(frame.rangeBetween(Window.unboundedPreceding, Window.currentRow))


def rank_within(stored: DataFrame, group: str, score: Column, output: str) -> DataFrame:
    """Add the rank by descending score within the group; equal scores share a rank.

    A rank is one more than the number of rows with a larger score. One row per
    distinct score is dealt out by range, so a group with most of the products or
    scores spreads over tasks: each counts its own range, and the ranges' totals,
    one row per group and range, give what lies before it. Null scores count as
    largest. ``stored`` is read twice: pass a written table.
    """
    scored = stored.withColumn("_score", score)
    descending = F.col("_score").desc_nulls_first()
    # Written, as a range must keep its number.
    counted = written(
        scored.groupBy(F.col(group).alias("_group"), "_score").agg(F.count(F.lit(1)).alias("_rows"))
        .repartitionByRange(F.col("_group").asc_nulls_first(), descending)
        .withColumn("_range", F.spark_partition_id()),
        "scores",
    )
    ranges = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        counted.groupBy("_group", "_range").agg(F.sum("_rows").alias("_in_range"))
        .select("_group", "_range", F.coalesce(F.sum("_in_range").over(ranges), F.lit(0)).alias("_before"))
    )
    larger = Window.partitionBy("_group", "_range").orderBy(descending).rowsBetween(Window.unboundedPreceding, -1)
    within = counted.withColumn("_larger", F.coalesce(F.sum("_rows").over(larger), F.lit(0)))
    placed = within.alias("w").join(
        before.alias("b"),
        F.col("w._group").eqNullSafe(F.col("b._group")) & (F.col("w._range") == F.col("b._range")),
    )
    ranks = placed.select(
        "w._group", F.col("_score").alias("_of"), (F.col("_larger") + F.col("_before") + 1).cast("bigint").alias(output)
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col("_score").eqNullSafe(F.col("_of"))
    return scored.join(ranks, same).drop("_score", "_group", "_of")


def _range_offsets(stored: DataFrame, rows: Column) -> DataFrame:
    """For each ``_range`` the rows of all ranges before it, ``_before``, and of all, ``_all``.

    The driver adds up one number per range, of which there are as many as shuffle partitions.
    """
    counts = sorted((r["_range"], r["_in_range"]) for r in stored.groupBy("_range").agg(rows.alias("_in_range")).collect())
    before = list(accumulate((n for _, n in counts), initial=0))
    offsets = [(number, start, before[-1]) for (number, _), start in zip(counts, before)]
    return stored.sparkSession.createDataFrame(offsets, "_range int, _before bigint, _all bigint")


def rank_and_percentile(stored: DataFrame, score: str, rank_name: str, percentile_name: str) -> DataFrame:
    """Every row with its rank by descending score and the percentile of rows with a smaller one.

    Two windows over all rows would sort them in one task. Instead each distinct score is one row
    with its number of ties, dealt out by range; a range counts what lies before a score within it,
    and one short row per range gives what lies before the range. Rows get both back by their score,
    so however many share one, they are counted before they are shuffled. Null scores count as
    largest; a single row has percentile 0. ``stored`` is read twice: pass a written table.
    """
    descending = F.col("_score").desc_nulls_first()
    # Written, as a range must keep its number.
    ties = written(
        stored.groupBy(F.col(score).alias("_score")).agg(F.count(F.lit(1)).alias("_ties"))
        .repartitionByRange(descending).withColumn("_range", F.spark_partition_id()),
        "scores",
    )
    ranges = _range_offsets(ties, F.sum("_ties"))
    larger = Window.partitionBy("_range").orderBy(descending).rowsBetween(Window.unboundedPreceding, -1)
    counted = ties.withColumn("_larger", F.coalesce(F.sum("_ties").over(larger), F.lit(0)))
    placed = counted.join(F.broadcast(ranges), "_range")
    rank = F.col("_larger") + F.col("_before") + 1
    share = percent(F.col("_all") - (rank - 1) - F.col("_ties"), F.col("_all") - 1, 1)
    ranks = placed.select(
        "_score", rank.cast("bigint").alias(rank_name), F.coalesce(share, F.lit(0).cast("decimal(12,1)")).alias(percentile_name)
    )
    return stored.join(ranks, F.col(score).eqNullSafe(F.col("_score"))).drop("_score")


def with_position(df: DataFrame, order: Sequence[Column], output: str = "position") -> DataFrame:
    """All rows in order, with their place in it from 1.

    Rows are dealt out by range and sorted within ranges, as a final sort does; a row's place is
    its place within its range plus the rows of all ranges before, one short row per range. ``order``
    must be total, or else rows that tie get their places in any order. Written, as a range must keep its rows.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = written(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_range"), within.alias("_within")),
        "ordered",
    )
    placed = ordered.join(F.broadcast(_range_offsets(ordered, F.count(F.lit(1)))), "_range")
    return placed.select(*df.columns, (F.col("_before") + F.col("_within") + 1).alias(output)).orderBy(output)


def rolling_average(df: DataFrame, key: str, day: str, value: str, days: int, output: str) -> DataFrame:
    """Average of ``value`` over the calendar days ``day - days + 1 .. day`` per key.

    ``df`` holds at most one row per key and day, so one key never brings more
    rows than the calendar has days, however many events it had.
    """
    frame = (
        Window.partitionBy(key).orderBy(F.unix_date(F.col(day))).rangeBetween(-(days - 1), 0)
    )
    average = exact_average(F.sum(value).over(frame), F.count(value).over(frame))
    return df.withColumn(output, average)


def top_with_percentile(
    stored: DataFrame, score: str, k: int, tie_break: str, rank_name: str, percentile_name: str
) -> DataFrame:
    """The ``k`` rows with the largest score, with rank and percentile among all rows.

    Written as two global windows this would sort every row in one task. Instead
    the top rows come from a distributed top-k, whose ranks are already global
    because everything above them is among them; one aggregate over all rows
    gives their number and how many tie with each top score. The percentile is
    then ``smaller / (n - 1)``. ``stored`` is read more than once: pass a written
    table, not an expensive plan. Null scores count as largest.
    """
    top = stored.orderBy(F.col(score).desc_nulls_first(), F.col(tie_break).asc()).limit(k)
    by_score = Window.orderBy(F.col(score).desc_nulls_first())
    ranked = top.withColumn(rank_name, F.rank().over(by_score).cast("bigint"))

    # At most k scores, hence the broadcast; the join adds at most k groups.
    top_scores = top.select(F.struct(F.col(score)).alias("_top")).distinct()
    counted = (
        stored.select(F.col(score).alias("_score"))
        .join(F.broadcast(top_scores), F.col("_score").eqNullSafe(F.col("_top")[score]), "left")
        .groupBy("_top")
        .agg(F.count(F.lit(1)).alias("_ties"))
        .withColumn("_rows", F.sum("_ties").over(Window.partitionBy()))
    )
    smaller = F.col("_rows") - (F.col(rank_name) - 1) - F.col("_ties")
    share = percent(smaller, F.col("_rows") - 1, 1)
    return (
        ranked.join(F.broadcast(counted), F.col(score).eqNullSafe(F.col("_top")[score]) & F.col("_top").isNotNull())
        .withColumn(percentile_name, F.coalesce(share, F.lit(0).cast("decimal(12,1)")))
        .drop("_top", "_ties", "_rows")
    )
