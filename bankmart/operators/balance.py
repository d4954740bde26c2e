"""Left joins that stay balanced when a few keys hold much of the left side.

Adaptive execution splits skewed join partitions only above a size. Where that is
not enough, keys with more rows than an average shuffle partition are found in one
pass and their rows are dealt to several pieces; the right side gets one copy of a
hot row per piece. Which keys are treated as hot changes the work of each task,
never the result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# So many values of a column can be hot, and so many are tracked to find them.
MOST_HOT = 1000
TRACKED = 20_000


@dataclass(frozen=True)
class HotKeys:
    """Keys by the number of pieces their rows are dealt to, and the pieces for rows without a key."""

    keys: dict[int, tuple[object, ...]] = field(default_factory=dict)
    null_pieces: int = 1

    def pieces_of(self, key: Column) -> Column:
        """Pieces of a row's key; 1 for keys that are not hot."""
        pieces = F.when(key.isNull(), 1)
        for count, keys in self.keys.items():
            pieces = pieces.when(key.isin(*keys), count)
        return pieces.otherwise(1)


NONE_HOT = HotKeys()


def _shuffle_partitions(spark: SparkSession) -> int:
    regular = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or regular)


def _power_of_two(pieces: float) -> int:
    return 1 << max(0, math.ceil(math.log2(pieces)))


def find_hot_keys(df: DataFrame, *keys: str) -> tuple[HotKeys, ...]:
    """For each key column its values, null included, that hold more rows than an average shuffle partition.

    One pass over the key columns, whatever their number: a sketch of ``TRACKED``
    values per column finds every value that holds ``1 / MOST_HOT`` of the rows. A
    hot one is dealt to so many pieces that each is no larger than an average
    partition, so all pieces are about twice as many as there are partitions.
    """
    sketches = [F.expr(f"approx_top_k(`{key}`, {MOST_HOT}, {TRACKED})").alias(f"_{i}") for i, key in enumerate(keys)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *sketches).first()
    partitions = _shuffle_partitions(df.sparkSession)
    found = []
    for i in range(len(keys)):
        hot: dict[int, tuple[object, ...]] = {}
        null_pieces = 1
        for value, count in sorted(row[f"_{i}"] or (), key=lambda r: (r[0] is not None, r[0] or 0)):
            pieces = _power_of_two(count / row["rows"] * partitions)
            if value is None:
                null_pieces = pieces
            elif pieces > 1:
                hot[pieces] = (*hot.get(pieces, ()), value)
        found.append(HotKeys(hot, null_pieces))
    return tuple(found)


def balanced_left_join(left: DataFrame, right: DataFrame, key: str, spread_by: str, hot: HotKeys) -> DataFrame:
    """``left.join(right, key, "left")`` with the rows of hot and null keys dealt out by ``spread_by``."""
    if not hot.keys and hot.null_pieces == 1:
        return left.join(right, key, "left")
    pieces = hot.pieces_of(F.col(key))
    left_pieces = F.when(F.col(key).isNull(), hot.null_pieces).otherwise(pieces)
    dealt = left.withColumn("_piece", F.pmod(F.xxhash64(spread_by), left_pieces).cast("int"))
    copied = right.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return dealt.join(copied, [key, "_piece"], "left").drop("_piece")
