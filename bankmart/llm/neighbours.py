"""Exact nearest neighbours by inner product, as a block matrix join on int8 tiles.

Queries and candidates are packed into blocks, and each pair of blocks is a tile of its own,
found by an equi-join on the tile's number. A tile multiplies int8 codes; quantisation bounds
each product's error, so candidates whose best case is worse than the ``k``-th best worst case
are out. The others' products are taken again in double precision, summed in the order of the
components. Each tile gives its ``k`` best per query, and a ranked limit merges the tiles.

All queries against all rows is the question itself, so the work grows with their product;
a task holds one tile at a time, and a query's rows to merge are ``k`` per candidate block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.columns import pick
from bankmart.llm.joins import small
from bankmart.llm.shipping import ship
from bankmart.store import written

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
# int8 products summed over this many components are whole numbers that a float holds exactly.
EXACT_DIMS = 1 << 10
STEP = 256
BLOCK = "dim int, block long, ids binary, vectors binary"


def _blocks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Pack the rows of each dimension into blocks, as little-endian bytes."""
    held: dict[int, list[tuple[int, bytes]]] = {}

    def block(dim: int) -> pa.RecordBatch:
        rows = held.pop(dim)
        ids = np.array([i for i, _ in rows], "<i8").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([ids], pa.binary()), pa.array([b"".join(v for _, v in rows)], pa.binary())],
            names=["dim", "ids", "vectors"],
        )

    for batch in batches:
        vectors = batch.column(1)
        values, offsets = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f8"), np.asarray(vectors.offsets)
        offsets = offsets - offsets[0]
        for row, i in enumerate(batch.column(0).to_pylist()):
            vector = values[offsets[row] : offsets[row + 1]]
            held.setdefault(len(vector), []).append((i, vector.tobytes()))
            if len(held[len(vector)]) == size:
                yield block(len(vector))
    for dim in list(held):
        yield block(dim)


def _blocked(rows: DataFrame, size: int, label: str) -> DataFrame:
    """Blocks with a number, written once: the number must not change when a task runs again."""
    packed = rows.mapInArrow(partial(_blocks, size=size), "dim int, ids binary, vectors binary")
    return written(packed.withColumn("block", F.monotonically_increasing_id()), label)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes as floats, the scale of each row, and the length of what the codes leave out."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127)
    return codes.astype(np.float32), scale, np.linalg.norm(x - codes * scale[:, None], axis=1)


def tile(qids: np.ndarray, q: np.ndarray, cids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays of query, candidate and score: each query's ``k`` best, by score and then id. A row isn't its own candidate."""
    # Of equal vectors only the smallest ids can be among the k best; one more, as a query is left out of its own.
    order = np.lexsort((cids, *c.T[::-1])) if len(c) > 1 else np.arange(len(c))
    cids, c = cids[order], c[order]
    first = np.concatenate(([True], (c[1:] != c[:-1]).any(axis=1)))
    starts = np.flatnonzero(first)
    place = np.arange(len(c)) - starts[np.cumsum(first) - 1]
    cids, c = cids[place <= k], c[place <= k]

    (qcodes, qscale, qrest), (ccodes, cscale, crest) = quantised(q), quantised(c)
    qlength, clength = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
    out = []
    for at in range(0, len(q), STEP):
        own = slice(at, at + STEP)
        product = np.zeros((len(qcodes[own]), len(c)), np.float64)
        for d in range(0, q.shape[1], EXACT_DIMS):
            product += qcodes[own, d : d + EXACT_DIMS] @ ccodes[:, d : d + EXACT_DIMS].T
        product *= qscale[own, None]
        product *= cscale[None, :]
        # |x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'|, and |x'| <= |x| + |x - x'|; a little more for rounding.
        slack = (qrest[own, None] * clength + (qlength[own] + qrest[own])[:, None] * crest) * (1 + 1e-9)
        slack += 1e-12 * qlength[own, None] * clength
        itself = qids[own, None] == cids[None, :]
        worst = np.where(itself, -np.inf, product - slack)
        least = np.partition(worst, -k, axis=1)[:, -k] if worst.shape[1] > k else np.full(len(worst), -np.inf)
        rows, columns = np.nonzero((product + slack >= least[:, None]) & ~itself)
        score = np.zeros(len(rows))
        for d in range(q.shape[1]):
            score += q[own][rows, d] * c[columns, d]
        ranked = np.lexsort((cids[columns], -score, rows))
        rows, columns, score = rows[ranked], columns[ranked], score[ranked]
        keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        out.append((qids[own][rows[keep]], cids[columns[keep]], score[keep]))
    return out


def _tiles(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            dim, qids, q, cids, c = (batch.column(n)[i].as_py() for n in range(5))
            shape = (-1, dim)
            for found in tile(np.frombuffer(qids, "<i8"), np.frombuffer(q, "<f8").reshape(shape),
                              np.frombuffer(cids, "<i8"), np.frombuffer(c, "<f8").reshape(shape), k):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(found, (pa.int64(), pa.int64(), pa.float64()))],
                    names=["query_id", "vec_id", "score"],
                )


def nearest(
    vectors: DataFrame, queries: Column, *, k: int = 20,
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` rows of largest inner product with each query row.

    ``vectors`` has ``vec_id`` and ``embedding``; ``queries`` is a condition on ``vec_id``. Every
    row but those of the query's own id is a candidate; fewer than ``k`` give fewer. Nearest
    first, ties to the smaller id. Vectors that are null, empty, zero or hold a null or a
    non-finite component take no part, nor do rows without an id, and vectors of different
    lengths aren't compared. An id that stands on two rows is two queries under one id, whose
    rows are merged, the better ones ranked. Other columns are ignored. No rows: no rows.
    """
    ship(vectors.sparkSession)
    plain = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    whole = plain.where(
        F.col("vec_id").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    )
    q = _blocked(whole.where(queries), query_block, "query-blocks").toDF("dim", "qids", "q", "qblock")
    c = _blocked(whole, candidate_block, "candidate-blocks").toDF("dim", "cids", "c", "cblock")
    # One row per tile, keyed by the numbers of its two blocks.
    # Candidate blocks' numbers go to the query blocks, so that no task lists all tiles.
    numbers = small(c.select(F.col("dim").alias("d"), "cblock"), 16)
    tiles = q.select("dim", "qblock").join(numbers, F.col("dim") == F.col("d")).drop("d")
    filled = tiles.join(q.drop("dim"), "qblock").join(c.drop("dim"), "cblock").select("dim", "qids", "q", "cids", "c")
    found = filled.mapInArrow(partial(_tiles, k=k), "query_id long, vec_id long, score double")
    # A row may come from several copies of an id; ranks count ids.
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
