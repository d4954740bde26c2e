"""Nearest neighbours against all products."""

import random

import numpy as np
from pyspark.sql import functions as F

from bankmart.llm.neighbours import nearest, quantised, tile


def expected(rows, k, wanted):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q in sorted({i for i, _ in good if wanted(i)}):
        best = {}
        for own in (v for i, v in good if i == q):
            for i, v in good:
                if i != q and len(v) == len(own):
                    score = 0.0
                    for a, b in zip(own, v):
                        score += float(np.float32(a)) * float(np.float32(b))
                    best[i] = max(score, best.get(i, -np.inf))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n, i, s) for n, (i, s) in enumerate(ranked, 1)]
    return out


def found(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, VEC_ID string")


def test_equals_all_products_over_several_tiles(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(17)]) for i in range(230)]
    rows += [(i, rows[5][1]) for i in range(230, 300)] + [(i, [x * 1000 for x in rows[i][1]]) for i in range(3)]
    got = nearest(frame(spark, rows).repartition(3), F.col("vec_id") % 20 == 0, k=7, query_block=4, candidate_block=50)
    assert found(got) == expected(rows, 7, lambda i: i % 20 == 0)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []),
            (7, [3.0, -1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [5.0, 5.0]), (20, [-9.0, 1.0]), (9, [1e-30, 0.0])]
    got = nearest(frame(spark, rows), F.col("vec_id") % 20 == 0)
    assert found(got) == expected(rows, 20, lambda i: i % 20 == 0)
    assert nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_quantisation_bounds_every_product():
    x = np.random.default_rng(2).normal(size=(300, 70)) * np.exp(np.random.default_rng(3).normal(size=(300, 1)) * 3)
    codes, scale, rest = quantised(x)
    about = (codes @ codes.T) * scale[:, None] * scale
    length = np.linalg.norm(x, axis=1)
    assert (np.abs(x @ x.T - about) <= (rest[:, None] * length + (length + rest)[:, None] * rest) * (1 + 1e-9)).all()


def test_equal_vectors_keep_the_smallest_ids():
    c = np.ones((50, 3))
    ids = np.arange(50)[::-1].copy()
    ((q, v, s),) = tile(np.array([2]), np.ones((1, 3)), ids, c, 4)
    assert v.tolist() == [0, 1, 3, 4]
