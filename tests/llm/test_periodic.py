"""Periodic runs against a plain reading of their rule."""

import random

import pytest

from bankmart.llm import periodic, registry
from compare import duckdb_on, duckdb_table, spark_table


def expected(text):
    """All runs by trying every period, and the collapsed text."""
    w = (text or "").encode().split()
    n, found = len(w), set()
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k - d] for k in range(start + d, start + length)) for d in range(1, q)):
                found.add((start, length, q))
            i = j
    gone = {i for s, l, q in found for i in range(s + q, s + l)}
    return sorted(found, key=lambda r: (r[0], r[2])), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()


def found(df):
    return [([tuple(r) for r in row[-2]], row[-1]) for row in df.toDF(*[f"c{i}" for i in range(len(df.columns))]).collect()]


def random_texts(seed):
    draw = random.Random(seed)
    out = []
    for _ in range(400):
        letters = "abcdefgh"[: draw.choice([1, 2, 2, 3, 5])]
        words = []
        while len(words) < draw.randint(0, 120):
            unit = draw.choices(letters, k=draw.randint(1, draw.choice([3, 9, 17])))
            words += unit * draw.choice([1, 1, 4, 5, 9]) + unit[: draw.randint(0, len(unit))]
        out.append(draw.choice([" ", "\n", "  "]).join(words))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_rule(spark, seed):
    texts = random_texts(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert found(periodic.periodic_runs(docs)) == [expected(t) for t in texts]


def test_nested_powers(spark):
    """Runs in runs: (a^7 b)^5, (ab)^9 (ba)^9, Fibonacci words."""
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    texts = [" ".join(t) for t in (("a" * 7 + "b") * 5, "ab" * 9 + "ba" * 9, fib[-1] * 5, "a" * 50 + "b" * 51, ("a" * 50 + "b" * 51) * 4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert found(periodic.periodic_runs(docs)) == [expected(t) for t in texts]


def test_copies_in_one_batch_do_not_match_each_other(spark):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(i, text) for i in range(50)], "doc_id long, text string").coalesce(1)
    assert found(periodic.periodic_runs(docs)) == [([], text)] * 50


def test_odd_rows_and_clashing_columns(odd_docs):
    out = periodic.periodic_runs(odd_docs)
    assert out.columns == [*odd_docs.columns, "runs", "collapsed"]
    by_text = {r[1]: (r[-2], r[-1]) for r in out.toDF(*[f"c{i}" for i in range(len(out.columns))]).collect()}
    for text, (runs, collapsed) in by_text.items():
        if text is None or len(text) < 1000:
            assert ([tuple(r) for r in runs], collapsed) == expected(text)
        else:
            assert ([tuple(r) for r in runs], collapsed) == ([(0, 60_000, 3)], "word and others")


def test_a_million_times_one_word(spark):
    docs = spark.range(1).selectExpr("id AS doc_id", "repeat('a ', 1000000) AS text")
    assert found(periodic.periodic_runs(docs)) == [([(0, 1_000_000, 1)], "a")]


def test_no_rows(no_docs):
    assert periodic.periodic_runs(no_docs).count() == 0


def test_limits():
    with pytest.raises(ValueError):
        periodic.periodic_runs(None, times=3)


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert spark_table(registry.op13_periodic_runs(spark, sf_dir)) == duckdb_table(duckdb_on(sf_dir), registry.PERIODIC_SQL)
