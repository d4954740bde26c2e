"""Divergence of sources against a plain reading of its rule."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bankmart.llm import divergence, registry
from compare import duckdb_on, duckdb_table, spark_table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least=3, top=200):
    """``rows``: text, lang, source."""
    held, counts, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang or "", source or ""].update(terms)
        total[lang or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = []
    for lang in total:
        kept = [t for t in total[lang] if held[lang][t] >= least]

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        price = lambda p, q: (p - q) ** 2 // q
        groups = {s: share(c) for (own, s), c in counts.items() if own == lang}
        whole = share(total[lang])
        for s, p in groups.items():
            parts = {
                "pair": [(sum(price(p[t], q[t]) for t in kept), o) for o, q in groups.items() if o != s],
                "term": [(price(p[t], whole[t]), t) for t in kept if counts[lang, s][t] and p[t] > whole[t]],
            }
            for part, found in parts.items():
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def texts(df):
    return [(r["text"], r["lang"], r["source"]) for r in df.select("text", "lang", "source").collect()]


def test_equals_the_rule(spark, docs):
    assert found(divergence.audit(docs)) == expected(texts(docs))


@pytest.mark.parametrize("block,tile", [(1 << 13, 32), (4, 2), (1, 1), (16, 100)])
def test_tiles_and_blocks_change_nothing(spark, block, tile):
    rows = [(f"common word{'abcdefg'[i % 7]} È{'abcde'[i % 5]}É rare{chr(97 + i % 23)} " * (1 + i % 3), "x" if i % 4 else "y", f"s{i % 9}") for i in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert found(divergence.audit(docs, block=block, tile=tile)) == expected(rows)


def test_odd_rows_and_clashing_columns(odd_docs):
    plain = [tuple(r)[1:4] for r in odd_docs.collect()]
    assert found(divergence.audit(odd_docs)) == expected(plain)
    assert found(divergence.audit(odd_docs, least=1, top=2)) == expected(plain, 1, 2)


def test_language_without_kept_terms(spark):
    rows = [("a b", "x", "s"), ("c", "x", "t"), (None, "x", None), ("d d d", None, "s")]
    assert found(divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"))) == expected(rows)


def test_no_rows(no_docs):
    assert divergence.audit(no_docs).count() == 0


def test_joins_are_not_limited_to_small_tables(docs, monkeypatch):
    monkeypatch.setattr("bankmart.llm.joins.SMALL_BYTES", -1)
    assert found(divergence.audit(docs)) == expected(texts(docs))


def test_equal_subtrees_are_one_node():
    counts = np.array([[1, 2, 1, 2, 0, 0, 0, 0], [1, 2, 0, 0, 0, 0, 1, 2]])
    leaves, levels, roots = divergence.trees(counts)
    assert leaves.tolist() == [0, 1, 2] and [low.size for low, _ in levels] == [2, 4, 2]
    other, left, right, times = divergence.leaf_pairs(levels, roots[0], roots[1:])
    assert sorted(zip(left, right, times)) == [(0, 0, 2), (0, 1, 1), (0, 2, 1), (1, 0, 1), (1, 1, 1), (2, 0, 1), (2, 2, 1)]


def test_shares_of_very_large_counts_are_exact():
    counts, whole = np.array([0, 3, 2**62], np.int64), 2**62 + 10
    assert divergence.shares(counts, whole).tolist() == [1 + 10**9 * (int(c) + 1) // whole for c in counts]


def test_a_long_text_is_read_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = "Éa bb, CC\x00dd[ee]ff  {g}é xx".encode()
    assert [t for p in divergence._pieces(text) for t in p] == "Éa bb cc dd ee ff g é xx".encode().split()


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert spark_table(registry.op12_source_divergence(spark, sf_dir)) == duckdb_table(duckdb_on(sf_dir), registry.DIVERGENCE_SQL)
