"""The pipeline's stages against plain versions of their decisions."""

import re

import pytest

import corpus_pipeline
from bankmart.llm import language, near_dedup, registry
from bankmart.llm.columns import table

SF = "/root/testdata/sf0.001"


def columns(df):
    return [(f.name, f.dataType) for f in df.schema]


def test_stages_in_order_and_their_columns(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert columns(stage(spark, docs, SF)) == columns(docs)


def test_run_equals_the_stages_by_hand(spark, docs):
    model = language.train(docs)
    rows = [r for r in docs.orderBy("doc_id").collect() if not model.nearest(r.text)[2]]
    holders = {}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(lower)
    for r in rows:
        for x in r.text.split("\n"):
            holders.setdefault(key(x), r.doc_id)
    texts = {r.doc_id: "\n".join(x for x in r.text.split("\n") if len(key(x)) < 10 or holders[key(x)] == r.doc_id) for r in rows}
    known, parent = near_dedup._Hashes(), {}
    bags = {i: near_dedup.bag(t, known) for i, t in texts.items()}
    parent = {i: i for i in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    full = list(bags)
    for n, i in enumerate(full):
        for j in full[:n]:
            if near_dedup.similarity(bags[i], bags[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    items = [re.findall(r"\w+", r.text.lower()) for r in table(spark, SF, "benchmark").collect()]
    runs = {" ".join(w[k : k + 13]) for w in items for k in range(len(w) - 12)}
    held = lambda t: any(" ".join(w[k : k + 13]) in runs for w in [re.findall(r"\w+", t.lower())] for k in range(len(w) - 12))
    kept = {i for i in texts if root(i) == i and not held(texts[i])}
    got = corpus_pipeline.run(spark, SF).select("doc_id", "doc_tokens").distinct().collect()
    assert {r.doc_id for r in got} == kept and len(got) == len(kept)


def test_odd_rows(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    docs = odd_docs.toDF("doc_id", "text", "lang", "source", "DOC_ID", "n_chars").withColumn("n_chars", F.col("n_chars").cast("long"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).toDF(*[f"c{i}" for i in range(len(stage(spark, docs, SF).columns))]).count() >= 1
        assert stage(spark, no_docs, SF).count() == 0


def test_a_null_id_is_dropped_only_for_its_own_sake(spark, odd_docs, docs):
    kept = corpus_pipeline.one_of_each_class(spark, odd_docs, SF)
    plain = kept.toDF(*[f"c{i}" for i in range(len(kept.columns))]).collect()
    assert sorted(r[0] for r in plain if r[0] is not None) == [1, 2, 2, 3, 5, 5, 7] and sum(r[0] is None for r in plain) == 2


def test_rows_without_an_id_or_with_a_repeated_one_go_by_themselves(spark):
    item = table(spark, SF, "benchmark").first().text
    other = "a clean text of its own about rivers and hills that nobody has copied from anywhere else"
    copied = "one more text that stands here twice or more, word for word, and that is long enough for shingles"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = lambda texts: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], schema)
    got = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    clean = corpus_pipeline.without_benchmark(spark, rows([(None, item), (None, other), (4, item), (4, copied)]), SF)
    assert got(clean) == sorted([(None, other), (4, copied)], key=str)
    single = corpus_pipeline.one_of_each_class(spark, rows([(None, copied), (None, copied), (None, other), (9, item), (6, other), (9, other)]), SF)
    assert got(single) in ([(6, other), (9, item), (None, copied)], sorted([(6, other), (9, item), (None, copied)], key=str))


def test_registered():
    assert registry.queries()["pipeline"] is corpus_pipeline.run
    names = [n for n in registry.queries() if n != "pipeline"]
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, name):
    import compare

    duck = compare.duckdb_on(SF)
    assert compare.spark_table(registry.queries()[name](spark, SF)) == compare.duckdb_table(duck, registry.oracle_sql()[name])
