"""Language prediction on rows kept from training."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from bankmart.llm import language, registry

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = registry.op10_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_clean_documents_are_not_rejected(spark):
    rows = registry.op10_language(spark, SF)
    assert rows.where("rejected").count() == 0


def test_only_other_rows_train(spark, docs):
    """Neither held-out texts nor their labels change a prediction."""
    out = F.when(language.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))
    a, b = language.train(docs), language.train(docs.withColumn("lang", out))
    assert a.languages == b.languages and (a.centroids == b.centroids).all() and (a.idf == b.idf).all()


def test_odd_rows(spark, docs, odd_docs, no_docs):
    model = language.train(docs)
    out = language.identify(odd_docs, model)
    assert out.columns == [*odd_docs.columns, "lang_pred", "score", "rejected"]
    got = out.toDF(*[f"c{i}" for i in range(len(out.columns))]).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if not any(c.isalpha() for c in r[1] or ""):
            assert (r[-3], r[-2], r[-1]) == ("und", 0.0, True)
        else:
            assert r[-3] in model.languages
    assert language.identify(no_docs, model).count() == 0
    nothing = language.train(no_docs)
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}


def test_other_scripts_are_rejected(spark, docs):
    model = language.train(docs)
    for text in ("Съешь же ещё этих мягких французских булок, да выпей чаю. " * 20, "いろはにほへと ちりぬるを わかよたれそ つねならむ " * 30):
        lang, score, rejected = model.nearest(text)
        assert rejected and lang in model.languages


UNLEARNED = {
    "Italian": "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, ché la diritta via era smarrita. Ahi quanto a dir qual era è cosa dura esta selva selvaggia e aspra e forte che nel pensier rinova la paura! ",
    "Polish": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. ",
    "Finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. ",
    "Turkish": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler. ",
}


def test_unlearned_languages_in_the_same_script_are_rejected(spark):
    model = language.train(spark.read.parquet(f"{SF}/documents.parquet"))
    for name, text in UNLEARNED.items():
        assert model.nearest(text * 5)[2], name
    # Repeats say nothing new: as many distinct trigrams, the same limit.
    assert model.nearest(UNLEARNED["Polish"])[2] == model.nearest(UNLEARNED["Polish"] * 50)[2]


def test_random_letters_are_rejected(spark):
    model = language.train(spark.read.parquet(f"{SF}/documents.parquet"))
    draw = random.Random(5)
    for words in (5, 40, 300):
        assert model.nearest(" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(words)))[2]


def test_clean_held_out_documents_stay(spark):
    """Of ten times as many documents, learned from a bounded sample of the others, none goes."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = docs.where(language.held_out(F.col("doc_id")))
    assert language.identify(held, language.train(docs)).where("rejected").count() == 0


def test_limits_rise_with_length():
    lengths, scores = np.repeat([0, 1, 2, 3], 400), np.tile(np.linspace(0.2, 1, 400), 4) * np.repeat([1, 0.5, 2, 1], 400)
    limits = language.least_cosines(lengths, scores)
    assert len(limits) == 4 and limits[0] == limits[1] < limits[2] == limits[3]
    assert language.least_cosines(np.array([], int), np.array([])).tolist() == [0.0]
    assert language.least_cosines(np.array([1]), np.array([0.9])).tolist() == [0.0, 0.0]


def test_the_sample_is_bounded(spark):
    """Rows without an id, or of one id, are drawn each by its text; equal rows fill no more than the bound."""
    rows = [(None, f"some english words number {i}", "en") for i in range(3000)]
    rows += [(7, "ein deutscher text", "de")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    drawn = {r["lang"]: (r["n"], r["texts"]) for r in language.sampled(docs, 100).groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("text").alias("texts")).collect()}
    assert drawn["en"] == (100, 100) and drawn.get("de", (100, 1)) == (100, 1)


def test_counts_are_of_trigrams():
    at, n = language.counts("aaaa")
    assert n.sum() == 4  # " aa", "aaa" twice, "aa "
    assert language.counts("a1b")[1].sum() == language.counts("a b")[1].sum() == language.counts("A ,;7 b")[1].sum()
    assert language.counts("12 ;") is None and language.counts(None) is None


def test_several_centroids_per_language(docs):
    model = language.train(docs)
    assert max(model.languages.count(x) for x in set(model.languages)) == language.CLUSTERS
