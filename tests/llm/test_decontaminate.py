"""Benchmark items in documents, planted and by brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from bankmart.llm import decontaminate
from bankmart.llm.decontaminate import RUN, contaminated, raw_words, template_words

ITEM = "In the town of Alder a farmer named Boris sells 12 apples for 3 dollars each and then walks 5 km to visit Clara before noon"


def frame(spark, texts, name="doc_id"):
    return spark.createDataFrame([(i, t, "x") for i, t in texts], f"{name} long, text string, TEXT string")


def found(spark, docs, items):
    out = contaminated(frame(spark, docs), frame(spark, items, "item_id")).collect()
    return {(r["doc_id"], r["item_id"]): r for r in out}


def test_other_numbers_names_and_units(spark):
    again = ITEM.replace("Alder", "Birch").replace("Boris", "Dmitri").replace("12", "140").replace("3 dollars", "9 euros").replace("5 km", "2 miles")
    wrong = "the farmer named Boris met Boris and gave 5 apples and 5 pears to Anna who sold 7 of them"
    mixed = "the farmer named Oleg met Igor and gave 8 apples and 9 pears to Vera who sold 4 of them"
    got = found(spark, [(1, f"Some words here. {ITEM} and more"), (2, f"Some words. {again}."), (3, mixed), (4, wrong), (5, "nothing of the kind here")],
                [(10, ITEM), (11, wrong)])
    assert set(got) == {(1, 10), (2, 10), (4, 11)}
    assert got[1, 10]["same_slots"] and not got[2, 10]["same_slots"]
    assert got[2, 10]["n_slots"] >= 7


def test_case_and_punctuation_do_not_matter(spark):
    text = ITEM.lower().replace(" and ", " -- and,\n")
    assert set(found(spark, [(1, text)], [(10, ITEM.lower())])) == {(1, 10)}


def test_every_offset_and_both_ends(spark):
    rng = random.Random(5)
    item = " ".join(f"word{rng.randrange(10**6):x}q" for _ in range(RUN))
    rows = [(n, " ".join(["pad"] * n + [item] + ["end"] * (n % 3))) for n in range(20)]
    short = [(100 + n, " ".join(["pad"] * n + item.split()[: RUN - 1])) for n in range(20)]
    assert {d for d, _ in found(spark, rows + short, [(1, item)])} == {n for n, _ in rows}


@pytest.mark.parametrize("n", [1, 5, 8, 12])
def test_short_items_count_when_whole(spark, n):
    item = " ".join(f"unusual{i}" for i in range(n))
    got = found(spark, [(1, f"a b {item} c"), (2, " ".join(item.split()[:-1]) + " d")], [(7, item)])
    assert set(got) == {(1, 7)}


def test_odd_rows(spark, odd_docs, no_docs):
    items = frame(spark, [(1, None), (2, ""), (3, "A first line of text"), (None, "a line of text that has no id at all"), (3, "A first line of text")], "item_id")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(odd_docs, items).collect()}
    assert got == {(1, 3), (2, 3), (8, 3), (None, 3), (None, None)}
    assert contaminated(no_docs, items).count() == 0
    assert contaminated(odd_docs, items.limit(0)).count() == 0


def test_placeholders_alone_do_not_count(spark):
    numbers = " ".join(str(i) for i in range(40))
    assert not found(spark, [(1, " ".join(str(i * 7) for i in range(40)))], [(1, numbers)])


def test_templates_keep_the_number_of_words(spark):
    texts = [ITEM, "1,000.5 km of Tom2 and McDonald O'Neil; 5km § x\u00a0y", "É. Été au Nord 3 %", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    sizes = df.select(F.size(template_words(F.col("text"))), F.size(raw_words(F.col("text")))).collect()
    assert all(a == b for a, b in sizes) and sizes[0][0] == len(ITEM.split())


def test_test_tables_by_brute_force(spark, docs, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    word = re.compile(r"\w+")
    own = {r.item_id: " " + " ".join(word.findall(r.text.lower())) + " " for r in items.collect()}
    whole = {(d.doc_id, i) for d in docs.collect() for t in [" " + " ".join(word.findall(d.text.lower())) + " "] for i, x in own.items() if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()}
    assert whole and whole <= got
    monkeypatch.setattr("bankmart.llm.joins.SMALL_BYTES", -1)
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()} == got
    # Whatever else is found shares a stretch of words with the item.
    shared = lambda t, x: any(" ".join(w[k : k + RUN]) in x for w in [t.split()] for k in range(len(w) - RUN + 1))
    texts = {d.doc_id: " ".join(word.findall(d.text.lower())) for d in docs.collect()}
    assert all(shared(own[i], texts[d]) for d, i in got)


def plain(n, seed=9):
    rng = random.Random(seed)
    return [f"w{rng.randrange(16**6):06x}q" for _ in range(n)]


def test_a_slot_at_odds_ends_a_stretch_and_no_more(spark):
    words = plain(40)
    words[2] = words[34] = "5"
    other = [*words[:34], "6", *words[35:]]
    got = found(spark, [(1, " ".join(other)), (2, " ".join([*words[:8], "other", *words[9:20]]))], [(1, " ".join(words))])
    assert set(got) == {(1, 1)} and got[1, 1]["run_words"] == 37 and got[1, 1]["same_slots"]


def test_a_stretch_full_of_placeholders_hides_no_other(spark):
    words, numbers = plain(20), [str(i) for i in range(100, 130)]
    item, doc = " ".join(words + numbers), " ".join(words + [str(int(n) + 500) for n in numbers])
    got = found(spark, [(1, doc)], [(1, item)])
    assert got[1, 1]["run_words"] == 40 and got[1, 1]["n_slots"] == 20
    again = " ".join(plain(20, 1) + [str(i) for i in range(5)] + ["end"] + words)
    assert set(found(spark, [(1, again + " x " + " ".join(numbers))], [(1, item)])) == {(1, 1)}


@pytest.mark.parametrize("first", range(1, 8))
def test_every_alignment_of_a_run_full_of_slots(spark, first):
    words = plain(13, first)
    for k in range(first, first + 5):
        words[k] = str(300 + k)
    other = [str(int(w) + 70) if w.isdigit() else w for w in words]
    rows = [(n, " ".join(["pad"] * n + other + ["end"] * (n % 3))) for n in range(6)]
    assert {d for d, _ in found(spark, rows, [(1, " ".join(words))])} == set(range(6))


def test_copies_in_other_case_and_spacing(spark):
    words = plain(30, 3)
    for k, name in zip(range(2, 30, 4), ["Alder", "Boris", "Clara", "Dmitri", "Elena", "Fred", "Greta"]):
        words[k] = name
    words[9] = "17"
    item = " ".join(words)
    rows = [item.lower(), item.upper(), item.replace(" ", "  "), item.replace(" ", "\n"), item.lower().replace("17", "18"), item.replace("Boris", "boris").replace("Greta", "Olga")]
    assert {d for d, _ in found(spark, list(enumerate(rows)), [(1, item)])} == set(range(len(rows)))


def test_names_that_open_sentences(spark):
    item = "Anna has 3 apples and 4 pears. Boris has 5 plums and 6 figs. Clara has 7 nuts and 8 dates."
    again = item.replace("Anna", "Zoe").replace("Boris", "Otto").replace("Clara", "Mia")
    mixed = again.replace("Otto", "Zoe").replace("Mia", "Zoe").replace("5", "9").replace("6", "9")
    short = "Anna buys 3 red apples"
    got = found(
        spark,
        [(1, again), (2, "Here: “" + again + "”"), (3, again.replace("Zoe", "ZOE").replace("Mia", "MIA")), (4, mixed), (5, "Zoe buys 4 red apples"), (6, "he buys 4 red apples")],
        [(1, item), (2, short)],
    )
    assert set(got) == {(1, 1), (2, 1), (3, 1), (5, 2)}
    assert got[1, 1]["run_words"] == 21 and got[1, 1]["n_slots"] == 9 and not got[1, 1]["same_slots"]


def longest_plain(counted, need):
    """By trying all parts: length and start of the longest with no more placeholders than words; the first of equals."""
    n = len(counted)
    fitting = [(e - s, -s) for s in range(n) for e in range(s + need, n + 1) if 2 * sum(counted[s:e]) <= e - s]
    return (-max(fitting)[1], max(fitting)[0]) if fitting else None


def test_longest_part_that_is_plain_enough(spark):
    rng = random.Random(3)
    rows = [[rng.random() < share for _ in range(rng.randint(1, 40))] for share in (0.2, 0.45, 0.5, 0.55, 0.6, 0.7, 0.9, 1.0) for _ in range(60)]
    data = [(i, rng.choice([1, 3, 8, 13]), [(c,) for c in row]) for i, row in enumerate(rows)]
    laid = spark.createDataFrame(data, "id int, need int, run array<struct<counted boolean>>")
    got = {r["id"]: r["best"] and tuple(r["best"]) for r in decontaminate._plain_enough(laid).select("id", "best").collect()}
    assert got == {i: longest_plain(row, need) for (i, need, _), row in zip(data, rows)}


def test_a_table_of_figures_in_an_item(spark):
    """2,000 numbers against an item of 100: seconds, as placeholders alone are never a hit."""
    words = plain(20)
    item = " ".join([*words, *map(str, range(100, 200))])
    docs = [(1, " ".join(str(i) for i in range(2000))), (2, " ".join([*words, *map(str, range(500, 2500))]))]
    got = found(spark, docs, [(1, item)])
    assert set(got) == {(2, 1)} and got[2, 1]["run_words"] == 40


def test_a_third_of_the_rows_without_an_id(spark, monkeypatch):
    """Rows without an id are laid against their own places only."""
    item = " ".join(plain(30, 4))
    docs = [(None if i % 3 == 0 else i, " ".join([*plain(20, 100 + i), item if i % 10 == 0 else "", *plain(20, 500 + i)])) for i in range(90)]
    written, frames = decontaminate.written, {}
    monkeypatch.setattr(decontaminate, "written", lambda df, label: frames.setdefault(label, written(df, label)))
    assert set(found(spark, docs, [(1, item)])) == {(i, 1) for i, t in docs if item in t}
    assert frames["benchmark-documents"].count() == 9


def test_placeholder_characters_in_a_text(spark):
    words = plain(16, 6)
    words[5] = "17"
    other = [*words[:5], "\ue000", *words[6:]]
    assert not found(spark, [(1, " ".join(other[:13]))], [(1, " ".join(words))])
    assert set(found(spark, [(1, " ".join(words))], [(1, " ".join(words))])) == {(1, 1)}


def test_reparameterised_items_of_the_test_table(spark):
    """Every item of the table, with other numbers and names, in a document of its own: recall and clean ones."""
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    rng, names = random.Random(8), ["Alder", "Boris", "Clara", "Dmitri"]

    def planted(text):
        """Every eighth word a number or a name."""
        return " ".join((str(rng.randint(10, 99)) if k % 16 else rng.choice(names)) if k % 8 == 4 else w for k, w in enumerate(text.split()))

    def changed(text):
        other = dict(zip(names, ["Oleg", "Petra", "Quentin", "Rosa"]))
        shift = rng.randint(100, 900)
        return " ".join(str(int(w) + shift) if w.isdigit() else other.get(w, w) for w in text.split())

    own = [(r.item_id, planted(r.text)) for r in items]
    docs = [(i, " ".join([*plain(30, 1000 + i), changed(t), *plain(30, 2000 + i)])) for i, t in own]
    clean = [(10_000 + i, " ".join(plain(120, 3000 + i))) for i in range(len(own))]
    got = set(found(spark, docs + clean, own))
    assert len({d for d, i in got if d == i}) >= 0.95 * len(own)
    assert all(d == i or dict(own)[d] == dict(own)[i] for d, i in got)
