"""Find benchmark questions in documents, also with other numbers, names or units.

Texts are brought to templates: a number, a name (a capitalised word) and a
unit after a number become placeholders of their type, other words are in lower case. Windows
are hash-joined, of a document one at each sixth word, which meets any stretch of thirteen words,
with names as placeholders and as plain words, of an item all, with every choice between these,
so a copy in other case is met too. How many words are placeholders is judged later. At each place so found, item and document
are laid against each other word by word. A stretch that agrees must have thirteen words, or be
the whole of a shorter item, and its slots must be consistent: each number, name or unit of the
item stands for one and the same in the document, and the other way about. A slot that breaks
this ends a stretch, as a word does that differs; every stretch between is judged.

All of it is built-in functions. Documents are not shuffled while the windows of the benchmark
and the places found are small enough to be looked up from the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart.llm.columns import pick
from bankmart.llm.joins import small
from bankmart.store import written

# The forms that texts are looked up in: without names, with names as templates have them, with all capitalised words as names.
FORMS = ("plain", "template", "capitals")
WINDOW = 8
RUN = 13
STRIDE = RUN - WINDOW + 1
LEAST_WORDS = 0.5

NUMBER, NAME, UNIT = "", "", ""
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds "
    "ton tons ml l liter liters litre litres second seconds minute minutes min hour hours day days week weeks month months "
    "year years percent cent cents dollar dollars euro euros degree degrees"
).split()
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F -¿ -⁯　-〿]+"


def _own_letters(text: Column) -> Column:
    """A text without the placeholders' own characters, which are of private use; they become another of these."""
    marks = NUMBER + NAME + UNIT
    held = F.contains(text, F.lit(NUMBER)) | F.contains(text, F.lit(NAME)) | F.contains(text, F.lit(UNIT))
    return F.when(held, F.translate(text, marks, 3 * "\ue003")).otherwise(text)


def _joined(text: Column) -> Column:
    """Without the marks inside numbers."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[.,](?<=\d[.,])(?=\d)", "")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), GAP), "")


def raw_words(text: Column) -> Column:
    return _words(_joined(text))


def _alone(first: str, more: str) -> str:
    """A pattern for whole words, by their first character and the others."""
    return rf"{first}(?<![^{GAP[1:-2]}]{first}){more}(?![^{GAP[1:-2]}])"


def _measured_of(joined: Column) -> Column:
    """Text with placeholders for numbers and the units behind them, which words alone decide."""
    t = F.regexp_replace(joined, _alone(r"\d", r"\d*"), NUMBER)
    return F.regexp_replace(t, rf"{NUMBER}{GAP}(?i:{'|'.join(UNITS)})(?![^{GAP[1:-2]}])", f"{NUMBER} {UNIT}")


def plain_words(text: Column) -> Column:
    """As many words as ``raw_words``, with placeholders for numbers and units."""
    return _words(_measured_of(_joined(text)))


def capital_words(text: Column) -> Column:
    """As many words as ``raw_words``, with placeholders for numbers, units and every capitalised word."""
    return _capital_of(_measured_of(_joined(text)))


def _capital_of(measured: Column) -> Column:
    return _words(F.regexp_replace(measured, _alone(r"\p{Lu}", r"\p{L}+"), NAME))


def template_words(text: Column) -> Column:
    """As many words as ``raw_words``, with placeholders."""
    return _template_of(_joined(text))


def _template_of(joined: Column) -> Column:
    t = F.regexp_replace(joined, r"[^\S ]\s*| \s+", " ")
    t = F.regexp_replace(t, r"\p{Lu}(?<=[\p{Ll}\d,;] \p{Lu})\p{Ll}\p{L}*", NAME)
    t = F.regexp_replace(t, r"\b\d+\b", NUMBER)
    t = F.regexp_replace(t, rf"{NUMBER} (?:{'|'.join(UNITS)})\b", f"{NUMBER} {UNIT}")
    return _words(t)


def _is_slot(word: Column) -> Column:
    return word.isin(NUMBER, NAME, UNIT)


def _with_forms(rows: DataFrame, forms: tuple[str, ...] = FORMS) -> DataFrame:
    """The words of ``text`` as they are looked up, one array for each way to read its names; null for one like the first.

    What the forms have in common is a column of its own, so that it is made once.
    """
    joined = rows.withColumn("_joined", _joined(F.col("text"))).withColumn("_measured", _measured_of(F.col("_joined")))
    made = joined.withColumns({
        forms[0]: _words(F.col("_measured")), "_template": _template_of(F.col("_joined")), "_capital": _capital_of(F.col("_measured")),
    })
    differs = lambda c: F.when(F.col(c) != F.col(forms[0]), F.col(c))
    return made.withColumns({forms[1]: differs("_template"), forms[2]: differs("_capital")}).drop("_joined", "_measured", "_template", "_capital")


def _hash(first: Column, others: Column) -> Column:
    """Of a window. What is a unit behind a number is one at its start, too, where the number is not seen."""
    return F.xxhash64(F.when(first.isin(UNITS), UNIT).otherwise(first), others)


def _places(words: str, size: int, stride: int) -> Column:
    last = F.size(words) - size
    return F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(stride))).otherwise(F.array().cast("array<int>"))


def _doc_windows(rows: DataFrame, forms: list[str], size: int, stride: int) -> DataFrame:
    """Place and hash of windows, in each form in which they differ."""
    hashes = lambda i: [F.when(F.col(f).isNotNull(), _hash(F.get(f, i), F.slice(f, i + 2, size - 1))).alias(f) for f in forms]
    places = rows.select("doc", F.explode(F.transform(_places(forms[0], size, stride), lambda i: F.struct(i.alias("at"), *hashes(i)))).alias("w"))
    own = F.array_distinct(F.array_compact(F.array(*[F.col(f"w.{f}") for f in forms])))
    return places.select("doc", "w.at", F.explode(own).alias("hash"))


def _item_windows(items: DataFrame, forms: list[str], size: int) -> DataFrame:
    """Place and hash of the windows at every place, with each choice of names read as names or as words."""
    at = _places(forms[0], size, 1)
    windows = items.select("item", *forms, F.explode(at).alias("at"))
    windows = windows.select("item", "at", *[F.slice(f, F.col("at") + 1, size).alias(f) for f in forms])
    first, last_form = F.col(forms[0]), F.coalesce(F.col(forms[-1]), F.col(forms[0]))

    def either(made, pair):
        plain = F.transform(made, lambda words: F.concat(words, F.array(pair["word"])))
        named = F.transform(made, lambda words: F.concat(words, F.array(F.lit(NAME))))
        return F.when(pair["name"], F.concat(plain, named)).otherwise(plain)

    pairs = F.zip_with(first, last_form, lambda w, n: F.struct(w.alias("word"), (n == NAME).alias("name")))
    chosen = F.aggregate(pairs, F.array(F.array().cast("array<string>")), either)
    # Words that hold a name and more are in the forms alone.
    chosen = F.concat(chosen, F.array_compact(F.array(*[F.col(f) for f in forms])))
    return windows.select("item", F.col("at").alias("item_at"), F.explode(F.array_distinct(F.transform(chosen, lambda w: _hash(F.get(w, F.lit(0)), F.slice(w, 2, size))))).alias("hash"))


def _run(flags: Column) -> Column:
    """Start and length of the longest stretch of true; the first, if several are as long."""
    step = lambda a, f: F.struct(
        (a["i"] + 1).alias("i"),
        F.when(f, a["own"] + 1).otherwise(0).alias("own"),
        F.when(f, F.greatest(a["best"], F.struct((a["own"] + 1).alias("length"), (a["own"] - a["i"]).alias("back")))).otherwise(a["best"]).alias("best"),
    )
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("own"), F.struct(F.lit(0).alias("length"), F.lit(0).alias("back")).alias("best"))
    return F.aggregate(flags, zero, step)["best"]


def _breaks(slots: Column, key: str, other: str) -> Column:
    """Pairs of slots that may not stand in one stretch: one ``key``, and not one ``other``. Neighbours within a key suffice."""
    order = F.array_sort(F.transform(slots, lambda p: F.struct(p["kind"].alias("kind"), p[key].alias("key"), p["at"].alias("at"), p[other].alias("other"))))
    n = F.greatest(F.size(order) - 1, F.lit(0))
    return F.filter(
        F.zip_with(F.slice(order, 1, n), F.slice(order, 2, n), lambda a, b: F.when(
            (a["kind"] == b["kind"]) & (a["key"] == b["key"]) & (a["other"] != b["other"]), F.struct(b["at"].alias("end"), (a["at"] + 1).alias("start"))
        )),
        lambda x: x.isNotNull(),
    )


def _stretches(pairs: Column, need: Column) -> Column:
    """Start and length of every longest stretch of ``need`` words that agree, with consistent slots."""
    # A word that does not agree ends a stretch, and the next one starts behind it; so does a slot at odds with an earlier one.
    cuts = F.transform(F.filter(pairs, lambda p: ~p["agree"]), lambda p: F.struct(p["at"].alias("end"), (p["at"] + 1).alias("start")))
    slots = F.filter(pairs, lambda p: p["agree"] & p["slot"])
    # Words that open a sentence are held against each other also where they are equal.
    opening = F.filter(pairs, lambda p: p["agree"] & p["capital"])
    breaks = [_breaks(s, *keys) for s in (slots, opening) for keys in (("i", "d"), ("d", "i"))]
    size = F.size(pairs)
    last = F.array(F.struct(size.alias("end"), (size + 1).alias("start")))
    events = F.array_sort(F.concat(cuts, *breaks, last))
    none = F.array().cast("array<struct<start:int,length:int>>")

    def step(a, e):
        own = F.array(F.struct(a["start"].alias("start"), (e["end"] - a["start"]).alias("length")))
        whole = (e["start"] > a["start"]) & (e["end"] - a["start"] >= need)
        return F.struct(F.greatest(a["start"], e["start"]).alias("start"), F.when(whole, F.concat(a["out"], own)).otherwise(a["out"]).alias("out"))

    return F.aggregate(events, F.struct(F.lit(0).alias("start"), none.alias("out")), step)["out"]


def _firsts(levels: str) -> Column:
    """Of an array of (level, ...) in order the first of each level."""
    return F.filter(levels, lambda x, i: (i == 0) | (F.get(levels, i - 1)["level"] != x["level"]))


def _plain_enough(laid: DataFrame) -> DataFrame:
    """``laid`` with ``best``: start and length of the longest part of ``run`` of which half are no placeholders.

    Null if that has fewer than ``need`` words. Going up by one at a word and down at a placeholder, a part is plain enough
    that ends no lower than it starts. Below the start there is a first place on each level down to the end's, behind a
    placeholder, and but for the last a last place, before one: the longest part lies between the two of one level. So
    placeholders alone are looked at, each once but for their sorting, and only where they are more than the words.
    """
    size = F.size("run")
    at = F.filter(F.transform("run", lambda p, i: F.when(p["counted"], i)), lambda i: i.isNotNull())
    laid = laid.withColumn("n", F.size(F.filter("run", lambda p: p["counted"])))
    laid = laid.withColumn("marks", F.when(2 * F.col("n") > size, at)).withColumn("depth", 2 * F.col("n") - size)
    down = F.transform("marks", lambda c, j: F.struct((2 * j + 1 - c).alias("level"), (c + 1).alias("start")))
    down = F.concat(F.array(F.struct(F.lit(0).alias("level"), F.lit(0).alias("start"))), down)
    before = F.transform("marks", lambda c, j: F.struct((2 * j - c).alias("level"), (-c).alias("back")))
    laid = laid.withColumns({
        "down": F.array_sort(F.filter(down, lambda x: (x["level"] >= 0) & (x["level"] <= F.col("depth")))),
        "before": F.array_sort(F.filter(before, lambda x: (x["level"] >= 0) & (x["level"] < F.col("depth")))),
    })
    ends = F.concat(F.transform(_firsts("before"), lambda x: -x["back"]), F.array(size))
    parts = F.zip_with(_firsts("down"), ends, lambda x, end: F.struct((end - x["start"]).alias("length"), (-x["start"]).alias("back")))
    longest = F.array_max(parts)
    best = F.when(F.col("marks").isNull(), F.struct(F.lit(0).alias("start"), size.alias("length"))).otherwise(
        F.struct((-longest["back"]).alias("start"), longest["length"].alias("length"))
    )
    laid = laid.withColumn("best", best)
    enough = F.when(F.col("best.length") >= F.col("need"), F.col("best"))
    # As the one element of a list, so that a condition on it is not put in terms of the lists above, many times over.
    return laid.select(*[c for c in laid.columns if c != "best"], F.explode(F.array(enough)).alias("best"))


def _array_bytes(*names: str) -> Column:
    """About what arrays of texts take in a row."""
    return sum((F.octet_length(F.concat_ws("", n)) + 24 * F.size(n) for n in names), F.lit(64))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``run_words``, ``n_slots``, ``same_slots``: one row per document and item found in it.

    ``run_words`` is the length of the longest stretch they share and that counts, ``n_slots`` its placeholders,
    ``same_slots`` whether all stand for the very words of the item. ``docs`` has ``doc_id`` and
    ``text``, ``benchmark`` ``item_id`` and ``text``; other columns are ignored. Null or empty
    texts hold nothing. Rows that repeat an id, or have none, are searched each for itself and
    reported under that id once; so are items. Stretches that are mostly placeholders don't count. No
    documents or no items: no rows.
    """
    items = pick(benchmark, "item_id", "text").where("text IS NOT NULL").withColumn("text", _own_letters(F.col("text")))
    forms = list(FORMS)
    items = _with_forms(items).select("item_id", template_words(F.col("text")).alias("words"), raw_words(F.col("text")).alias("raw"), capital_words(F.col("text")).alias("capital"), *forms)
    items = items.withColumn("need", F.least(F.size("words"), F.lit(RUN)))
    # A number of its own for each row: ids may repeat or be null.
    items = written(items.where("need > 0").withColumn("item", F.monotonically_increasing_id()), "benchmark-items")
    # What is found in a row follows from its text, so rows of one id, or of none, are told apart by two hashes of it.
    texts = pick(docs, "doc_id", "text").withColumn("text", _own_letters(F.col("text"))).withColumn(
        "doc", F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    )
    parsed = _with_forms(texts).select("doc", *forms)

    # Items shorter than a full stretch are looked for whole, at every place.
    short = [r["need"] for r in items.where(F.col("need") < RUN).select("need").distinct().collect()]  # at most RUN - 1
    plans = [(F.col("need") == RUN, WINDOW, STRIDE)] + [(F.col("need") == n, n, 1) for n in sorted(short)]
    found = None
    for which, size, stride in plans:
        own = written(_item_windows(items.where(which), forms, size), "benchmark-windows")
        hits = _doc_windows(parsed, forms, size, stride).join(small(own, 48), "hash")
        hits = hits.select("doc", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        found = hits if found is None else found.unionByName(hits)
    # Partial aggregates first: a document leaves a task with one row for each place of an item.
    places = written(found.groupBy("doc", "item", "shift").agg(F.count("*").alias("n")).drop("n"), "benchmark-places")

    by_doc = written(places.groupBy("doc").agg(F.collect_list(F.struct("item", "shift")).alias("places")), "benchmark-documents")
    rows = texts.join(small(by_doc, 64 + 24 * F.size("places")), texts["doc"].eqNullSafe(by_doc["doc"])).select(
        "doc_id", template_words(F.col("text")).alias("dwords"), raw_words(F.col("text")).alias("draw"),
        capital_words(F.col("text")).alias("dcapital"), "places",
    )
    # Of a document only the words beside each item go on.
    laid = rows.select("doc_id", "dwords", "draw", "dcapital", F.explode("places").alias("p")).select("doc_id", "dwords", "draw", "dcapital", "p.*")
    laid = laid.join(small(items.drop(*forms), _array_bytes("words", "raw", "capital")), "item")
    first = F.greatest(F.lit(0), -F.col("shift"))
    count = F.greatest(F.lit(0), F.least(F.size("words") - first, F.size("dwords") - F.col("shift") - first))
    laid = laid.where(count > 0).select(
        "doc_id", "item_id", "need",
        F.arrays_zip(
            F.slice("words", first + 1, count).alias("t"), F.slice("raw", first + 1, count).alias("i"),
            F.slice("dwords", first + F.col("shift") + 1, count).alias("dt"),
            F.slice("draw", first + F.col("shift") + 1, count).alias("d"),
            F.slice("capital", first + 1, count).alias("c"),
            F.slice("dcapital", first + F.col("shift") + 1, count).alias("dc"),
        ).alias("pairs"),
    )
    # Capitalised words, also at the start of a sentence, stand for each other as names do.
    agree = lambda p: (p["t"] == p["dt"]) | (p["i"] == p["d"]) | (p["c"] == p["dc"])
    laid = laid.where(_run(F.transform("pairs", agree))["length"] >= F.col("need"))
    slot = lambda p: _is_slot(p["t"]) | _is_slot(p["dt"]) | (p["i"] != p["d"])
    capital = lambda p: ~_is_slot(p["t"]) & ~_is_slot(p["dt"]) & (p["c"] == NAME) & (p["dc"] == NAME)
    laid = laid.withColumn("pairs", F.transform("pairs", lambda p, at: F.struct(
        at.alias("at"), p["i"].alias("i"), p["d"].alias("d"), agree(p).alias("agree"), slot(p).alias("slot"), capital(p).alias("capital"),
        ((p["i"] != p["d"]) | (p["t"] == NUMBER) | (p["dt"] == NUMBER) | ((p["t"] == NAME) & (p["dt"] == NAME))).alias("counted"),
        F.when(_is_slot(p["t"]), p["t"]).when(_is_slot(p["dt"]), p["dt"]).otherwise(p["c"]).alias("kind"),
    )))
    laid = laid.select("doc_id", "item_id", "need", "pairs", F.explode(_stretches(F.col("pairs"), F.col("need"))).alias("whole"))
    laid = laid.withColumn("run", F.slice("pairs", F.col("whole.start") + 1, F.col("whole.length")))
    laid = _plain_enough(laid).where("best IS NOT NULL")
    laid = laid.withColumn("run", F.slice("run", F.col("best.start") + 1, F.col("best.length")))
    laid = laid.withColumn("slots", F.filter("run", lambda p: p["counted"]))
    return laid.groupBy("doc_id", "item_id").agg(
        F.max(F.col("best.length").cast("long")).alias("run_words"),
        F.max_by(F.size("slots").cast("long"), F.struct("best.length", F.size("slots"))).alias("n_slots"),
        F.max(~F.exists("slots", lambda p: p["i"] != p["d"])).alias("same_slots"),
    )
