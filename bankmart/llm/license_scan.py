"""Find licence texts by an index of rare words and their positions.

A template is a sequence of words of which a share must stand in place, and a key phrase in full. The
document frequency of every template word is counted over all documents. The index lists, by word, the
templates and places of their rarest words: of each template one more than may be missing, so one at
least stands in place wherever the template does. Of a file, the words that the index has are looked up,
and the postings' places taken from their own: equal differences of one template are one place where it
may stand. There its words are compared and its key phrase must stand in full.

All of it is built-in functions on one row per document; the work goes with a file's words and its rare
ones' postings, not with the number of templates. Nothing but counts is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart.llm.columns import pick

# What stands between words, once A-Z are in lower case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A place in a file and the number of a template share a long: places take so many bits.
PLACE_BITS = 40


@dataclass(frozen=True)
class Template:
    """``key``: the part that must stand in full; ``share``: of all words, how many must stand in place."""

    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    share: float
    base: bool


def phrase(label: str, text: str) -> Template:
    words = tuple(text.split())
    return Template(label, words, words, 1.0, True)


def passage(label: str, text: str, key: str, share: float = 0.75) -> Template:
    return Template(label, tuple(text.split()), tuple(key.split()), share, False)


# The three base phrases, then notices and opening clauses of common licences with the phrase that tells them.
TEMPLATES = (
    phrase("mit", "under the mit license"),
    phrase("apache-2", "apache license version 2"),
    phrase("cc-by-nc", "cc by nc"),
    passage("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted"),
    passage("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
            "copyright notice and this permission notice"),
    passage("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
            "with or without fee is hereby granted"),
    passage("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    passage("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer",
            "redistributions in binary form must reproduce"),
    passage("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
            "endorse or promote products derived"),
    passage("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
            "except in compliance with the license"),
    passage("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
            "required by applicable law or agreed to in writing"),
    passage("gpl", "licensed under the gnu general public license version 3", "general public license"),
    passage("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
            "gnu general public license as published by"),
    passage("gpl", "you should have received a copy of the gnu general public license along with this program", "copy of the gnu general public license"),
    passage("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    passage("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
            "gnu lesser general public license as published by"),
    passage("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    passage("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
            "gnu affero general public license as published by"),
    passage("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    passage("mpl-2", "if a copy of the mpl was not distributed with this file you can obtain one at", "copy of the mpl was not distributed"),
    passage("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    passage("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    passage("zlib", "in no event will the authors be held liable for any damages arising from the use of this software", "will the authors be held liable"),
    passage("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
            "person or organization obtaining a copy"),
    passage("cc0", "the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work",
            "waived all copyright and related or neighboring rights"),
    passage("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    passage("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    passage("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial 4 0"),
    passage("ofl", "this font software is licensed under the sil open font license version 1 1", "sil open font license"),
)


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    # Of characters outside ASCII, the Kelvin sign alone has an ASCII letter for its lower case.
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))
    return F.array_remove(F.split(low, GAP), "")


def _array(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def idf(docs: DataFrame, words: list[str]) -> dict[str, float]:
    """Inverse document frequency of the given words over all of ``docs`` (column ``text``)."""
    held = docs.select(F.explode(F.array_intersect(words_of(F.col("text")), _array(words))).alias("word"))
    counts = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}
    total = docs.count()
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in words}


def _key_place(template: Template) -> int:
    n = len(template.key)
    return next(i for i in range(len(template.words)) if template.words[i : i + n] == template.key)


def index(templates: tuple[Template, ...], weights: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """Postings by word: numbers of templates and places in them, for each template's words of highest ``weights``.

    Of a template as many words as may be out of place and one more, so that one of them is in place.
    """
    postings: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        n = len(template.words)
        missing = n - math.ceil(template.share * n - 1e-9)
        for place in sorted(range(n), key=lambda k: (-weights[template.words[k]], k))[: missing + 1]:
            postings.setdefault(template.words[place], []).append((number, place))
    return postings


def _candidates(words: Column, postings: dict[str, list[tuple[int, int]]]) -> Column:
    """Templates and the places where they may begin, each once, as one long."""
    hits = F.filter(
        F.transform(words, lambda w, i: F.when(w.isin(*postings), F.struct(w.alias("word"), i.alias("at")))), lambda h: h.isNotNull()
    )
    entry = lambda number, place: F.struct(F.lit(number).cast("long").alias("number"), F.lit(place).alias("place"))
    listed = F.create_map(*[x for word, own in sorted(postings.items()) for x in (F.lit(word), F.array(*[entry(*p) for p in own]))])
    starts = F.flatten(F.transform(hits, lambda h: F.transform(
        F.try_element_at(listed, h["word"]),
        lambda p: F.when(h["at"] >= p["place"], F.shiftleft(p["number"], PLACE_BITS) + h["at"] - p["place"]),
    )))
    return F.array_distinct(F.array_compact(starts))


def _verified(words: Column, candidates: Column, templates: tuple[Template, ...]) -> Column:
    """Start, label, base and share of words in place, for each candidate that holds its key phrase and enough words."""
    listed = F.array(*[
        F.struct(
            _array(t.words).alias("words"), _array(t.key).alias("key"), F.lit(_key_place(t)).alias("place"),
            F.lit(t.share).alias("least"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
        )
        for t in templates
    ])

    def placed(code: Column) -> Column:
        start = code.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
        return F.struct(start.alias("start"), F.get(listed, F.shiftright(code, PLACE_BITS).cast("int")).alias("t"))

    def compared(c: Column) -> Column:
        own = F.slice(words, c["start"] + 1, F.size(c["t"]["words"]))
        same = F.zip_with(own, c["t"]["words"], lambda a, b: F.when(F.coalesce(a == b, F.lit(False)), 1))
        share = F.size(F.array_compact(same)) / F.size(c["t"]["words"])
        whole = F.slice(words, c["start"] + c["t"]["place"] + 1, F.size(c["t"]["key"])) == c["t"]["key"]
        found = F.struct(c["start"].alias("start"), c["t"]["label"].alias("label"), c["t"]["base"].alias("base"), share.alias("share"))
        return F.when(whole & (share >= c["t"]["least"]), found)

    return F.array_compact(F.transform(F.transform(candidates, placed), compared))


def licenses(docs: DataFrame, *, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``doc_id``, ``n_words`` and ``found``, an array of ``start``, ``label``, ``base``, ``share`` by start.

    ``start`` counts words from 0. Every row of ``docs`` gives one, a null or empty text with no
    word. Rows that repeat an id or have none are searched each for itself. Other columns are
    ignored. Places may overlap. A template begins within the text; its rarest words count.
    """
    texts = pick(docs, "doc_id", "text")
    vocabulary = sorted({w for t in templates for w in t.words})
    postings = index(templates, idf(texts, vocabulary))
    rows = texts.select("doc_id", words_of(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "words", _candidates(F.col("words"), postings).alias("candidates"))
    found = _verified(F.col("words"), F.col("candidates"), templates)
    return rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.array_sort(found).alias("found"))
