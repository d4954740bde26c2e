"""The numbered queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from bankmart.llm.columns import table
from bankmart.llm.line_dedup import line_dedup
from bankmart.llm import chat, decontaminate, divergence, html_text, language, license_scan, neighbours, periodic, secret_scan, warc
from bankmart.llm.near_dedup import near_dedup
from bankmart.llm.packing import pack
from bankmart.store import shared_folder


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", marked), (-1, 1, "assistant", marked)], "conv_id long, turn long, role string, text string")
    chats = chat.format_chats(table(spark, sf_dir, "conversations").select(extra.columns).union(extra))
    turns = chat.parse(F.col("formatted"))
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(chat.loss_texts(F.col("formatted"), F.col("loss_spans")), "")
    return chats.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secret_scan.as_text(base), 256).alias("base_sha256"), secret_scan.as_text(F.col("spans")).alias("spans"),
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.licenses(table(spark, sf_dir, "documents"))
    found = found.withColumn("base", F.filter("found", lambda f: f["base"]))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda f: f["label"]))), ",")
    starts = F.transform("base", lambda f: f["start"].cast("long"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels("base").alias("base_labels"), labels("found").alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["share"])), F.lit(0.0)).alias("score"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.declared_pages(warc.captures(warc.read_warc(spark, path)))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def _repeating(docs: DataFrame) -> DataFrame:
    """Every tenth document by a hash of its id, its words from one place on repeating with a period that follows from the hash."""
    hashed = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    split = hashed.withColumn("words", F.when(F.expr("h % 10 = 0"), F.expr(r"regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0)")))
    n = split.withColumn("n", F.size("words")).withColumn("a", F.expr("CASE WHEN n > 0 THEN int(h div 10 % n) END"))
    p = n.withColumn("p", F.expr("int(1 + (n - a) div (3 + h div 10 % 8))"))
    changed = "array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), 12)), 1, n - a)), ' ')"
    return p.select("doc_id", F.expr(f"CASE WHEN a IS NOT NULL THEN {changed} ELSE text END AS text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_repeating(table(spark, sf_dir, "documents")))
    longest = found.withColumn("best", F.expr("array_min(transform(runs, r -> struct(-r.length AS below, r.start AS start, r.period AS period)))"))
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", (-F.col("best.below")).alias("length"), "best.period",
        F.expr("-1000 * best.below div best.period").alias("exponent_milli"),
        F.expr("sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), ''), 256)").alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = {f.__name__: f for f in (
        op1_line_dedup, op2_near_dedup, op3_neighbours, op4_chat, op5_secrets, op6_licenses, op7_decontaminate, op8_packing, op9_warc, op10_language,
        op11_html_text, op12_source_divergence, op13_periodic_runs,
    )}
    return numbered | {"pipeline": corpus_pipeline.run}


LINE_DEDUP_SQL = r"""
WITH docs AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                     generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
              FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM docs),
firsts AS (SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
           GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id <> f.first_id, false) AS gone
           FROM keyed k LEFT JOIN firsts f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


NEIGHBOURS_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

CHAT_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, regexp_matches(text, '<</SYS>>|\[/INST\]|</s>|<</TURN>>|<s>|<<SYS>>|\[INST\]|<<TURN |\\[lgbe]') AS marked,
             CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 ELSE 18 + length(role) END AS marks
      FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(marks + length(text) + CASE WHEN marked THEN length(text) - length(translate(text, '<>[\\', '')) ELSE 0 END))::BIGINT
           AS formatted_chars
FROM m GROUP BY conv_id
"""


SECRETS_SQL = r"""
WITH rules(place, kind, least, pattern) AS (VALUES
  (0, 'assign', 12, '((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))'),
  (1, 'access', 18, '((AKIA[A-Z0-9]+))'),
  (2, 'hex', 16, '(([0-9a-f]+))'),
  (3, 'github', 1, '((gh[pousr]_[A-Za-z0-9]{36,}))'),
  (4, 'slack', 1, '((xox[baprs]-[A-Za-z0-9-]{10,}))'),
  (5, 'private_key', 1, '((-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----))'),
  (6, 'jwt', 1, '((eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}))')),
docs AS (SELECT doc_id, row_number() OVER () AS n, coalesce(text, '') AS text FROM documents),
parts AS (SELECT doc_id, n, place, kind, least,
                 regexp_extract_all(text, '(?s)(.*?)(?:' || pattern || '|\z)', 1) AS before,
                 regexp_extract_all(text, '(?s)(.*?)(?:' || pattern || '|\z)', 2) AS match,
                 regexp_extract_all(text, '(?s)(.*?)(?:' || pattern || '|\z)', 3) AS value
          FROM docs, rules),
pieces AS (SELECT doc_id, n, place, kind, least, unnest(before) AS before, unnest(match) AS match, unnest(value) AS value,
                  unnest(range(len(before))) AS i FROM parts),
placed AS (SELECT *, sum(length(before) + length(match)) OVER (PARTITION BY n, place ORDER BY i) AS stop FROM pieces),
spans AS (SELECT n, place, kind, (stop - length(match))::BIGINT AS start, kind || ':' || (stop - length(match))::BIGINT || ':' || stop::BIGINT AS span
          FROM placed WHERE length(value) >= least)
SELECT doc_id, count(span) FILTER (kind = 'assign') AS n_assign, count(span) FILTER (kind = 'access') AS n_access,
       count(span) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (place < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, place), '') AS spans
FROM docs LEFT JOIN spans USING (n) GROUP BY n, doc_id
"""

LICENSES_SQL = r"""
WITH texts(label, base, least, text, key_text) AS (VALUES
  ('mit', true, 1.0, 'under the mit license', 'under the mit license'),
  ('apache-2', true, 1.0, 'apache license version 2', 'apache license version 2'),
  ('cc-by-nc', true, 1.0, 'cc by nc', 'cc by nc'),
  ('mit', false, 0.75, 'permission is hereby granted free of charge to any person obtaining a copy of this software', 'hereby granted'),
  ('mit', false, 0.75, 'the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software', 'copyright notice and this permission notice'),
  ('isc', false, 0.75, 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted', 'with or without fee is hereby granted'),
  ('bsd', false, 0.75, 'redistribution and use in source and binary forms with or without modification are permitted', 'source and binary forms'),
  ('bsd', false, 0.75, 'redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer', 'redistributions in binary form must reproduce'),
  ('bsd', false, 0.75, 'neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software', 'endorse or promote products derived'),
  ('apache-2', false, 0.75, 'licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license', 'except in compliance with the license'),
  ('apache-2', false, 0.75, 'unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis', 'required by applicable law or agreed to in writing'),
  ('gpl', false, 0.75, 'licensed under the gnu general public license version 3', 'general public license'),
  ('gpl', false, 0.75, 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation', 'gnu general public license as published by'),
  ('gpl', false, 0.75, 'you should have received a copy of the gnu general public license along with this program', 'copy of the gnu general public license'),
  ('lgpl', false, 0.75, 'licensed under the gnu lesser general public license', 'gnu lesser general public license'),
  ('lgpl', false, 0.75, 'this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation', 'gnu lesser general public license as published by'),
  ('agpl', false, 0.75, 'licensed under the gnu affero general public license', 'gnu affero general public license'),
  ('agpl', false, 0.75, 'this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation', 'gnu affero general public license as published by'),
  ('mpl-2', false, 0.75, 'this source code form is subject to the terms of the mozilla public license v 2 0', 'mozilla public license'),
  ('mpl-2', false, 0.75, 'if a copy of the mpl was not distributed with this file you can obtain one at', 'copy of the mpl was not distributed'),
  ('epl', false, 0.75, 'this program and the accompanying materials are made available under the terms of the eclipse public license', 'eclipse public license'),
  ('unlicense', false, 0.75, 'this is free and unencumbered software released into the public domain', 'unencumbered software released into the public domain'),
  ('zlib', false, 0.75, 'in no event will the authors be held liable for any damages arising from the use of this software', 'will the authors be held liable'),
  ('bsl-1', false, 0.75, 'permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license', 'person or organization obtaining a copy'),
  ('cc0', false, 0.75, 'the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work', 'waived all copyright and related or neighboring rights'),
  ('cc-by', false, 0.75, 'this work is licensed under a creative commons attribution 4 0 international license', 'creative commons attribution 4 0'),
  ('cc-by-sa', false, 0.75, 'this work is licensed under a creative commons attribution sharealike 4 0 international license', 'creative commons attribution sharealike'),
  ('cc-by-nc', false, 0.75, 'this work is licensed under a creative commons attribution noncommercial 4 0 international license', 'creative commons attribution noncommercial 4 0'),
  ('ofl', false, 0.75, 'this font software is licensed under the sil open font license version 1 1', 'sil open font license')),
split AS (SELECT label, base, least, string_split(text, ' ') AS words, string_split(key_text, ' ') AS key FROM texts),
templates AS (SELECT *, list_filter(range(len(words)), lambda i: words[i + 1 : i + len(key)] = key)[1] AS place FROM split),
docs AS (SELECT doc_id, row_number() OVER () AS n,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS own FROM documents),
places AS (SELECT n, own, label, base, least, words, unnest(range(len(own))) - place AS start
           FROM docs, templates WHERE list_has_all(own, key)),
keyed AS (SELECT places.* FROM places JOIN templates t USING (words)
          WHERE start >= 0 AND own[start + t.place + 1 : start + t.place + len(t.key)] = t.key),
found AS (SELECT *, len(list_filter(range(1, len(words) + 1), lambda k: own[start + k] = words[k])) / len(words) AS share FROM keyed),
good AS (SELECT * FROM found WHERE share >= least)
SELECT doc_id, len(any_value(d.own)) AS n_words, count(label) FILTER (base) AS n_base,
       (min(start) FILTER (base))::BIGINT AS first_word, (max(start) FILTER (base))::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0)::DOUBLE AS score
FROM docs d LEFT JOIN good USING (n) GROUP BY n, doc_id
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex FROM p),
m AS (SELECT hex, max(page_id) AS of_id FROM h GROUP BY hex)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> ((3 - i % 4) * 5)) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id <> of_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> of_id THEN of_id END AS refers_to
FROM h JOIN m USING (hex)
"""


DIVERGENCE_SQL = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, coalesce(sum(total), 0) AS lang_n, count(term) AS v FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
sizes AS MATERIALIZED (
  SELECT lang, source, coalesce(sum(n), 0) AS group_n FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
cells AS MATERIALIZED (
  SELECT lang, source, term, n, total, lang_n, v, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (group_n + v)::HUGEINT AS p
  FROM sizes JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
          FROM cells x JOIN cells y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
all_pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
              FROM sizes x JOIN sizes y ON x.lang = y.lang AND x.source <> y.source
              LEFT JOIN pairs ON pairs.lang = x.lang AND pairs.source = x.source AND pairs.item = y.source),
own AS (SELECT lang, source, term, p, 1 + 1000000000::HUGEINT * (total + 1) // (lang_n + v)::HUGEINT AS q FROM cells WHERE n > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
           FROM (FROM all_pairs UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM own WHERE p > q))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

PERIODIC_SQL = r"""
WITH crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, s: xor(c >> 1, (c & 1) * 3988292384))) AS steps),
docs AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
                                     lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1]))) AS h
  FROM documents, crc),
placed AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % len(w) AS a FROM docs),
words AS MATERIALIZED (
  SELECT doc, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM placed)),
matches AS (SELECT y.doc, y.i, y.i - x.i AS q, y.i - row_number() OVER (PARTITION BY y.doc, y.i - x.i ORDER BY y.i) AS island
            FROM words x JOIN words y ON x.doc = y.doc AND x.word = y.word AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (SELECT doc, q, min(i) - q AS start, count(*) + q AS length FROM matches GROUP BY doc, q, island),
long AS (SELECT * FROM stretches WHERE length >= greatest(6, 4 * q)),
runs AS MATERIALIZED (
  SELECT * FROM long r WHERE NOT EXISTS (
    SELECT 1 FROM long s WHERE s.doc = r.doc AND s.q < r.q AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
best AS (SELECT doc, count(*) AS n_runs, min((-length, start, q)) AS b,
                string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed FROM runs GROUP BY doc),
kept AS (SELECT doc, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words w
         WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc = w.doc AND w.i >= r.start + r.q AND w.i < r.start + r.length) GROUP BY doc)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b[2] AS start, -b[1] AS length, b[3] AS period, -1000 * b[1] // b[3] AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (doc) LEFT JOIN kept USING (doc)
"""


def oracle_sql() -> dict[str, str]:
    """What SQL cannot express has no entry: near copies, reparameterised items, token ids, the trained classifier, page texts."""
    return {
        "op1_line_dedup": LINE_DEDUP_SQL,
        "op3_neighbours": NEIGHBOURS_SQL,
        "op4_chat": CHAT_SQL,
        "op5_secrets": SECRETS_SQL,
        "op6_licenses": LICENSES_SQL,
        "op9_warc": WARC_SQL,
        "op12_source_divergence": DIVERGENCE_SQL,
        "op13_periodic_runs": PERIODIC_SQL,
    } | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
