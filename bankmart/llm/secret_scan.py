"""Find secrets by regular expressions, through an inverted index of trigrams.

From each expression a Boolean query is derived: sets of trigrams, one of which a text must
hold in full if the expression is to match. The index holds postings of these trigrams alone.
Intersecting them gives each rule's candidate documents, and only those are searched by the
expression. A rule without mandatory trigrams searches every document.

All of it is built-in functions. The postings, not the texts, are shuffled; the candidates
are looked up from the scan while they are few, and joined by a shuffle beyond.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart.llm.columns import pick
from bankmart.llm.joins import small
from bankmart.store import written

MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A match counts if ``group`` of it has ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


# Runs that a longer minimum inside the expression finds at the same places have it there:
# a run that is too short has no long one within.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def _strings(parsed) -> tuple[set[str] | None, list[set[str]]]:
    """All strings a parsed expression can match, if few, and the sets of which some string is a part of any match."""
    runs: list[set[str]] = []
    current: set[str] | None = {""}
    whole = True

    def cut() -> None:
        nonlocal current, whole
        runs.append(current)
        current, whole = {""}, False

    for op, value in parsed:
        name, own, inner = str(op), None, []
        if name == "LITERAL":
            own = {chr(value)}
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
            own = {chr(v) for _, v in value}
        elif name == "SUBPATTERN":
            own, inner = _strings(value[-1])
        elif name == "BRANCH":
            found = [_strings(b) for b in value[1]]
            own = set().union(*(f[0] for f in found)) if all(f[0] is not None for f in found) else None
        elif name == "MAX_REPEAT":
            least, most, part = value
            once, inner = _strings(part)
            inner = inner if least else []
            if once is not None and (least, most) == (0, 1):
                own = once | {""}
            elif once is not None and least == most and len(once) ** least <= MOST_STRINGS:
                own = {"".join(p) for p in product(once, repeat=least)}
        runs += inner
        if own is None or len(current) * len(own) > MOST_STRINGS:
            cut()
            if own is not None:
                current = own
        else:
            current = {a + b for a in current for b in own}
    runs.append(current)
    return (current if whole else None), runs


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Sets of lower-case trigrams of which any matching text holds at least one in full; none if no trigram is mandatory."""
    _, runs = _strings(re._parser.parse(pattern))
    best: list[frozenset[str]] = []
    for run in runs:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in (x.lower() for x in run)}
        if all(sets) and (not best or min(map(len, sets)) > min(map(len, best))):
            best = [s for s in sets if not any(o < s for o in sets)]
    return sorted(best, key=sorted)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram`` and ``doc``: the documents that hold each, letters in either case."""
    lowered = docs.select("doc", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return lowered.select("doc", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``doc`` and ``rules``, a bit per rule whose query the document's postings satisfy."""
    spark = docs.sparkSession
    clauses = [(number, at, t, len(c)) for at, (number, c) in enumerate(
        (n, c) for n, rule in enumerate(rules) for c in trigram_query(rule.pattern)) for t in sorted(c)]
    wanted = spark.createDataFrame(clauses, "rule int, clause int, trigram string, size int")
    found = postings(docs, sorted({t for _, _, t, _ in clauses})).join(F.broadcast(wanted), "trigram")
    # Rows that share an id add up, which can only let more of them be searched.
    met = found.groupBy("doc", "clause").agg(F.count("*").alias("n"), F.first("size").alias("size"), F.first("rule").alias("rule"))
    return met.where("n >= size").groupBy("doc").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules"))


def matches(text: Column, rule: Rule) -> Column:
    """Start and end of the matches, leftmost first and apart, that are long enough."""
    # Each step takes what stands before the next match and the match, or else the rest.
    flags, pattern = ("(?i)", rule.pattern[4:]) if rule.pattern.startswith("(?i)") else ("", rule.pattern)
    step = F.lit(rf"(?s)(.*?)(?:({flags}{pattern})|\z)")
    parts = F.arrays_zip(
        F.regexp_extract_all(text, step, F.lit(1)).alias("before"),
        F.regexp_extract_all(text, step, F.lit(2)).alias("match"),
        F.regexp_extract_all(text, step, F.lit(2 + rule.group)).alias("value"),
    )
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["before"])
        end = start + F.length(p["match"])
        kept = F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        spans = F.when(F.length(p["value"]) >= rule.least, kept).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    found = F.aggregate(parts, zero, add)["spans"]
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


def _labelled(spans: Column, order: int, rule: Rule) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")
    ))


def secrets(docs: DataFrame, *, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and ``spans``, an array of ``start``, ``order``, ``kind``, ``end``, by start and then rule.

    Positions count code points from 0, the end being exclusive; ``order`` is the rule's place.
    Every row of ``docs`` gives one, with no span if its text is null or empty. Rows that repeat
    an id or have none are searched each for itself. Other columns are ignored.
    """
    texts = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc"))
    stored = written(candidates(texts.select("doc", "text"), rules), "secret-candidates")
    rows = texts.join(small(stored, 16), "doc", "left")
    spans = []
    for n, rule in enumerate(rules):
        found = matches(F.col("text"), rule)
        if trigram_query(rule.pattern):
            chosen = F.coalesce(F.col("rules"), F.lit(0)).bitwiseAND(F.lit(1 << n)) != 0
            found = F.when(chosen, found).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))
        spans.append(_labelled(found, n, rule))
    return rows.select("doc_id", F.array_sort(F.concat(*spans)).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
