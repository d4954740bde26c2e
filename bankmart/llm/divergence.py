"""How far the word frequencies of each source lie from those of the other sources of its language.

The counts of a group over its language's terms are the leaves of a segment tree over term ids. Trees
are hash-consed: subtrees with equal counts are one node, whichever group and place they stand in. Two
groups are compared by walking both trees from their roots at once; equal pairs of nodes met on one
level are merged and only their number kept, so that each is looked into, and each pair of counts
priced, once. As a term rarely stands in a small source, most of a pair's walk ends up in few nodes.

Terms are dealt by hash to blocks of about ``block`` and sources to tiles of ``tile``. A task holds one block
of two tiles, whose prices add up to the whole, so neither a vocabulary nor a language is ever in one place.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.columns import pick
from bankmart.llm.joins import small
from bankmart.llm.memory import tidy
from bankmart.llm.shipping import ship
from bankmart.store import written

ENTRIES = 400_000
PIECE = 1 << 22
UNIT = 10**9

# Letters of ASCII in lower case and all bytes beyond ASCII stay, the rest parts terms.
LETTERS = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, of a very long one in several lists."""
    text, start = text.translate(LETTERS), 0
    while start < len(text):
        end = len(text) if len(text) - start <= PIECE else text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


@tidy
def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each term, and documents with it, by language and source, of the rows since the last output."""
    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            terms = list(times)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                 pa.array(terms, pa.binary()).cast(pa.string()), pa.array(times.values(), pa.int64()),
                 pa.array([docs[t] for t in terms], pa.int64())],
                names=["lang", "source", "term", "n", "docs"],
            )

    held: dict[tuple, tuple[Counter, Counter]] = {}
    for batch in batches:
        for text, *group in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            times, docs = held.setdefault(tuple(group), (Counter(), Counter()))
            own: set[bytes] = set()
            for terms in _pieces(text.as_py()):
                times.update(terms)
                own.update(terms)
            docs.update(own)
            if sum(len(t) for t, _ in held.values()) > ENTRIES:
                yield from rows()
                held.clear()
    yield from rows()


def trees(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Hash-consed trees over the rows of ``counts``, whose width is a power of two.

    The distinct counts (leaves), for each level from the root down the children of its nodes, and each row's root.
    """
    leaves, nodes = np.unique(counts, return_inverse=True)
    nodes, levels, size = nodes.reshape(counts.shape), [], leaves.size
    while nodes.shape[1] > 1:
        made, parents = np.unique(nodes[:, ::2] * np.int64(size) + nodes[:, 1::2], return_inverse=True)
        levels.append((made // size, made % size))
        nodes, size = parents.reshape(nodes.shape[0], -1), made.size
    return leaves, levels[::-1], nodes[:, 0]


def leaf_pairs(levels: list, root: int, roots: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs of leaves at the same place of one tree and each of several others: which other, both leaves, how often."""
    other, left, right, times = np.arange(roots.size), np.full(roots.size, root), roots, np.ones(roots.size, np.int64)
    for low, high in levels:
        size = np.int64(max(low.max(), high.max()) + 1)
        key = (np.r_[other, other] * size + np.r_[low[left], high[left]]) * size + np.r_[low[right], high[right]]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        times = np.add.reduceat(np.r_[times, times][order], first)
        key = key[first]
        other, left, right = key // (size * size), key // size % size, key % size
    return other, left, right, times


def shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / whole), exactly."""
    if counts.size and int(counts.max()) >= 2**63 // UNIT - 1:
        return np.array([1 + UNIT * (int(c) + 1) // whole for c in counts], np.int64)
    return 1 + UNIT * (counts.astype(np.int64) + 1) // whole


def _priced(rows: pd.DataFrame, tile: int) -> pd.DataFrame:
    """The part of all values between the sources of two tiles that one block of terms makes."""
    marks, cells = rows[rows["n"] == 0].sort_values("place"), rows[rows["n"] > 0]
    places, wholes = marks["place"].to_numpy(), [int(w) for w in marks["whole"]]
    terms = int(marks["term"].iloc[0]) - 1  # Marks are numbered after the terms of their block.
    counts = np.zeros((places.size, 1 << max(terms - 1, 0).bit_length()), np.int64)
    counts[np.searchsorted(places, cells["place"]), cells["term"] - 1] = cells["n"]
    counts[:, terms:] = -1  # No terms stand here: a leaf of its own, which costs nothing.
    leaves, levels, roots = trees(counts)
    table = np.stack([shares(np.maximum(leaves, 0), w) for w in wholes])
    first, second = int(rows["first"].iloc[0]), int(rows["second"].iloc[0])
    out = [pd.DataFrame({n: np.empty(0, np.int64) for n in ("own", "its", "value")})]
    for i in np.flatnonzero(places // tile == first):
        others = np.flatnonzero((places > places[i]) & (places // tile == second))
        if others.size:
            other, left, right, times = leaf_pairs(levels, roots[i], roots[others])
            p, q, times = table[i][left], table[others[other], right], times * (leaves[left] >= 0)
            square, cuts = (p - q) ** 2, np.flatnonzero(np.r_[True, np.diff(other) != 0])
            here, there = np.full(others.size, places[i]), places[others]
            for own, its, price in ((here, there, square // q), (there, here, square // p)):
                out.append(pd.DataFrame({"own": own, "its": its, "value": np.add.reduceat(price * times, cuts)}))
    return pd.concat(out).assign(lang=rows["lang"].iloc[0])[["lang", "own", "its", "value"]]


def _share(count: str, whole: str) -> str:
    return f"1 + (cast({UNIT} AS decimal(12, 0)) * cast({count} + 1 AS decimal(20, 0))) div cast({whole} AS decimal(20, 0))"


def group_terms(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Counts of kept terms by language and source, and the size of every group. Both written.

    One shuffle of counts by language and term serves the sums, the choice of terms and a language's own counts.
    """
    texts = pick(docs, "text", "lang", "source").na.fill("", ["text", "lang", "source"])
    counted = texts.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    term = Window.partitionBy("lang", "term")
    sums = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = written(
        sums.withColumn("in_docs", F.sum("docs").over(term)).withColumn("total", F.sum("n").over(term))
        .withColumn("nth", F.row_number().over(term.orderBy("source")))
        .where(F.col("in_docs") >= least).select("lang", "source", "term", "n", "total", (F.col("nth") == 1).alias("first")),
        "kept-terms",
    )
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("terms"))
    every = texts.select("lang", "source").distinct().join(by_group, ["lang", "source"], "left").na.fill(0, ["n", "terms"])
    lang = Window.partitionBy("lang")
    sizes = every.select(
        "lang", "source", F.col("n").alias("group_n"), F.sum("n").over(lang).alias("lang_n"), F.sum("terms").over(lang).alias("v"),
        F.count(F.lit(1)).over(lang).alias("sources"), (F.row_number().over(lang.orderBy("source")) - 1).alias("place"),
    )
    return kept, written(sizes, "group-sizes")


def _named_bytes(sizes: DataFrame) -> int:
    """Bytes of the widest row of group sizes."""
    return (sizes.agg(F.max(F.octet_length("lang") + F.octet_length("source"))).first()[0] or 0) + 64


def source_values(kept: DataFrame, sizes: DataFrame, block: int, tile: int) -> DataFrame:
    """``lang``, ``source``, ``item`` (each other source of the language), ``value``."""
    groups = small(sizes.select("lang", "source", "group_n", "v", "place", "sources"), _named_bytes(sizes))
    blocks = f"greatest(1, cast(ceil(v / {block}) AS bigint))"
    # Each source stands once in every block of its language, with no term, to be known there.
    marks = sizes.select(
        "lang", F.explode(F.expr(f"sequence(0, {blocks} - 1)")).alias("block"), "place",
        (F.col("group_n") + F.col("v")).alias("whole"), "sources", F.lit(None).cast("string").alias("term"), F.lit(-1).cast("long").alias("total"), F.lit(0).cast("long").alias("n"),
    )
    cells = kept.join(groups, ["lang", "source"]).select(
        "lang", F.expr(f"pmod(xxhash64(term), {blocks})").alias("block"), "place",
        (F.col("group_n") + F.col("v")).alias("whole"), "sources", "term", "total", "n",
    )
    # Terms that are frequent in the language come first, so that subtrees far right are mostly empty.
    order = Window.partitionBy("lang", "block").orderBy(F.desc("total"), F.col("term").asc_nulls_last())
    placed = marks.unionByName(cells).withColumn("term", F.dense_rank().over(order)).drop("total")
    dealt = placed.withColumn("own", F.expr(f"int(place div {tile})")).withColumn("other", F.explode(F.expr(f"sequence(0, int((sources - 1) div {tile}))")))
    dealt = dealt.select("lang", "block", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "place", "whole", "term", "n")
    parts = dealt.groupBy("lang", "block", "first", "second").applyInPandas(lambda rows: _priced(rows, tile), "lang string, own int, its int, value long")
    sums = parts.groupBy("lang", "own", "its").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "place", "source")
    return (
        sums.join(names.toDF("lang", "own", "source"), ["lang", "own"]).join(names.toDF("lang", "its", "item"), ["lang", "its"])
        .select("lang", "source", "item", "value")
    )


def term_values(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` (each term more frequent in the source than in the language), ``value``."""
    joined = kept.join(small(sizes, _named_bytes(sizes)), ["lang", "source"])
    shares = joined.select(
        "lang", "source", F.col("term").alias("item"),
        F.expr(_share("n", "group_n + v")).alias("p"), F.expr(_share("total", "lang_n + v")).alias("q"),
    )
    return shares.where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))


def audit(docs: DataFrame, *, least: int = 3, top: int = 200, block: int = 1 << 13, tile: int = 32) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``, from the ``text``, ``lang`` and ``source`` of ``docs``.

    Terms are runs of letters (ASCII, in lower case, and every code point beyond it); a language keeps
    those of at least ``least`` of its rows. A share is p = 1 + floor(10^9 (count + 1) / (N + V)), a price
    floor((p - q)^2 / q). ``pair`` rows hold the summed price of a source against each other one of its
    language, ``term`` rows the ``top`` terms by price that it has more of than its language. Ranks go by
    value, then by item. Nulls are empty texts. Rows that repeat count each time, ids play no part.
    A group without terms has share 1 + floor(10^9 / V) everywhere; where a language keeps no term,
    pairs cost 0. Other columns are ignored. No rows: no rows. Integers throughout, so results are exact.
    """
    ship(docs.sparkSession)
    kept, sizes = group_terms(docs, least)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_values(kept, sizes, block, tile).withColumn("rank", F.row_number().over(order))
    terms = term_values(kept, sizes).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).union(terms.withColumn("part", F.lit("term")).select(columns))
