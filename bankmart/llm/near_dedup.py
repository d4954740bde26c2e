"""Near copies by weighted Jaccard similarity of word shingles, through BagMinHash.

A text is the bag of its five-word shingles. For every shingle and each dyadic interval of its
weights (0 to 1, 1 to 2, 2 to 4, 4 to 8, ...) a Poisson process of that length's rate, seeded by
the shingle, deals points to the registers; a point counts in bags whose weight reaches its
level. A register holds the time of its earliest point that counts, and two bags agree in a
register with a probability of exactly their weighted Jaccard similarity. Bands of registers
give candidates, and the overlap of the bags themselves confirms them.

Bags that are equal are one node from the start. In a bucket, nodes are not paired with each
other but with a hub, the one that shares most buckets. Where that leaves a bucket in several
components, the nodes outside the largest are held against all others of the bucket, block by
block on more registers, so no link between candidates is missed that would join two classes.
Links are joined to components by contraction in Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.llm.columns import pick
from bankmart.llm.joins import small
from bankmart.llm.memory import tidy
from bankmart.llm.shipping import ship
from bankmart.store import written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 25, 5
REGISTERS = BANDS * BAND_ROWS
# Candidates that agree in fewer registers, this many standard deviations below, are dropped: as few as the bands miss.
DEVIATIONS = 4
FINE = 1024
BLOCK = 512
ROWS = 128
WORD = re.compile(r"\w+")
KNOWN_WORDS = 300_000
STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def bag(text: str | None, known: _Hashes, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's shingles, in order, and how often each stands in it. Fewer words are one shingle.

    A text without a word is one shingle too, which only equal texts share.
    """
    words = WORD.findall((text or "").lower())
    if not words:
        return np.array([xxhash.xxh3_64_intdigest(f"\0{(text or '').strip()}")], np.uint64), np.ones(1, np.int64)
    if len(known) > KNOWN_WORDS:
        known.clear()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - shingle + 1)
    out = np.full(n, np.uint64(min(len(h), shingle)))
    for k in range(min(len(h), shingle)):
        out = _mix(out * STEP + h[k : k + n])
    return np.unique(out, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """The BagMinHash registers of bags that are not empty, one row each."""
    out = np.full((len(bags), registers), np.inf)
    todo, margin = np.arange(len(bags)), 4.0
    while len(todo):
        # Past this time no register is likely to be empty still. If one is, the bag is done again for longer.
        totals = np.array([bags[i][1].sum() for i in todo], float)
        until = (np.log(registers) + margin) / totals
        out[todo] = _registers([bags[i] for i in todo], until, registers)
        todo, margin = todo[np.isinf(out[todo]).any(axis=1)], margin * 2
    return out


def _registers(bags: list[tuple[np.ndarray, np.ndarray]], until: np.ndarray, registers: int) -> np.ndarray:
    """All points up to each bag's time, dealt to its registers."""
    out = np.full(len(bags) * registers, np.inf)
    owner = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    element, weight = np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags])
    level = 0
    while len(owner):
        # Weights above ``low``, up to twice that: the interval from 0 to 1 comes first.
        low, width = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
        reach = weight > low
        owner, element, weight = owner[reach], element[reach], weight[reach]
        state = _mix(element ^ _mix(np.full(1, level + 1, np.uint64) * STEP))
        time, own, most = np.zeros(len(owner)), owner, weight
        while len(own):
            state = state + STEP
            draw, where = _mix(state), _mix(state ^ np.uint64(0xD6E8FEB86659FD93))
            time = time - np.log(((draw >> np.uint64(11)).astype(float) + 1) / (1 << 53)) / (registers * width)
            early = time <= until[own]
            state, time, own, most, where = state[early], time[early], own[early], most[early], where[early]
            at = (where >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)
            reached = most > low + ((where & np.uint64(0xFFFFFFFF)) % np.uint64(width)).astype(np.int64)
            np.minimum.at(out, own[reached] * registers + at[reached].astype(np.int64), time[reached])
        level += 1
    return out.reshape(len(bags), registers)


@tidy
def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Hashes()
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            pairs = [(d, bag(t, known)) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
            marks = _mix(signatures([b for _, b in pairs]).view(np.uint64))
            keys = marks.reshape(len(pairs), BANDS, BAND_ROWS)
            band = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * STEP, (len(pairs), BANDS))
            for r in range(BAND_ROWS):
                band = _mix(band * STEP + keys[:, :, r])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d for d, _ in pairs], pa.int64()),
                    pa.array([blake2b(h.tobytes() + n.astype("<i8").tobytes(), digest_size=16).digest() for _, (h, n) in pairs], pa.binary()),
                    pa.array([row.tobytes() for row in marks.astype("<u4")], pa.binary()),
                    pa.array(list(band.view(np.int64)), pa.list_(pa.int64())),
                ],
                names=["doc", "digest", "signature", "bands"],
            )


@tidy
def _agreeing(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(n).to_pylist()), "<u4").reshape(batch.num_rows, -1) for n in (2, 3))
        keep = pa.array((a == b).sum(axis=1) >= least)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


@tidy
def _linked(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    known, last, held = _Hashes(), None, None
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            keep = []
            for ta, tb in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                if ta != last:
                    last, held = ta, bag(ta, known)
                keep.append(similarity(held, bag(tb, known)) >= least)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(0).filter(mask), part.column(1).filter(mask)], names=["a", "b"])


def _agreement(least: float, registers: int = REGISTERS) -> int:
    return int(registers * least - DEVIATIONS * (registers * least * (1 - least)) ** 0.5)


def verified(pairs: DataFrame, signs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Of the pairs ``a``, ``b`` those whose bags are as similar as asked."""
    by = lambda df, side, *cols: df.select(F.col("doc").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in cols])
    close = (
        pairs.join(by(signs, "b", "signature"), "b").join(by(signs, "a", "signature"), "a")
        .select("a", "b", "signature_a", "signature_b")
        .mapInArrow(partial(_agreeing, least=_agreement(least)), "a long, b long").distinct()
    )
    found = close.join(by(texts, "b", "text"), "b").join(by(texts, "a", "text"), "a").select("a", "b", "text_a", "text_b")
    return found.mapInArrow(partial(_linked, least=least), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``comp``, its component's smallest node, for every node of the links ``a``, ``b``."""
    comp = written(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("comp", F.col("node")), "components")
    edges = links
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")), "parents")
        over = parent.select(F.col("a").alias("up"), F.col("up").alias("top"))
        # A parent's parent is at hand in the same table.
        root = written(parent.join(over, "up").select("a", "top"), "roots")
        comp = written(
            comp.join(root.toDF("comp", "top"), "comp", "left").select("node", F.coalesce("top", "comp").alias("comp")), "components"
        )
        ends = edges.join(root.toDF("a", "ra"), "a").join(root.toDF("b", "rb"), "b")
        edges = written(ends.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    return comp


def _pairs(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _placed(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members of buckets that lie in several components, with their own and the bucket's largest one, ``main``."""
    comp = components(links)
    placed = members.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    by_comp = placed.groupBy("key", "comp").agg(F.count("*").alias("n"))
    mixed = by_comp.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("comps"), F.sum("n").alias("n"))
    # Of two members the hub was one: the pair has been tried.
    mixed = written(mixed.where("comps > 1 AND n > 2").drop("comps"), "mixed-buckets")
    return written(placed.join(mixed, "key"), "open-buckets")


@tidy
def _tile(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a block of outer nodes and one of members that agree in enough registers and lie in different components."""
    for batch in batches:
        for i in range(batch.num_rows):
            (x, cx, sx), (y, cy, sy) = (
                (np.array(batch.column(n)[i].as_py()), np.array(batch.column(n + 1)[i].as_py()),
                 np.frombuffer(b"".join(batch.column(n + 2)[i].as_py()), np.uint8).reshape(-1, FINE))
                for n in (0, 3)
            )
            for at in range(0, len(x), 8):
                own = slice(at, at + 8)
                same = (sx[own, None, :] == sy[None, :, :]).sum(axis=2)
                r, c = np.nonzero((same >= least) & (cx[own, None] != cy[None, :]))
                a, b = x[own][r], y[c]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])


@tidy
def _fine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A byte of each of many more registers."""
    known = _Hashes()
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            marks = _mix(signatures([bag(t, known) for t in part.column(1).to_pylist()], FINE).view(np.uint64))
            rows = pa.array([row.tobytes() for row in marks.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), rows], names=["doc", "signature"])


def _across(open_: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """All pairs of the open buckets with a node outside the largest component that lie apart and seem similar enough.

    Buckets are cut into blocks of about ``BLOCK`` nodes, and each pair of blocks is compared as
    two matrices of registers: of their nodes ``FINE`` registers are computed, which tell pairs
    just below the wanted similarity from those above. Pairs are rows only once they agree.
    """
    nodes = written(open_.select(F.col("node").alias("doc")).distinct(), "open-nodes")
    signs = texts.join(small(nodes, 16), "doc").select("doc", "text").mapInArrow(_fine, "doc long, signature binary")
    signs = written(signs, "fine-signatures")
    number = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).alias("block")
    rows = open_.select("key", "node", "comp", "main", number).join(signs.withColumnRenamed("doc", "node"), "node")
    lists = [F.collect_list(c) for c in ("node", "comp", "signature")]
    all_ = written(rows.groupBy("key", "block").agg(*[x.alias(n) for x, n in zip(lists, ("y", "cy", "sy"))]), "member-blocks")
    outer = written(rows.where("comp <> main").groupBy("key", "block").agg(*[x.alias(n) for x, n in zip(lists, ("x", "cx", "sx"))]), "outer-blocks")
    # Pairs of block numbers first, which are short rows; then each pair is dealt out by its blocks, so that a large bucket is many tasks.
    pairs = written(outer.select("key", F.col("block").alias("own")).join(all_.select("key", "block"), "key"), "block-pairs")
    tiles = pairs.join(outer.withColumnRenamed("block", "own"), ["key", "own"]).join(all_, ["key", "block"]).select("x", "cx", "sx", "y", "cy", "sy")
    return tiles.mapInArrow(partial(_tile, least=_agreement(least, FINE)), "a long, b long").distinct()


def links_of(members: DataFrame, signs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links that join all candidates of the buckets (``key``, ``node``, ``size``) whose bags are as similar as asked."""
    busy = written(members.groupBy("node").agg(F.sum(F.col("size") - 1).alias("degree")), "degrees")
    ranked = members.join(busy, "node")
    # A bucket's hub shares most buckets with others: of copies, most often their original.
    hubs = written(ranked.groupBy("key").agg(F.max_by("node", F.struct("degree", -F.col("node"))).alias("hub")), "hubs")
    tried = written(members.join(hubs, "key").where("node <> hub").select(*_pairs("node", "hub")).distinct(), "pairs")
    links = written(verified(tried, signs, texts, least), "links")
    # Whatever lies apart still is tried with all of its buckets.
    open_ = _placed(members, links)
    rest = written(_across(open_, texts, least).join(tried, ["a", "b"], "left_anti"), "pairs")
    return written(links.unionByName(verified(rest, signs, texts, least)), "links")


def near_dedup(docs: DataFrame, *, least: float = SIMILARITY) -> DataFrame:
    """``doc_id`` and ``class_id``, the smallest id of its class, one row per row of ``docs``.

    Documents whose shingle bags have a weighted Jaccard similarity of ``least`` or more are of
    one class, and so are those linked through others. Words are runs of word characters in
    lower case; a text of fewer than five is one shingle. Texts without a word are alike if they
    are equal but for white space at the ends; null is empty. A row without an id is a class of
    its own, which is null. Rows that repeat an id are one document, linked by any of its texts. Other columns are ignored. No rows: no rows.
    """
    ship(docs.sparkSession)
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc"), "text")
    signs = written(
        plain.where("doc IS NOT NULL").mapInArrow(_signed, "doc long, digest binary, signature binary, bands array<long>"), "signatures"
    )
    # Equal bags are one node, named by the smallest id: a group of copies leaves a task as one row.
    nodes = written(signs.groupBy("digest").agg(F.min("doc").alias("node")), "nodes")
    own = written(signs.join(nodes, [signs["digest"] == nodes["digest"], signs["doc"] == nodes["node"]], "left_semi").drop("digest"), "node-signatures")
    rows = own.select(F.col("doc").alias("node"), F.explode("bands").alias("key"))
    # A row for each id and bucket, also where an id has several bags.
    shared = written(rows.distinct().groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "shared-buckets")
    members = written(rows.distinct().join(shared, "key"), "buckets")
    suspects = written(members.select(F.col("node").alias("doc")).distinct(), "suspects")
    texts = written(plain.join(small(suspects, 16), "doc"), "suspect-texts")
    links = links_of(members, own.select("doc", "signature"), texts, least)
    classes = nodes.withColumn("class_id", F.col("node"))
    # An id on several rows has several nodes, which are one document.
    same = signs.select("doc", "digest").join(nodes, "digest").groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    links = written(links.unionByName(same.select("a", "b")), "links")
    if not links.isEmpty():
        comp = components(links)
        classes = nodes.join(comp, "node", "left").withColumn("class_id", F.coalesce("comp", "node"))
    by_doc = signs.select("doc", "digest").join(classes.select("digest", "class_id"), "digest").select("doc", "class_id")
    by_doc = written(by_doc.distinct(), "classes")
    ids = pick(docs, "doc_id").select("doc_id", F.col("doc_id").cast("long").alias("doc"))
    return ids.join(by_doc, "doc", "left").select("doc_id", F.coalesce("class_id", "doc").alias("class_id"))
