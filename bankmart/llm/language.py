"""Language of a text by the nearest of several TF-IDF centroids per language.

Letters in lower case, other characters being one space, give character trigrams, hashed to
``DIMS`` features. A text's vector holds (1 + log count) x idf, at length 1. Each language's
training texts are clustered by cosine into a few centroids; the nearest centroid of all
names the language. Short texts lie farther from any centroid than long ones, so the distance
at which a text is rejected goes by the number of its distinct trigrams: the training texts and
pieces of them of all lengths show how near texts of a language come, and a text that comes not
half as near as almost all of its length is of none.

The classifier is fitted on a sample of at most ``per_language`` labelled rows of each
language, whole texts, those with the smallest hashes of id and text: that bound keeps the fit on
the driver small at any size of input. Prediction runs inside the scan, without a shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from bankmart.llm.columns import numbered, pick
from bankmart.llm.memory import tidy
from bankmart.llm.shipping import ship
from bankmart.store import written

DIMS = 1 << 17
PER_LANGUAGE = 300
CLUSTERS = 3
UNKNOWN = "und"
# Limits of rejection: of the training cosines at a length all but this part lie above ``x``, and a text goes below NEARNESS * x.
TAIL, NEARNESS = 0.002, 0.5
# Training cosines that a limit needs; a length with fewer shares the limit of shorter texts.
ENOUGH = 200
# Pieces of training texts have 4, 8, 16, ... characters.
SHORTEST_PIECE = 4
ROWS = 256


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """The hashed trigrams of a text and how often each stands in it; None without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, np.uint32(32))
    inside = letter | np.concatenate(([True], letter[:-1]))  # the first of a run of others stays, as a space
    codes = np.concatenate(([32], codes[inside], [32])).astype(np.uint64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1] * np.uint64(0x85EBCA77) + codes[2:] * np.uint64(0xC2B2AE3D))
    features = ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(47)).astype(np.int64)
    if features.size < DIMS >> 4:
        return np.unique(features, return_counts=True)
    found = np.bincount(features, minlength=DIMS)
    at = np.flatnonzero(found)
    return at, found[at]


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    # The least cosine by the number of distinct trigrams, as its power of two.
    limits: np.ndarray

    @cached_property
    def by_feature(self) -> np.ndarray:
        return np.ascontiguousarray(self.centroids.T)

    def cosines(self, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, weights = vector(found, self.idf)
        return weights @ self.by_feature[at]

    def nearest(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine to its nearest centroid, and whether the text is rejected."""
        found = counts(text)
        if found is None or not self.languages:
            return UNKNOWN, 0.0, True
        cosine = self.cosines(found)
        best = int(np.argmax(cosine))
        score = float(min(max(cosine[best], 0.0), 1.0))
        return self.languages[best], score, score < self.limits[min(length(found), len(self.limits) - 1)]


def length(found: tuple[np.ndarray, np.ndarray]) -> int:
    """The power of two of the number of distinct trigrams."""
    return len(found[0]).bit_length() - 1


def vector(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = found
    weights = (1 + np.log(n)) * idf[at]
    return at, weights / (np.linalg.norm(weights) or 1.0)


@tidy
def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            rows = [(lang, *f) for lang, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if (f := counts(t))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1].astype("<u4").tobytes() for r in rows], pa.binary()),
                 pa.array([r[2].astype("<u4").tobytes() for r in rows], pa.binary())],
                names=["lang", "at", "n"],
            )


def clusters(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from well-spread first centres: centroids, and the centroid of each vector."""
    centres = [vectors[0]]
    while len(centres) < min(k, len(vectors)):
        centres.append(vectors[np.argmin(np.max(vectors @ np.array(centres).T, axis=1))])
    centroids = np.array(centres)
    for _ in range(20):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.array([vectors[own == j].sum(axis=0) if (own == j).any() else centroids[j] for j in range(len(centroids))])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


def pieces(text: str) -> Iterator[str]:
    """Both ends of a text, of each length that is a power of two."""
    size = SHORTEST_PIECE
    while size < len(text):
        yield text[:size]
        yield text[-size:]
        size *= 2


@tidy
def _nearness(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Length and cosine of training texts and their pieces, to the nearest centroid of their own language."""
    languages = np.array(model.value.languages)
    for batch in batches:
        lengths, scores = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for piece in (text, *pieces(text)):
                if (found := counts(piece)) is not None:
                    lengths.append(length(found))
                    scores.append(float(model.value.cosines(found)[languages == lang].max()))
        yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int32()), pa.array(scores, pa.float64())], names=["length", "score"])


def least_cosines(lengths: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The limit for each length, never below that of a shorter one."""
    limits = [0.0]
    for size in range(int(lengths.max()) + 1 if lengths.size else 0):
        own = scores[lengths == size]
        limits.append(max(limits[-1], NEARNESS * float(np.quantile(own, TAIL))) if own.size >= ENOUGH else limits[-1])
    return np.array(limits[1:] or limits)


def sampled(labelled: DataFrame, per_language: int) -> DataFrame:
    """``lang`` and ``text`` of at most ``per_language`` rows of each language, written.

    Those with the smallest hashes of id and text. Chance leaves a few times as many to be ordered, each task passes on
    ``per_language`` of a language at most, and rows that repeat an id or have none are drawn each by its text.
    """
    rows = pick(labelled, "doc_id", "text", "lang").where("lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit(10)), F.lit(1 << 30)) / float(1 << 30)
    wanted = F.lit(False)
    for lang, n in sizes.items():
        wanted = wanted | ((F.col("lang") == lang) & (chance < min(1.0, (3 * per_language + 100) / n)))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    drawn = rows.where(wanted & F.col("text").isNotNull()).withColumn("draw", chance).withColumn("nth", F.row_number().over(order))
    return written(drawn.where(F.col("nth") <= per_language).select("lang", "text"), "language-sample")


def fit(labelled: DataFrame, *, per_language: int = PER_LANGUAGE, k: int = CLUSTERS) -> Model:
    """A model from rows of ``doc_id``, ``text``, ``lang``.

    Rows without a language or a letter are not used. Rows may repeat ids or have none; equal rows count each time,
    within the bound. With no row left, every text is unknown.
    """
    spark = labelled.sparkSession
    ship(spark)
    texts = sampled(labelled, per_language)
    sample = texts.mapInArrow(_features, "lang string, at binary, n binary").collect()
    sample.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["n"])))
    found = [(r["lang"], (np.frombuffer(r["at"], "<u4").astype(np.int64), np.frombuffer(r["n"], "<u4"))) for r in sample]
    seen = np.zeros(DIMS)
    for _, (at, _) in found:
        seen[at] += 1
    idf = np.log((1 + len(found)) / (1 + seen)) + 1
    languages, centroids = [], []
    for lang in sorted({lang for lang, _ in found}):
        own = [f for name, f in found if name == lang]
        used = np.unique(np.concatenate([at for at, _ in own]))
        dense = np.zeros((len(own), len(used)), np.float32)
        for row, f in zip(dense, own):
            at, weights = vector(f, idf)
            row[np.searchsorted(used, at)] = weights
        centres, _ = clusters(dense, k)
        for centre in centres:
            languages.append(lang)
            centroids.append(np.zeros(DIMS, np.float32))
            centroids[-1][used] = centre
    model = Model(idf, languages, np.array(centroids, np.float32).reshape(-1, DIMS), np.zeros(1))
    if languages:
        shared = spark.sparkContext.broadcast(model)
        near = texts.mapInArrow(partial(_nearness, model=shared), "length int, score double").collect()
        shared.destroy()
        model.limits = least_cosines(np.array([r["length"] for r in near], int), np.array([r["score"] for r in near]))
    return model


@tidy
def _predict(batches: Iterable[pa.RecordBatch], model, at: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            batch = whole.slice(start, ROWS)
            found = [model.value.nearest(t) for t in batch.column(at).to_pylist()]
            langs, scores, rejected = ([f[i] for f in found] for i in range(3))
            columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: a fifth, by the checksum of the id as text. A row without an id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    The text alone decides. A null text, or one without a letter, is ``und``, 0 and rejected.
    Ties go to the language that is first in order. Rows and columns are returned as they
    are, also columns that bear one of these names, which then stands twice. No rows: no rows.
    """
    ship(docs.sparkSession)
    plain, (text,) = numbered(docs, "text")
    n = len(plain.columns)
    more = [StructField(f"c{n}", StringType()), StructField(f"c{n + 1}", DoubleType()), StructField(f"c{n + 2}", BooleanType())]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = plain.mapInArrow(partial(_predict, model=shared, at=plain.columns.index(text)), StructType(list(plain.schema.fields) + more))
    return out.toDF(*docs.columns, "lang_pred", "score", "rejected")


def train(docs: DataFrame, *, per_language: int = PER_LANGUAGE) -> Model:
    """A model from the rows of ``docs`` that are not held out."""
    rows = pick(docs, "doc_id", "text", "lang")
    return fit(rows.where(~held_out(F.col("doc_id"))), per_language=per_language)
