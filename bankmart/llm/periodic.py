"""Find stretches of words that repeat with a period, and take the repeats out.

For each word the match with an earlier occurrence lengthens the diagonal of that lag, and a diagonal
that ends with sufficient length gives a run at once. A run of period q agrees with itself over at
least 3q words, which keeps the diagonals sparse. Lags are taken by powers of two, w <= q < 2w: of a
word only the earlier occurrences of the 3w words that start with it count, and of these only the
nearest can lie on a run of such a period. (Two of them in this range, or one that is nearer, would
give these words a period d < w, and d + q <= 3w then makes q a multiple of a shorter period.) So
every word has one diagonal at most per power of two, whatever the text: a single word a million
times costs no more than prose. Grams that stand once in their document are not looked at again at
the next power.

Nothing is shuffled, and a task holds the words of a few documents, or of one very long one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from bankmart.llm.columns import numbered
from bankmart.llm.memory import tidy
from bankmart.llm.shipping import ship

RUNS = ArrayType(StructType([StructField(n, LongType()) for n in ("start", "length", "period")]))

# Words that are looked at together.
WORDS = 1 << 18


def _pairs(first: np.ndarray, second: np.ndarray, shift: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the grams of ``first`` at a place and ``second`` ``shift`` words on, -1 where unique; and their places."""
    names = np.full(first.size, -1, np.int64)
    at = at[: np.searchsorted(at, first.size - shift)]
    at = at[second[at + shift] >= 0]
    _, name, count = np.unique(first[at] * np.int64(first.size) + second[at + shift], return_inverse=True, return_counts=True)
    again = count[name] > 1
    names[at[again]] = name[again]
    return names, at[again]


def runs(words: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows of start, length and period, by start and period. ``words``: a number for each word, equal for equal ones."""
    count = np.bincount(words, minlength=1)
    names = np.where(count[words] > 1, words, -1)
    at = np.flatnonzero(names >= 0)
    found, width = [np.empty((0, 3), np.int64)], 1
    while at.size and times * width <= words.size:
        double, twice = _pairs(names, names, width, at)
        triple, at = _pairs(double, names, 2 * width, twice)
        order = at[np.argsort(triple[at], kind="stable")]
        lag = np.diff(order)
        near = (lag >= width) & (lag < 2 * width) & (triple[order[1:]] == triple[order[:-1]])
        place, lag = order[1:][near], lag[near]
        by_place = np.argsort(place)
        place, lag = place[by_place], lag[by_place]
        first = np.flatnonzero(np.r_[True, (np.diff(place) != 1) | (np.diff(lag) != 0)][: place.size])
        period = lag[first]
        length = np.diff(np.r_[first, place.size]) + 3 * width - 1 + period
        long = length >= np.maximum(least, times * period)
        found.append(np.stack([place[first] - period, length, period], axis=1)[long])
        names, at, width = double, twice, 2 * width
    out = np.concatenate(found)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _chunks(batches: Iterable[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Rows whose words number ``WORDS`` or so, with the words of each."""
    for batch in batches:
        start, size, words = 0, 0, []
        for text in batch.column(at).cast(pa.binary()):
            words.append((text.as_py() or b"").split())
            size += len(words[-1])
            if size >= WORDS:
                yield batch.slice(start, len(words)), words
                start, size, words = start + len(words), 0, []
        if words:
            yield batch.slice(start, len(words)), words


@tidy
def _find(batches: Iterable[pa.RecordBatch], at: int, least: int, times: int) -> Iterator[pa.RecordBatch]:
    for batch, words in _chunks(batches, at):
        edges = np.cumsum([0, *map(len, words)])
        # A word is named by its first place in its own document, so nothing matches across documents.
        names = np.empty(edges[-1], np.int64)
        for own, start, end in zip(words, edges, edges[1:]):
            names[start:end] = list(map({}.setdefault, own, range(start, end)))
        found = runs(names, least, times)
        cuts = np.searchsorted(found[:, 0], edges)
        kept = np.ones(names.size, bool)
        for start, length, period in found:
            kept[start + period : start + length] = False
        own = np.repeat(edges[:-1], np.diff(cuts))
        collapsed = [
            b" ".join(w if low == high else [w[i] for i in np.flatnonzero(kept[start : start + len(w)])])
            for w, start, low, high in zip(words, edges, cuts, cuts[1:])
        ]
        columns = [pa.array(c) for c in (found[:, 0] - own, found[:, 1], found[:, 2])]
        listed = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(columns, names=["start", "length", "period"]))
        columns = [*batch.columns, listed, pa.array(collapsed, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])


def periodic_runs(docs: DataFrame, *, least: int = 6, times: int = 4) -> DataFrame:
    r"""``docs`` plus ``runs`` (array of start, length, period, by start then period) and ``collapsed``.

    Words are what stands between ASCII white space, numbered from 0. A run is a stretch of words with
    smallest period q and ``max(least, times * q)`` words or more that no neighbouring word extends;
    ``least`` is 4 and ``times`` 4 at least. ``collapsed`` joins by one space the words that no run holds
    after its first q words. A null or empty text, or one of white space alone, has no run and collapses
    to the empty text. Rows are judged each for itself, so repeated or null ids matter nothing. All
    other columns come back as they are, whatever their names. No rows: no rows.
    """
    if least < 4 or times < 4:
        raise ValueError("least and times must be 4 or more")
    ship(docs.sparkSession)
    plain, (text,) = numbered(docs, "text")
    more = [StructField("runs", RUNS), StructField("collapsed", StringType())]
    out = plain.mapInArrow(
        partial(_find, at=plain.columns.index(text), least=least, times=times), StructType(list(plain.schema.fields) + more)
    )
    return out.toDF(*docs.columns, "runs", "collapsed")
