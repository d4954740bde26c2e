"""Drop lines that an earlier document holds too.

Two Bloom filters, of line hashes seen once and seen twice, are built by every scan
task and merged bit by bit. Only lines whose hash is in the second one are shuffled,
as digests, to confirm the repeat exactly and find the smallest document that has it.

A filter has ``bits`` bits whatever the data, so it bounds what is held: a scan task has two
filters (16 MB at the default), the driver and a broadcast one (8 MB). A crowded filter only
lets more lines be shuffled; the result does not depend on it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from bankmart.llm.columns import numbered
from bankmart.llm.joins import small
from bankmart.llm.memory import tidy
from bankmart.llm.shipping import ship
from bankmart.store import written

NO_ID = 2**63 - 1
SPACE = b" \t\n\x0b\x0c\r"
# Filters are sent in segments, each as its bytes or, where few bits are set, as their numbers: what many
# small tasks send is then as long as their lines are many. A segment has as many bits as an unsigned 16-bit
# number tells apart, and those of a part go together.
PART_BYTES = 1 << 17
SEGMENT_BYTES = 1 << 13
ROWS = 512


def keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """The key of each line, None where it is too short to count."""
    out = []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        key = line.strip(SPACE).lower()
        short = len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars)
        out.append(None if short else key)
    return out


def digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _texts(batches: Iterable[pa.RecordBatch], at: int) -> Iterator[list[str | None]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.column(at).slice(start, ROWS).to_pylist()


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(31)) & mask).astype(np.int64)


def _hashes(found: Iterable[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in found), dtype=np.uint64)


def _set(filter_: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(filter_, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))


def _get(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (filter_[at >> 3] << (at & 7).astype(np.uint8) & 128).astype(bool)


def _packed(segment: np.ndarray) -> bytes:
    """A segment as the numbers of its set bits, where these are shorter than the segment."""
    set_bits = np.flatnonzero(np.unpackbits(segment)).astype("<u2")
    return set_bits.tobytes() if set_bits.nbytes < SEGMENT_BYTES else segment.tobytes()


def _unpacked(part: bytes | pa.Buffer) -> np.ndarray:
    if len(part) == SEGMENT_BYTES:
        return np.frombuffer(part, np.uint8).copy()
    bits = np.zeros(SEGMENT_BYTES * 8, np.uint8)
    bits[np.frombuffer(part, "<u2")] = 1
    return np.packbits(bits)


@tidy
def _task_filters(batches: Iterable[pa.RecordBatch], bits: int, min_chars: int) -> Iterator[pa.RecordBatch]:
    once, twice = np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)
    for texts in _texts(batches, 0):
        own = [_hashes({k for k in keys(t, min_chars) if k is not None}) for t in texts]
        values, counts = np.unique(np.concatenate(own), return_counts=True)
        probes = _probes(values, bits)
        again = (counts > 1) | np.logical_and(*[_get(once, at) for at in probes])
        for at in probes:
            _set(twice, at[again])
            _set(once, at)
    for i in range(0, once.size, PART_BYTES):
        part = [f[i : i + PART_BYTES].tobytes() for f in (once, twice)]
        if any(part[0]):
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([i // PART_BYTES], pa.int32()), "once": [part[0]], "twice": [part[1]]}
            )


def _sent_filters(batches: Iterable[pa.RecordBatch], bits: int, min_chars: int) -> Iterator[pa.RecordBatch]:
    """The segments of a task's filters that have any bit, packed."""
    for batch in _task_filters(batches, bits, min_chars):
        first = batch["part"][0].as_py() * (PART_BYTES // SEGMENT_BYTES)
        once, twice = (np.frombuffer(batch[n][0].as_buffer(), np.uint8) for n in ("once", "twice"))
        rows = [
            (first + at // SEGMENT_BYTES, *[_packed(f[at : at + SEGMENT_BYTES]) for f in (once, twice)])
            for at in range(0, once.size, SEGMENT_BYTES)
            if once[at : at + SEGMENT_BYTES].any()
        ]
        types = [pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["segment", "once", "twice"])


@tidy
def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold the filters of each segment as they come in: what two tasks saw once was seen twice."""
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for number, *parts in zip(*batch.columns):
            segment = number.as_py()
            once, twice = (_unpacked(part.as_buffer()) for part in parts)
            if segment in held:
                old_once, old_twice = held[segment]
                old_twice |= twice
                old_twice |= old_once & once
                old_once |= once
            else:
                held[segment] = [once, twice]
    for segment, (_, twice) in held.items():
        if twice.any():
            yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()), "twice": [twice.tobytes()]})


@tidy
def _suspects(batches: Iterable[pa.RecordBatch], twice, bits: int, min_chars: int) -> Iterator[pa.RecordBatch]:
    """The digests of lines that the filter has, behind the other columns of their row."""
    filled = np.frombuffer(twice.value, np.uint8)
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            pairs = [
                (i, k) for i, t in enumerate(part.column(0).to_pylist()) for k in {k for k in keys(t, min_chars) if k is not None}
            ]
            if not pairs:
                continue
            hit = np.logical_and(*[_get(filled, at) for at in _probes(_hashes(k for _, k in pairs), bits)])
            chosen = [pairs[i] for i in np.flatnonzero(hit)]
            rows = part.select(part.schema.names[1:]).take(pa.array([i for i, _ in chosen], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([digest(k) for _, k in chosen], pa.binary())], names=["doc", "a", "b", "digest"]
            )


@tidy
def _kept(batches: Iterable[pa.RecordBatch], at: int, min_chars: int) -> Iterator[pa.RecordBatch]:
    """Replaces the text, and the last column, the digests to drop, by the two counts."""
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            batch = whole.slice(start, ROWS)
            texts, lines, dropped = [], [], []
            for text, drop in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                text = text or ""
                n = text.count("\n") + 1
                if drop:
                    gone = set(drop)
                    found = keys(text, min_chars)
                    left = [line for line, k in zip(text.split("\n"), found) if k is None or digest(k) not in gone]
                    text = "\n".join(left)
                    dropped.append(n - len(left))
                else:
                    dropped.append(0)
                texts.append(text)
                lines.append(n)
            columns = list(batch.columns[:-1]) + [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])


def twice_filter(texts: DataFrame, bits: int, min_chars: int) -> bytes:
    """The merged filter of hashes that more than one row may hold. ``texts``: ``text``."""
    parts = texts.select("text").mapInArrow(
        partial(_sent_filters, bits=bits, min_chars=min_chars), "segment int, once binary, twice binary"
    )
    merged = parts.repartition("segment").mapInArrow(_merge, "segment int, twice binary")
    filled = bytearray(bits // 8)
    for row in merged.collect():  # bits / 8 bytes in all
        at = row["segment"] * SEGMENT_BYTES
        filled[at : at + len(row["twice"])] = row["twice"]
    return bytes(filled)


def line_dedup(docs: DataFrame, *, min_chars: int = 10, bits: int = 1 << 26) -> DataFrame:
    r"""``docs`` without repeated lines, plus ``n_lines`` (before) and ``n_dropped``.

    Lines end at \n; a null or empty text is one empty line and comes out empty. Lines are
    compared stripped of ASCII white space with A-Z in lower case. A key of ``min_chars``
    code points or more that several documents hold stays in the smallest ``doc_id`` alone,
    there as often as it stands. Rows with the same id are one document; rows without an id
    are one that comes after all others. Either may be any share of the rows: what a row loses
    is gathered for that row alone. Every other column is returned as it is; extra
    columns may bear any name, also ``n_lines``, which is then there twice. No rows: no rows.
    ``bits`` is a power of two from 2**20 to 2**32.
    """
    spark = docs.sparkSession
    ship(spark)
    plain, (doc, text) = numbered(docs, "doc_id", "text")
    # What is dropped of a row follows from its id and text, which two hashes stand for.
    own = [F.coalesce(F.col(doc).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")]
    texts = plain.select(F.col(text).alias("text"), *own)
    twice = spark.sparkContext.broadcast(twice_filter(texts, bits, min_chars))
    suspects = written(
        texts.mapInArrow(
            partial(_suspects, twice=twice, bits=bits, min_chars=min_chars), "doc long, a long, b long, digest binary"
        ),
        "line-suspects",
    )
    twice.destroy()
    # Written, so that the join shuffles it anew and can split a line that very many documents hold.
    first = written(
        suspects.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        .where("first < last").select("digest", "first"),
        "first-lines",
    )
    drop = written(
        suspects.join(small(first, 48), "digest").where("doc > first")
        .groupBy("doc", "a", "b").agg(F.collect_set("digest").alias("drop")),
        "dropped-lines",
    )
    keyed = plain.select("*", *[c.alias(f"own_{n}") for c, n in zip(own, "dab")])
    same = [F.col(f"own_{n}") == F.col(c) for n, c in zip("dab", ("doc", "a", "b"))]
    # Texts are shuffled only where the list of what goes is too large to be broadcast.
    joined = keyed.join(small(drop, 64 + 24 * F.size("drop")), same, "left").select(*plain.columns, "drop")
    at = plain.columns.index(text)
    n = len(plain.columns)
    counts = [StructField(f"c{n + i}", LongType()) for i in range(2)]
    out = joined.mapInArrow(partial(_kept, at=at, min_chars=min_chars), StructType(list(plain.schema.fields) + counts))
    return out.toDF(*docs.columns, "n_lines", "n_dropped")
