"""Web archives: write captures as WARC records, read them back and assemble transactions.

A capture is a request, a response (or a revisit of an equal payload) and a metadata record.
The request and metadata name the response in ``WARC-Concurrent-To``; the reader joins the
three through that and returns one nested row per capture.

Archives are written by Spark's text writer with the record terminator as line separator,
gzip-compressed, and read with the binary file source, so any file system will do. Payloads are
written by classes of their size, and a file holds so many of a class that it has ``FILE_BYTES`` at
most before compression, or one capture that alone is larger. Spark's writer makes a file one
gzip member, so archives are read from their start, without an index of members.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.llm.columns import pick
from bankmart.llm.shipping import ship
from bankmart.store import written

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
# A lookup of this many bytes at most is broadcast; a larger one is joined by shuffle.
SMALL_BYTES = 32 << 20
BYTES_PER_ROW = 80
ROWS = 256
FILE_BYTES = 256 << 20
# Upper ends of the classes of payload sizes; what a capture's three records add to its payload is below SPARE.
CLASSES = (1 << 16, 1 << 20, 1 << 24, FILE_BYTES)
SPARE = 1 << 14


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _fields(kind: str, record_id: str, more: list[str], block: str) -> str:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}", *more]
    return CRLF.join([*head, f"Content-Length: {len(block.encode())}", "", block])


def _one_line(text: str | None) -> str:
    return " ".join((text or "").split())


def _identifier(page: int | None, sha: bytes, copy: int) -> str:
    return f"urn:capture:{'' if page is None else page}:{sha.hex()}:{copy}"


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The three records of each capture, without the terminator."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            out = []
            for row in batch.slice(start, ROWS).to_pylist():
                page, html = row["page_id"], row["html"] or ""
                base = _identifier(page, row["sha"], row["copy"])
                target = f"WARC-Target-URI: {_one_line(row['url'])}"
                concurrent = f"WARC-Concurrent-To: <{base}:response>"
                payload = html.encode()
                http = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""])
                more = [target, "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
                if row["of"] is None:
                    out.append(_fields("response", f"{base}:response", more, http + html))
                else:
                    more += [f"WARC-Refers-To: <{_identifier(row['of'], row['sha'], row['of_copy'])}:response>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
                    out.append(_fields("revisit", f"{base}:response", more, http))
                request = CRLF.join(["GET / HTTP/1.1", f"Referer: {_one_line(row['url'])}", "", ""])
                out.append(_fields("request", f"{base}:request", [target, concurrent, "Content-Type: application/http; msgtype=request"], request))
                meta = CRLF.join(["" if page is None else f"page-id: {page}", f"payload-bytes: {len(payload)}", ""]).lstrip()
                out.append(_fields("metadata", f"{base}:metadata", [target, concurrent, "Content-Type: application/warc-fields"], meta))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def write_warc(pages: DataFrame, path: str, *, min_bytes: int = 0, per_file: int = 1000) -> None:
    """Write a capture per row of ``page_id``, ``url``, ``html`` to gzip archives under ``path``.

    A null html is an empty payload. Of rows with equal payloads of ``min_bytes`` or more the
    largest ``page_id`` becomes a response and the others revisit it, by its record id; shorter payloads
    are all responses. Rows that repeat the largest id are all responses, the first of which is revisited,
    and so is every row without an id a response. Other columns are ignored. No rows: no record. A file holds
    ``per_file`` captures at most. Rows without an id, or equal in id and payload, are told apart by their place in the scan.
    """
    ship(pages.sparkSession)
    plain = (
        pick(pages, "page_id", "url", "html")
        .withColumns({"page_id": F.col("page_id").cast("long"), "html": F.coalesce("html", F.lit(""))})
        .withColumn("sha", F.unhex(F.sha1("html"))).withColumn("copy", F.monotonically_increasing_id())
    )
    # One short row per page: no payload is shuffled.
    held = written(
        plain.groupBy("page_id", "sha").agg(
            F.max(F.octet_length("html")).alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("copy").alias("first")
        ),
        "payloads",
    )
    # Partial aggregates: a payload that a third of the pages hold leaves a task as one row.
    best = (
        held.where((F.col("bytes") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("sha")
        .agg(F.max(F.struct("page_id", "n", "first")).alias("of"), F.min("page_id").alias("least")).where("least < of.page_id")
    )
    # Only what repeats needs a place of its own in its identifier.
    place = lambda n, first: F.when(n > 1, first).otherwise(0)
    marks = held.join(best, "sha", "left").select(
        "page_id", "sha", (F.col("n") > 1).alias("again"),
        F.when(F.col("page_id") != F.col("of.page_id"), F.struct(F.col("of.page_id").alias("id"), place(F.col("of.n"), F.col("of.first")).alias("copy"))).alias("of"),
    )
    marks = written(marks.where("page_id IS NOT NULL AND (again OR of IS NOT NULL)"), "revisits")
    if marks.count() * BYTES_PER_ROW <= SMALL_BYTES:
        marks = F.broadcast(marks)
    rows = plain.join(marks, ["page_id", "sha"], "left").select(
        "page_id", "url", "html", "sha", F.when(F.col("page_id").isNull() | F.col("again"), F.col("copy")).otherwise(F.lit(0)).alias("copy"),
        F.col("of.id").alias("of"), F.col("of.copy").alias("of_copy"),
    )
    bounds = [*CLASSES, None]
    classes = [F.count_if((F.col("bytes") > low) & (F.lit(True) if high is None else F.col("bytes") <= high)).alias(f"c{i}")
               for i, (low, high) in enumerate(zip([-1, *CLASSES], bounds))]
    counts = held.agg(*classes).first()
    for i, (low, high) in enumerate(zip([-1, *CLASSES], bounds)):
        if counts[i] == 0 and (i or any(counts)):
            continue
        size = F.octet_length("html")
        own = rows.where((size > low) & (F.lit(True) if high is None else size <= high))
        most = min(per_file, max(1, FILE_BYTES // (high + SPARE)) if high else 1)
        records = own.mapInArrow(_records, "value string")
        records.write.mode("append").option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", 3 * most).text(path)


def _parsed(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record, one at a time.

    A record begins at a line that names the format; lines before one are passed over, and so is
    the block of a record whose length is missing or no number, which then counts as empty.
    """
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = fields.get("content-length", "")
        yield fields, stream.read(int(length)) if length.isascii() and length.isdigit() else b""


def _identity(value: str | None) -> str | None:
    return value and value.strip("<>")


RECORD = "type string, record_id string, concurrent_to string, refers_to_id string, uri string, declared string, digest string, bytes long, payload binary, fields string"


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (c.split() for c in RECORD.split(", "))])

    def frame(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        for i in range(batch.num_rows):
            rows, held = [], 0
            with gzip.GzipFile(fileobj=io.BytesIO(batch.column(0)[i].as_py())) as unzipped:
                for f, block in _parsed(io.BufferedReader(unzipped, 1 << 20)):
                    kind, payload = f.get("warc-type", ""), b""
                    if kind in ("response", "revisit"):
                        payload = block.partition(b"\r\n\r\n")[2]
                    text = block.decode("utf-8", "replace") if kind == "metadata" else None
                    declared = (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                    rows.append((kind, _identity(f.get("warc-record-id")), _identity(f.get("warc-concurrent-to")), _identity(f.get("warc-refers-to")),
                                 f.get("warc-target-uri"), declared, payload_digest(payload), len(payload), payload, text))
                    held += len(block)
                    if held > 4 << 20:
                        yield frame(rows)
                        rows, held = [], 0
            if rows:
                yield frame(rows)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the gzip archives under ``path``, one row each, blocks parsed by their declared length.

    A record without a type has an empty one, one without an id a null id, and one without a length an empty
    block; metadata that is not UTF-8 is read with replacement characters. A file that is no gzip, or breaks off, stops the job.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_read, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: its ``response``, ``request`` and ``metadata`` records, joined by concurrent-to.

    A response without the others has nulls in their place; with several of a kind, the smallest
    record id counts. Requests and metadata of no response are left out. A record id that repeats
    gives a row each time.
    """
    answers = records.where("type IN ('response', 'revisit')").select(
        "record_id", "uri",
        F.struct("type", "refers_to_id", "declared", "digest", "bytes", "payload").alias("response"),
    )
    sides = (
        records.where("type IN ('request', 'metadata')").groupBy(F.col("concurrent_to").alias("record_id"))
        .agg(
            F.min(F.when(F.col("type") == "request", F.struct("record_id", "uri"))).alias("request"),
            F.min(F.when(F.col("type") == "metadata", F.struct("record_id", "fields"))).alias("metadata"),
        )
    )
    return answers.join(sides, "record_id", "left").select("record_id", "uri", "request", "response", "metadata")


def declared_pages(found: DataFrame) -> DataFrame:
    """What the records of each capture say of its page: id, payload bytes and digest, kind, and the page it revisits.

    A response's bytes and digest are measured on the payload read back; a revisit, which has
    none, states them in its headers.
    """
    field = lambda name: F.regexp_extract("metadata.fields", rf"(?m)^{name}: *(-?\d+)", 1)
    number = lambda c: F.when(c != "", c.cast("long"))
    revisit = F.col("response.type") == "revisit"
    return found.select(
        number(field("page-id")).alias("page_id"),
        F.when(revisit, number(field("payload-bytes"))).otherwise(F.col("response.bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("response.declared")).otherwise(F.col("response.digest")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.regexp_extract("response.refers_to_id", r"^urn:capture:(-?\d+):", 1).try_cast("long").alias("refers_to"),
    )
