"""Archives written and read back."""

import base64
import gzip
import hashlib
import random
import uuid
from pathlib import Path

import pytest

from bankmart.llm import warc


def expected(rows, least=0):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        revisit = page is not None and len(payload) >= least and max(same) != page
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=str)


def stored(spark, df, **options):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/warc-{uuid.uuid4().hex}"
    warc.write_warc(df, path, **options)
    return path


def found(spark, path):
    return sorted((tuple(r) for r in warc.declared_pages(warc.captures(warc.read_warc(spark, path))).collect()), key=str)


ROWS = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, "http://a/9", "<p>same</p>"), (3, None, None), (4, "u", ""),
    (5, "u\r\nWARC-Type: fake", "a\r\n\r\nWARC/1.1\r\nb\r\n\r\n"), (6, "é", "é𝄞\x00\x1f"), (7, "u", "x" * 500_000), (8, "u", "x" * 500_000),
    (None, "u", "<p>same</p>"), (None, None, None), (9, "http://a/9", "<p>same</p>"), (9, "http://b", "another"), (-4, "u", "another"),
]


@pytest.mark.parametrize("least", [0, 5, 1000])
def test_odd_rows(spark, least):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, HTML string").repartition(3)
    assert found(spark, stored(spark, df, min_bytes=least)) == expected(ROWS, least)


def test_test_table_in_small_files_and_by_shuffle(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    monkeypatch.setattr(warc, "SMALL_BYTES", -1)
    assert found(spark, stored(spark, df.unionByName(df.where("page_id < 9").selectExpr("page_id + 1000 page_id", "url", "html")), per_file=7)) == expected(
        rows + [(p + 1000, u, h) for p, u, h in rows if p < 9]
    )


def test_records_are_joined_by_concurrent_to(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(4)
    records = warc.read_warc(spark, stored(spark, df))
    assert records.groupBy("type").count().count() == 4
    nested = warc.captures(records.repartition(5)).collect()
    assert len(nested) == len(ROWS)
    for r in nested:
        assert r["request"]["record_id"] == r["record_id"].replace(":response", ":request")
        assert r["metadata"]["record_id"] == r["record_id"].replace(":response", ":metadata")
        assert r["response"]["type"] == "revisit" or bytes(r["response"]["payload"]).decode() in {h or "" for _, _, h in ROWS}
    lonely = warc.captures(records.where("type <> 'request'")).collect()
    assert len(lonely) == len(ROWS) and all(r["request"] is None and r["metadata"] is not None for r in lonely)


def test_archives_are_plain_warc(spark, tmp_path):
    path = stored(spark, spark.createDataFrame([(1, "http://a", "<p>x</p>")], "page_id long, url string, html string"))
    from pathlib import Path

    text = b"".join(gzip.decompress(p.read_bytes()) for p in Path(path).glob("*.gz")).decode()
    records = text.split("\r\n\r\nWARC/1.1\r\n")
    assert len(records) == 3 and text.startswith("WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith("\r\n\r\n")


def test_no_rows(spark):
    assert found(spark, stored(spark, spark.createDataFrame([], "page_id long, url string, html string"))) == []


def test_every_revisit_names_a_response(spark):
    """By an id that one record of the archive has, with the same payload."""
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(4)
    records = warc.read_warc(spark, stored(spark, df)).collect()
    ids = [r["record_id"] for r in records]
    assert len(set(ids)) == len(ids)
    responses = {r["record_id"]: r["digest"] for r in records if r["type"] == "response"}
    revisits = [r for r in records if r["type"] == "revisit"]
    assert len(revisits) == sum(r[3] == "revisit" for r in expected(ROWS)) and all(responses[r["refers_to_id"]] == r["declared"] for r in revisits)


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 18)
    monkeypatch.setattr(warc, "CLASSES", (1 << 10, 1 << 14, 1 << 18))
    monkeypatch.setattr(warc, "SPARE", 1 << 11)
    draw = random.Random(2)
    rows = [(i, "u", "".join(draw.choices("abcdef", k=draw.choice([5, 900, 9000, 200_000, 400_000 if i == 7 else 50])))) for i in range(120)]
    path = stored(spark, spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2))
    sizes = [len(gzip.decompress(p.read_bytes())) for p in Path(path).glob("*.gz")]
    assert sum(s > 1 << 18 for s in sizes) <= 1 and len(sizes) > 3
    assert found(spark, path) == expected(rows)


def test_records_that_lack_fields_are_read(spark, tmp_path):
    text = b"\r\n".join([
        b"junk", b"WARC/1.1", b"WARC-Type: metadata", b"Content-Length: 3", b"", b"\xff\xfe.", b"", b"",
        b"WARC/1.1", b"WARC-Type: response", b"WARC-Record-ID: <a>", b"", b"lost block", b"WARC/1.1", b"Content-Length: x1", b"", b"",
        b"WARC/1.1", b"WARC-Type: response", b"WARC-Record-ID: <b>", b"Content-Length: 8", b"", b"h\r\n\r\nabc", b"", b"",
    ])
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(text))
    got = [(r["type"], r["record_id"], r["bytes"], r["fields"]) for r in warc.read_warc(spark, str(tmp_path)).collect()]
    assert got == [("metadata", None, 0, "\ufffd\ufffd."), ("response", "a", 0, None), ("", None, 0, None), ("response", "b", 3, None)]
    assert len(warc.captures(warc.read_warc(spark, str(tmp_path))).collect()) == 2
