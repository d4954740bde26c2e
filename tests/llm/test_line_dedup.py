"""Line dedup against a plain reading of its rule."""

from collections import defaultdict

import pytest

from bankmart.llm import line_dedup as module
from bankmart.llm.line_dedup import line_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def expected(rows):
    ids = [(2**63 - 1 if i is None else i, t or "") for i, t in rows]
    holders = defaultdict(set)
    for i, t in ids:
        for line in t.split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, t in ids:
        lines = t.split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) == 1 or min(holders[key(x)]) == i]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def found(df):
    rows = df.toDF(*[f"c{i}" for i in range(len(df.columns))]).collect()
    return sorted((r[1], r[-2], r[-1]) for r in rows)


def plain(df):
    return [(r[0], r[1]) for r in df.collect()]


def test_equals_the_rule(docs):
    assert found(line_dedup(docs)) == expected(plain(docs))


def test_odd_rows_and_clashing_columns(odd_docs):
    out = line_dedup(odd_docs)
    assert out.columns == [*odd_docs.columns, "n_lines", "n_dropped"]
    assert found(out) == expected(plain(odd_docs))


def test_no_rows(no_docs):
    assert line_dedup(no_docs).count() == 0


def test_a_crowded_filter_changes_nothing(docs):
    assert found(line_dedup(docs, bits=1 << 20)) == expected(plain(docs))


def test_line_in_most_documents(spark):
    rows = [(i, f"the very common line\nline number {i} alone") for i in range(500)]
    out = line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert found(out) == expected(rows)


def test_joins_are_not_limited_to_small_tables(docs, monkeypatch):
    monkeypatch.setattr("bankmart.llm.joins.SMALL_BYTES", -1)
    assert found(line_dedup(docs)) == expected(plain(docs))


@pytest.mark.parametrize("text,keys", [(None, [None]), ("short", [None]), ("éééééééééé", ["éééééééééé".encode()]), ("ééééé", [None])])
def test_keys_count_code_points(text, keys):
    assert module.keys(text, 10) == keys


@pytest.mark.parametrize("same_id", [None, 7])
def test_a_third_of_the_rows_under_one_id(spark, same_id, monkeypatch):
    """What is dropped is gathered by row, so rows without an id, or of one id, do not meet in one list."""
    rows = [(same_id if i % 3 == 0 else 100 + i, "\n".join(f"line number {(i * j) % 211} of all" for j in range(20))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(line_dedup(docs)) == expected(rows)
    written, frames = module.written, {}
    monkeypatch.setattr(module, "written", lambda df, label: frames.setdefault(label, written(df, label)))
    line_dedup(docs)
    assert frames["dropped-lines"].selectExpr("max(size(drop))").first()[0] <= 20


def test_filters_take_a_bit_each():
    once = [b for b in module._task_filters(iter([module.pa.RecordBatch.from_pydict({"text": ["a long line\nanother line", "a long line"]})]), 1 << 20, 10)]
    bits = lambda name: sum(bin(byte)[2:].count("1") for b in once for byte in b[name][0].as_py())
    assert (bits("once"), bits("twice")) == (4, 2)


def _filters(*texts):
    return list(module._sent_filters(iter([module.pa.RecordBatch.from_pydict({"text": list(texts)})]), 1 << 20, 10))


def test_a_task_with_few_lines_sends_little():
    """Tasks of a finely dealt table: a filter of 128 KB each way for ten lines would be shuffled by each."""
    parts = _filters("\n".join(f"line number {i}" for i in range(10)), "line number 3")
    assert sum(b.nbytes for b in parts) < 2000


@pytest.mark.parametrize("lines", [3, 3_000, 300_000])
def test_filters_of_tasks_merge_bit_by_bit(lines):
    """Sparse, mixed and full segments: what two tasks have, or one has twice, is in the merged filter."""
    texts = [[f"{task} has line {i}" for i in range(lines)] + ["a line of both", "same in all"] for task in "ab"]
    parts = [b for own in texts for b in _filters("\n".join(own), own[0])]
    filled = module.np.zeros(1 << 17, module.np.uint8)
    for batch in module._merge(iter(parts)):
        for row in batch.to_pylist():
            at = row["segment"] * module.SEGMENT_BYTES
            filled[at : at + module.SEGMENT_BYTES] = module.np.frombuffer(row["twice"], module.np.uint8)
    once = []
    for own in texts:
        bits = module.np.zeros(1 << 20, bool)
        for at in module._probes(module._hashes({module.keys(t, 10)[0] for t in own}), 1 << 20):
            bits[at] = True
        once.append(bits)
    both = module.np.unpackbits(filled).astype(bool)
    assert (both & ~(once[0] | once[1])).sum() == 0
    assert both[once[0] & once[1]].all()
    twice = module._hashes(module.keys(texts[0][0], 10) + module.keys(texts[1][0], 10) + module.keys("a line of both", 10))
    assert all(both[at].all() for at in module._probes(twice, 1 << 20))
    if lines == 3:
        assert both.sum() <= 2 * 4
