"""Chat formatting by exact round trips."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bankmart.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
TOKENS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<TURN x>>", "<</TURN>>", "\\l", "\\e", "\\", "<", "[", ">", "a", " ", "\n", "é", "𝄞", ">>"]


def back(spark, rows):
    df = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    loss = chat.loss_texts(F.col("formatted"), F.col("loss_spans"))
    return {r[0]: r for r in df.select("conv_id", chat.parse(F.col("formatted")).alias("turns"), "formatted", "loss_spans", loss.alias("loss")).collect()}


def check(spark, rows):
    got = back(spark, rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(r[2] or "", r[3] or "") for r in own]
        assert got[conv]["loss"] == [r[3] or "" for r in own if r[2] == "assistant"]
    assert len(got) == len({r[0] for r in rows})
    return got


def test_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    check(spark, [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_control_strings_and_odd_rows(spark):
    marked = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", marked), (-1, 1, "assistant", marked), (1, 0, None, None), (1, None, "assistant", None), (1, 0, "tool", "x>>y"),
            (2, 5, "a>>b", "z"), (2, 5, "a>>b", "z"), (2, 4, "assistant", "\\l"), (None, 1, "user", "x" * 200_000), (3, 1, "assistant", "<" ), (3, 2, "system", "<")]
    got = check(spark, rows)
    assert got[3]["formatted"] == "<s><</s><<SYS>><<</SYS>>"
    assert "</s>[INST]" not in got[-1]["formatted"].removeprefix("<s>[INST]")


def test_plain_texts_are_not_escaped(spark):
    got = check(spark, [(1, 0, "system", "be [kind]"), (1, 1, "user", "1 < 2?"), (1, 2, "assistant", "yes \\o/")])
    assert got[1]["formatted"] == "<s><<SYS>>be [kind]<</SYS>>[INST]1 < 2?[/INST]yes \\o/</s>"
    assert [tuple(s) for s in got[1]["loss_spans"]] == [(46, 53)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 3), st.sampled_from(["system", "user", "assistant", "tool", "x>>", None, "<</TURN>>"]),
                          st.lists(st.sampled_from(TOKENS), max_size=7).map("".join)), min_size=1, max_size=40))
def test_any_text_reads_back(spark, rows):
    check(spark, rows)


def test_no_rows_and_extra_columns(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "a", "b")], SCHEMA + ", TEXT string")
    assert chat.format_chats(df).first()["formatted"] == "<s>[INST]a[/INST]"
    assert hashlib.sha256(b"").hexdigest() == df.select(F.sha2(F.lit(""), 256)).first()[0]
