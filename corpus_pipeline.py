"""From raw documents to packed training sequences, in stages that are each written and read again.

A stage takes the session, the documents its predecessor kept, and the folder of the tables.
All but the last return the columns of ``documents``, in their order and whatever further ones there
are, also some whose names clash. Rows may repeat an id or have none; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.llm import decontaminate, language
from bankmart.llm.columns import numbered, table
from bankmart.llm.joins import small
from bankmart.llm.line_dedup import line_dedup
from bankmart.llm.near_dedup import near_dedup
from bankmart.llm.packing import pack
from bankmart.store import written

# Language models, near copies and training sequences cannot be expressed in SQL.
ORACLE_SQL = None

BYTES_PER_ID = 16


def _by_row(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` by position with a number for each row, ``row``; and ``row``, ``id``, ``text``. Ids may repeat or be null."""
    plain, (doc, text) = numbered(docs, "doc_id", "text")
    rows = written(plain.withColumn("row", F.monotonically_increasing_id()), "rows")
    return rows, rows.select("row", F.col(doc).alias("id"), F.col(text).alias("text"))


def _without(rows: DataFrame, gone: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose number is not among ``gone``."""
    gone = small(written(gone.toDF("gone"), "gone"), BYTES_PER_ID)
    return rows.join(gone, rows["row"] == gone["gone"], "left_anti").drop("row").toDF(*columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Those that the classifier rejects go, also null and empty texts and those without a letter."""
    found = language.identify(docs, language.train(docs))
    plain = found.toDF(*[f"c{i}" for i in range(len(found.columns))])
    kept = plain.where(~F.col(plain.columns[-1]))
    return kept.select(*plain.columns[: len(docs.columns)]).toDF(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the lines that an earlier one holds, and its length anew.

    A null text comes out empty. Rows of one id are one document, those without an id one that comes last.
    """
    kept = line_dedup(docs)
    plain = kept.toDF(*[f"c{i}" for i in range(len(kept.columns))])
    columns = [F.col(c) for c in plain.columns[: len(docs.columns)]]
    if "n_chars" in docs.columns:
        text = F.col(f"c{docs.columns.index('text')}")
        columns[docs.columns.index("n_chars")] = F.length(text).cast("long")
    return plain.select(*columns).toDF(*docs.columns)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id, or else the first without one.

    Rows are compared each for itself. Those of a class that repeat the id that stays are of that document, and stay.
    A row with neither id nor text is a copy of nothing.
    """
    rows, own = _by_row(docs)
    others = written(near_dedup(own.where("id IS NOT NULL OR text IS NOT NULL").select(F.col("row").alias("doc_id"), "text")).where("doc_id <> class_id").select("doc_id", "class_id"), "copies")
    firsts = others.select(F.col("class_id").alias("doc_id"), "class_id").distinct()
    members = small(written(others.unionByName(firsts).toDF("member", "class"), "members"), 2 * BYTES_PER_ID)
    members = written(own.select("row", "id").join(members, F.col("row") == F.col("member")).select("row", "id", "class"), "classes")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))
    kept = small(written(members.groupBy("class").agg(F.min(order).alias("kept")), "kept"), 2 * BYTES_PER_ID)
    gone = members.join(kept, "class").where("row <> kept.row AND NOT coalesce(id = kept.id, false)").select("row")
    return _without(rows, gone, docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, row by row. Null and empty texts hold none, and an empty benchmark takes none away."""
    rows, own = _by_row(docs)
    found = decontaminate.contaminated(own.select(F.col("row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _without(rows, found.select("doc_id").distinct(), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of power-of-two length, row by row: a null or empty text is the end token alone."""
    return pack(docs)


STAGES = [
    ("language", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each_class),
    ("decontamination", without_benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
