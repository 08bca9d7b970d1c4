"""Corpus pipeline: five operators in a row, each on all that the one before has kept.

Every stage is a function of (spark, docs, sf_dir); its result is written and read again as the
next stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.llm import language_id, line_dedup, mixing
from churnspark.llm.near_dedup import near_duplicates
from churnspark.llm.packing import pack_documents
from churnspark.llm.queries import tokenizer_path
from churnspark.runtime import materialize


def _own_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from their own labels.

    A null text, or one without a letter, goes. Rows without id or label are judged like all others,
    repeated rows all alike. Without any label nothing is recognised; an empty table stays empty.
    """
    found = language_id.identify(docs, language_id.train(docs))
    return found.where(~F.col("lang_rejected")).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stay in a later document; all rows stay.

    A line that repeats inside the document that keeps it stays there every time. Rows without id
    count as one document, before all others. A text of which nothing is left is empty.
    """
    changed = line_dedup.dedup_lines(docs)
    return _counted(changed)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates.

    Rows are compared one by one, whatever their ids: two rows of one id with different texts are
    two documents, equal rows are copies, and rows without id take part like all others. The least
    id of a group stays, rows without id come last; of equal ids the least hash of a text, of equal
    texts any one. A text without words is in no group: it stays, also where it repeats.
    """
    row = _own_name(docs, "__row")
    # Written, so that a row has the same number wherever it is read again.
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered, id_col=row).select(F.col(row).alias("number"), "component_id")
    order = numbered.select(
        F.col(row).alias("number"),
        F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.sha2("text", 256), F.col(row)).alias("place"),
    )
    kept = found.join(order, "number").groupBy("component_id").agg(F.min_by("number", "place").alias("number"))
    kept = materialize(kept.select("number"), "kept")
    # Texts are dealt by their number at every size, so that disk grows as the texts do.
    return numbered.join(kept.hint("merge"), F.col(row) == F.col("number"), "left_semi").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources by weights 5, 2, 1 to 150 % of all words.

    Rows without source are a source of their own, the last one. Rows that repeat an id, and all rows
    without id, are taken alike. Texts without words take no part of a target and follow their hash.
    """
    sized = materialize(mixing.sized_rows(docs, "doc_id", "text", "source"), "sized")
    return mixing.mixed_rows(docs, mixing.mix_plan(sized)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows as token pieces in sequences of at most 1024 tokens.

    A null or empty text is the end token alone; repeated rows and rows without id are packed each.
    """
    _, places = pack_documents(docs, tokenizer_path(), end_id=2)
    return places.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, of the changed text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The learned language model and the tokenizer cannot be stated in SQL; tests compare each stage
# with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
