"""Removal of lines that several documents share, as bitmaps per document (operator 1).

The key of a line is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased, held as 96
hash bits. All long lines are range-partitioned by key, each key in shares of bounded size by
document, and sorted within by document (the last first) and position. One pass over that order
marks the first occurrence in each document; counts per key follow from the marks with partial
sums. A key that holds a third of all lines is therefore spread over many shares, and only one
row of each share and task meets the others.

What a document loses is returned as a bitmap without text: ``keep`` maps the number of a block
of 64 lines to 64 bits (1: the line stays). A block that stays whole is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.text_columns import ascii_lower, strip_blanks
from churnspark.runtime import materialize

# Lines per share of a key, on average: what one sort group holds if one key has all lines.
SHARE_ROWS = 500_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keep_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_documents: int = 3,
    share_rows: int = SHARE_ROWS,
) -> DataFrame:
    """One row per document that loses lines: id, text_hash, n_dropped, keep (map of block to bits).

    A line whose key has at least ``min_chars`` code points and occurs in at least
    ``min_documents`` documents stays only in the document with the greatest id, there as often
    as it occurs. A null or empty text has one empty line. Rows that repeat an id are one document
    when documents are counted, and each row gets its own bitmap by its text (``text_hash``). A
    null id comes before all others. Other columns of ``docs``, whatever their names, are not
    read. An empty table gives an empty result.
    """
    split = docs.select(
        F.struct(F.col(id_col).alias("id")).alias("doc"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
        F.posexplode(_lines(F.col(text_col))).alias("position", "line"),
    )
    keyed = split.withColumn("line", strip_blanks(F.col("line"))).where(F.char_length("line") >= min_chars)
    keyed = keyed.withColumn("line", ascii_lower(F.col("line"))).select(
        "doc", "text_hash", "position", F.xxhash64("line").alias("key"), F.hash("line").alias("check")
    )
    keyed = materialize(keyed, "lines")
    shares = max(1, keyed.count() // share_rows)

    key = ["key", "check"]
    ranged = keyed.withColumn("share", F.pmod(F.hash("doc"), F.lit(shares))).repartitionByRange(*key, "share")
    order = Window.partitionBy(*key, "share").orderBy(F.desc("doc"), "position")
    first = ~F.lag("doc").over(order).eqNullSafe(F.col("doc"))
    marked = ranged.withColumn("first", first)
    holders = marked.groupBy(*key).agg(F.sum(F.col("first").cast("int")).alias("n"), F.max("doc").alias("holder"))
    holders = materialize(holders.where(F.col("n") >= min_documents).select(*key, "holder"), "holders")

    lost = keyed.join(holders, key).where(F.col("doc") != F.col("holder"))
    block = F.shiftright("position", 6)
    bits = F.expr("bit_or(shiftleft(1L, position % 64))")
    blocks = lost.groupBy("doc", "text_hash", block.alias("block")).agg(bits.alias("lost"))
    return blocks.groupBy("doc", "text_hash").agg(
        F.sum(F.bit_count("lost")).cast("long").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("block", F.bitwise_not("lost").alias("bits")))).alias("keep"),
    ).select(F.col("doc.id").alias(id_col), "text_hash", "n_dropped", "keep")


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of a text whose bit is set, joined by line ends; all of them for a null bitmap."""

    def stays(_: Column, position: Column) -> Column:
        bits = F.element_at(keep, F.shiftright(position, 6))
        # getbit() takes no column as position, so shift the bit to the lowest place.
        return bits.isNull() | (F.call_function("shiftrightunsigned", bits, position % 64).bitwiseAND(1) == 1)

    whole = F.coalesce(text, F.lit(""))
    return F.when(keep.isNull(), whole).otherwise(F.array_join(F.filter(_lines(text), stays), "\n"))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``__keep`` (map or null) and ``__n_dropped``; all rows and columns stay."""
    own = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    right = bitmaps.select(
        F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"),
        F.col("keep").alias("__keep"), F.col("n_dropped").alias("__n_dropped"),
    )
    joined = docs.join(right, docs[id_col].eqNullSafe(right["__id"]) & (own == right["__hash"]), "left")
    return joined.drop("__id", "__hash").fillna(0, ["__n_dropped"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """``docs`` with repeated lines taken out of the text; see ``line_keep_bitmaps``."""
    marked = with_bitmaps(docs, line_keep_bitmaps(docs, id_col, text_col, **options), id_col, text_col)
    text, keep = F.col(text_col), F.col("__keep")
    changed = F.when(keep.isNull(), text).otherwise(kept_text(text, keep))
    return marked.withColumn(text_col, changed).select(*docs.columns)


def line_count(text: Column) -> Column:
    return F.size(_lines(text)).cast("long")
