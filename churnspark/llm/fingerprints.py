"""Document fingerprints: a threshold-scaled sketch of word shingles (operator 4).

A sketch holds every 31-bit shingle hash below a fixed fraction of the hash range, and the least
one in any case, so that a short text has a sketch too. The share kept does not depend on the
length of the text: sketches of a page and of a book can be compared, the sketch of two texts
together is the union of theirs, and the share of one sketch found in another estimates
containment. Shingles have ``width`` words, fewer if the text has fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.text_columns import word_list
from churnspark.runtime import materialize

HASH_RANGE = 1 << 31
FRACTION = 1 / 8
WIDTH = 5
# Cut points per step of the two-step search in ``_block``.
_FAN = 64


def sketch(text: Column, fraction: float = FRACTION, width: int = WIDTH) -> Column:
    """Ascending array of the shingle hashes kept; empty for a text without words."""
    words = word_list(text)

    def hashes(found: Column) -> Column:
        count = F.size(found)

        def at(place: Column) -> Column:
            return F.xxhash64(*[F.get(found, place + i) for i in range(width)]).bitwiseAND(HASH_RANGE - 1)

        places = F.sequence(F.lit(0), F.greatest(count - width, F.lit(0)))
        return F.when(count > 0, F.transform(places, at)).otherwise(F.array().cast("array<bigint>"))

    def kept(all_hashes: Column) -> Column:
        low = F.filter(all_hashes, lambda h: h < int(HASH_RANGE * fraction))
        least = F.when(F.size(all_hashes) > 0, F.array(F.array_min(all_hashes)))
        return F.when((F.size(low) > 0) | (F.size(all_hashes) == 0), low).otherwise(least)

    # transform() over one element names a value, so that it is computed once.
    found = F.transform(F.array(words), hashes)
    return F.array_sort(F.array_distinct(F.get(F.transform(found, kept), F.lit(0)).cast("array<int>")))


def merged(left: Column, right: Column) -> Column:
    """The sketch of both texts together."""
    return F.array_sort(F.array_union(left, right))


def resemblance(left: Column, right: Column) -> Column:
    """Estimated share of common shingles among all of two texts; 1 for two empty sketches."""
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def containment(inner: Column, outer: Column) -> Column:
    """Estimated share of the shingles of ``inner`` that ``outer`` has too; 1 for an empty sketch."""
    size = F.size(inner)
    return F.when(size == 0, 1.0).otherwise(F.size(F.array_intersect(inner, outer)) / size)


def as_text(values: Column) -> Column:
    """Eight hex digits per hash."""
    return F.array_join(F.transform(values, lambda h: F.lpad(F.hex(h), 8, "0")), "")


def _block(identifier: Column, starts: list) -> Column:
    """Number of cut points at or below an id: first the group of cut points, then within it."""
    if not starts:
        return F.lit(0)
    rows = [starts[i : i + _FAN] for i in range(0, len(starts), _FAN)]
    heads = F.array(*[F.lit(r[0]) for r in rows])
    nested = F.array(*[F.array(*[F.lit(x) for x in r]) for r in rows])
    row = F.size(F.filter(heads, lambda x: x <= identifier))
    inner = F.size(F.filter(F.get(nested, row - 1), lambda x: x <= identifier))
    return F.when(identifier.isNull(), len(starts)).when(row == 0, 0).otherwise((row - 1) * _FAN + inner)


def with_next_text(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """``docs`` (id, text) with ``next_text``: that of the next id, after the last that of the first.

    Ids are cut into ranges of about equal row counts; each range also gets a copy of the first
    row of the following one (the last range: of the first one), so texts are shuffled once and a
    row finds its successor in its own range. Equal ids follow each other by text, ids that are
    null come last.
    """
    # More ranges than partitions, as ranges are dealt to partitions by a hash.
    count = blocks or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("id").where("id is not null")
    ranged = materialize(ids.repartitionByRange(count, "id").withColumn("part", F.spark_partition_id()), "ids")
    starts = sorted(r[0] for r in ranged.groupBy("part").agg(F.min("id")).select("min(id)").collect())
    placed = docs.withColumn("block", _block(F.col("id"), starts))
    if starts:
        before = F.when(F.col("block") == 1, len(starts)).otherwise(F.col("block") - 1)
        own = F.struct(F.col("block").alias("block"), F.lit(False).alias("extra"))
        extra = F.struct(before.alias("block"), F.lit(True).alias("extra"))
        heads = F.get(F.array(*[F.lit(x) for x in starts]), F.col("block") - 1) == F.col("id")
        copies = F.when(heads, F.array(own, extra)).otherwise(F.array(own))
        placed = placed.withColumn("place", F.explode(copies)).select("id", "text", "place.block", "place.extra")
    else:
        placed = placed.withColumn("extra", F.lit(False))
    order = Window.partitionBy("block").orderBy("extra", F.asc_nulls_last("id"), "text")
    following = F.coalesce(F.lead("text").over(order), F.col("text"))
    return placed.select("id", "text", "extra", "block", following.alias("next_text"))


def edited_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION, width: int = WIDTH
) -> DataFrame:
    """Each text, an edited one, their sketches and likenesses.

    The edited text has the last half of the code points (rounded down) replaced by the first as
    many (or all) of the next document. Columns: id, n_chars, edited_text, sketch, edited_sketch,
    near_edited, near_next (resemblance to the edited text and to the next document).

    A null text is empty; an empty text, or one without words, has an empty sketch, which
    resembles another empty one fully and all others not at all. Equal texts have equal sketches.
    Repeated ids follow each other by text, null ids come last; the only row of a table follows
    itself; an empty table gives an empty result. Other columns are not read.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    joined = with_next_text(plain)
    joined = joined.withColumn("sketch", sketch(F.col("text"), fraction, width))
    order = Window.partitionBy("block").orderBy("extra", F.asc_nulls_last("id"), "text")
    joined = joined.withColumn("next_sketch", F.coalesce(F.lead("sketch").over(order), F.col("sketch"))).where("not extra")
    count = F.char_length("text")
    half = F.floor(count / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), count - half), F.substring(F.col("next_text"), F.lit(1), half))
    joined = joined.select(
        "id", count.cast("long").alias("n_chars"), edited.alias("edited_text"), "sketch",
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    ).withColumn("edited_sketch", sketch(F.col("edited_text"), fraction, width))
    return joined.select(
        F.col("id").alias(id_col), "n_chars", "edited_text", "sketch", "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), "near_next",
    )
