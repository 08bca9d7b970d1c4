"""Mixing sources to target sizes by nested hash thresholds (operator 9).

Every document has a fixed 60-bit hash of its id. A source takes each document as often as its
target holds the whole source, and once more those whose hash lies below a threshold. The
threshold is found from histograms: sizes are summed by source and hash bucket, the bucket in
which the budget runs out is found by a running sum over at most ``BUCKETS`` rows of the source,
and only the documents of that bucket are divided again by their next hash bits. Nothing is
sorted, and a larger budget always takes a superset of what a smaller one takes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.text_columns import word_count
from churnspark.runtime import materialize

HASH_BITS, LEVEL_BITS = 60, 12
BUCKETS = 1 << LEVEL_BITS


def id_hash(identifier: Column) -> Column:
    """The first 60 bits of the MD5 of the id as text; a null id counts as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(identifier.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def ranked_sources(sources: DataFrame) -> DataFrame:
    """Sources with their place in code point order from 0, a null last.

    Sources are range-partitioned and numbered within their partition; only the row count of
    each partition goes through the driver.
    """
    keyed = sources.select(F.col("source").isNull().cast("int").alias("unnamed"), "*")
    ranged = keyed.repartitionByRange("unnamed", F.col("source").cast("binary"))
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id()), "sources")
    offset, offsets = 0, {}
    for row in ranged.groupBy("part").count().orderBy("part").collect():
        offsets[row["part"]] = offset
        offset += row["count"]
    order = Window.partitionBy("part").orderBy("unnamed", F.col("source").cast("binary"))
    start = F.element_at(F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair]), F.col("part"))
    if not offsets:
        start = F.lit(0)
    place = F.row_number().over(order) - 1 + start
    return ranged.withColumn("place", place).drop("unnamed", "part")


def water_fill(sources: DataFrame, total: float, limit: float) -> DataFrame:
    """``sources`` (with ``weight``, ``source_size``) with ``target``: shares of ``total`` by weight,
    none above ``limit`` times the source's size, the excess shared again until none is above."""
    cap = F.col("source_size") * F.lit(limit)
    level = 0.0
    full = -1
    while True:
        above = F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.sum(F.when(above, 1).otherwise(0)).alias("full"),
            F.sum(F.when(above, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not row["weight"] or row["full"] == full:
            break
        full = row["full"]
        level = (total - row["held"]) / row["weight"]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))


def _bucket(level: int) -> Column:
    """The hash bits of one level."""
    return F.shiftright("hash", HASH_BITS - LEVEL_BITS * (level + 1)).bitwiseAND(BUCKETS - 1)


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, below): documents with ``hash < below`` sum up to nearly ``budget``.

    ``sized`` has source, hash and size, ``budgets`` source and budget. The sum differs from the
    budget by at most half of the documents that share the hash at the threshold.
    """
    open_ranges = budgets.select("source", F.col("budget").alias("left"), F.lit(0).cast("long").alias("below"))
    levels = HASH_BITS // LEVEL_BITS
    for level in range(levels):
        width = 1 << (HASH_BITS - LEVEL_BITS * (level + 1))
        inside = sized if level == 0 else _inside(sized, open_ranges, width * BUCKETS)
        sums = inside.groupBy("source", _bucket(level).alias("bucket")).agg(F.sum("size").alias("size"))
        running = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
        fits = _same_source(sums.withColumn("sum", running), open_ranges, "inner").where(F.col("sum") > F.col("left"))
        # The first bucket that does not fit whole; a source without one takes all it has left.
        edge = fits.groupBy("source").agg(F.min(F.struct("bucket", "sum", "size")).alias("edge"))
        joined = _same_source(open_ranges, edge, "left")
        before = F.col("edge.sum") - F.col("edge.size")
        open_ranges = joined.select(
            "source",
            (F.col("left") - F.coalesce(before, F.lit(0))).alias("left"),
            (F.col("below") + F.coalesce(F.col("edge.bucket"), F.lit(BUCKETS)) * width).alias("below"),
            F.col("edge.size").alias("edge_size"),
        )
        open_ranges = materialize(open_ranges, "thresholds")
        settled = open_ranges.where("edge_size is null").select("source", "below")
        done = settled if level == 0 else done.unionByName(settled)
        open_ranges = open_ranges.where("edge_size is not null")
    # At the last level the edge is one hash: take it if that comes nearer to the budget.
    nearer = F.col("edge_size") - F.col("left") < F.col("left")
    last = open_ranges.select("source", (F.col("below") + nearer.cast("long")).alias("below"))
    return done.unionByName(last)


def _same_source(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    renamed = right.withColumnRenamed("source", "__source")
    return left.join(renamed, F.col("source").eqNullSafe(F.col("__source")), how).drop("__source")


def _inside(sized: DataFrame, open_ranges: DataFrame, width: int) -> DataFrame:
    bounds = open_ranges.select("source", F.col("below").alias("from"))
    joined = _same_source(sized, bounds, "inner")
    return joined.where((F.col("hash") >= F.col("from")) & (F.col("hash") < F.col("from") + width))


def sized_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source, size in words and hash of every row."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        id_hash(F.col(id_col)).alias("hash"),
    )


def mix_plan(sized: DataFrame, share: float = 1.5, limit: float = 2.0, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """One stored row per source: source, source_size, target, whole (full takes), below (hashes that are taken once more).

    ``sized`` is a stored table of ``sized_rows``.
    """
    totals = ranked_sources(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    totals = materialize(totals.withColumn("weight", cycle), "totals")
    everything = totals.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    targets = water_fill(totals, share * everything, limit)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long"))
    targets = targets.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = materialize(targets, "targets")
    cuts = materialize(thresholds(sized, targets), "cuts")
    plan = _same_source(targets.select("source", "source_size", "target", "whole"), cuts, "left")
    return materialize(plan, "plan")


def planned_copies(hash_: Column, limit: float = 2.0) -> Column:
    """How often a row with this hash is taken, from the columns of its source's plan."""
    # A document without words costs nothing and would always fit once more.
    return F.least(F.col("whole") + (hash_ < F.col("below")).cast("long"), F.lit(math.ceil(limit)))


def mixed_rows(docs: DataFrame, plan: DataFrame, limit: float = 2.0, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the plan takes it. Only the plan, a row per source, is joined."""
    names = [f"__mix_{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    own = dict(zip(docs.columns, names, strict=True))
    joined = plain.withColumn("source", F.col(own[source_col]))
    joined = _same_source(joined, plan.select("source", "whole", "below"), "inner")
    copies = planned_copies(id_hash(F.col(own[id_col])), limit).cast("int")
    repeated = joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies)))
    return repeated.select(*[F.col(n).alias(c) for c, n in own.items()])


def mixture(
    docs: DataFrame,
    share: float = 1.5,
    limit: float = 2.0,
    weights: tuple[int, ...] = (5, 2, 1),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken.

    The size of a document is its number of words. Sources in code point order, a null last, get
    ``weights`` in turn and share ``share`` times all sizes, none more than ``limit`` times its
    own. ``copies`` says how often the mix takes a document, ``taken`` is ``copies * size``.

    A null or empty text has size 0. Rows that repeat an id are taken alike. A null id is an id
    of its own. An empty table gives an empty result; other columns are not read. Runs agree, as
    hashes depend on ids only.
    """
    sized = materialize(sized_rows(docs, id_col, text_col, source_col), "sized")
    joined = _same_source(sized, mix_plan(sized, share, limit, weights), "left")
    copies = planned_copies(F.col("hash"), limit)
    return joined.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )
