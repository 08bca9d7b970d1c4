"""Train/test split, folds and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.schema import ID_COLUMN, LABEL_COLUMN

CHUNK_DIGITS = 3  # 4096 chunks of equal expected size


def _digest(id_column: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f"#{seed}")))


def in_train(train_share: float, seed: int, id_column: str = ID_COLUMN) -> Column:
    """True for about ``train_share`` of the ids: a hash in order of its hex text.

    Depends on id and seed only, so neither partitioning nor row order matters. A share of 1
    or more takes every id.
    """
    if train_share >= 1:
        return F.lit(True)
    limit = format(int(train_share * 2**32), "08x")
    return F.substring(_digest(id_column, seed), 1, 8) < limit


def fold_number(folds: int, seed: int, id_column: str = ID_COLUMN) -> Column:
    """Fold 0..folds-1 of an id, from the same kind of hash."""
    number = F.conv(F.substring(_digest(id_column, seed), 9, 8), 16, 10).cast("long")
    return F.pmod(number, F.lit(folds)).cast("int")


def with_split(
    rows: DataFrame,
    train_share: float = 0.8,
    seed: int = 42,
    label: str = LABEL_COLUMN,
    id_column: str = ID_COLUMN,
    exact: bool = False,
) -> DataFrame:
    """Add ``is_train``; every label gets the share in expectation, or exactly on request.

    The default needs no shuffle. ``exact`` ranks the ids of a label by their hash:
    hash prefixes split a label into even chunks, so no task sees a whole label.
    """
    if not exact:
        return rows.withColumn("is_train", in_train(train_share, seed, id_column))
    ranked = _ranked(rows, seed, label, id_column)
    chosen = F.col("_rank") <= F.round(F.col("_total") * F.lit(float(train_share)))
    return ranked.select(*rows.columns, chosen.alias("is_train"))


def _ranked(rows: DataFrame, seed: int, label: str, id_column: str) -> DataFrame:
    """Rows with their place (from 1) by hash within their label, and the size of the label."""
    hashed = rows.withColumn("_hash", _digest(id_column, seed)).withColumn(
        "_chunk", F.substring("_hash", 1, CHUNK_DIGITS)
    )
    by_label = Window.partitionBy(label)
    earlier = by_label.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        hashed.groupBy(label, "_chunk")
        .agg(F.count("*").alias("_n"))
        .select(
            label,
            "_chunk",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(by_label).alias("_total"),
        )
    )
    in_chunk = Window.partitionBy(label, "_chunk").orderBy("_hash", id_column)
    return hashed.join(chunks, [label, "_chunk"]).withColumn("_rank", F.col("_before") + F.row_number().over(in_chunk))


def with_folds(
    rows: DataFrame, folds: int, seed: int = 42, label: str = LABEL_COLUMN, id_column: str = ID_COLUMN
) -> DataFrame:
    """Add ``fold`` 0..folds-1; the folds of a label differ in size by one row at most."""
    place = F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")
    return _ranked(rows, seed, label, id_column).select(*rows.columns, place.alias("fold"))


def split(rows: DataFrame, train_share: float = 0.8, seed: int = 42, **options) -> tuple[DataFrame, DataFrame]:
    """(train, test) of ``with_split``."""
    marked = with_split(rows, train_share, seed, **options)
    return (
        marked.where(F.col("is_train")).drop("is_train"),
        marked.where(~F.col("is_train")).drop("is_train"),
    )


def class_weights(rows: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """Balanced weight n / (classes * count) per label, and both positive ratios.

    ``ratio_of_weights`` is w0 / w1; ``balanced_ratio`` is n0 / n1, the factor that
    balances the positive class.
    """
    counted = rows.groupBy(label).agg(F.count("*").alias("n"))
    whole = counted.agg(
        F.struct(
            F.sum("n").alias("total"),
            F.count("*").alias("classes"),
            F.sum(F.when(F.col(label) == 0, F.col("n"))).alias("n0"),
            F.sum(F.when(F.col(label) == 1, F.col("n"))).alias("n1"),
        ).alias("whole")
    ).scalar()
    return counted.withColumn("whole", whole).select(
        label,
        "n",
        (F.col("whole.total") / (F.col("whole.classes") * F.col("n"))).alias("weight"),
        F.try_divide("whole.n1", "whole.n0").alias("ratio_of_weights"),
        F.try_divide("whole.n0", "whole.n1").alias("balanced_ratio"),
    )


def with_class_weight(rows: DataFrame, label: str = LABEL_COLUMN, column: str = "weight") -> DataFrame:
    """Attach the balanced weight of each row's label (one lookup row per class)."""
    weights = class_weights(rows, label).select(label, F.col("weight").alias(column))
    return rows.join(F.broadcast(weights), label)
