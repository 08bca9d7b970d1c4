"""Running sums and exact quantiles over values of any distribution.

A running sum needs a global order. Instead of sorting a whole group in one task, the
distinct values are cut into chunks at approximate quantiles: each chunk is summed and
sorted on its own, and only one row per chunk carries the offsets. Which quantiles are
taken decides the balance of the work, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.runtime import materialize

# Chunks of a table: one per so many of its rows, but not fewer than a few.
CHUNK_ROWS, FEWEST_CHUNKS = 1_000_000, 16
ACCURACY = 10_000
_ALL = "_all"


def running_sums(
    distinct_values: DataFrame,
    groups: Sequence[str],
    value: str,
    measures: Sequence[str],
    chunks: int | None = None,
    previous: Sequence[str] = (),
) -> DataFrame:
    """Add ``<m>_before`` (sum over smaller values) and ``<m>_total`` for every measure.

    Columns in ``previous`` also get ``<c>_previous``, their value in the row of the next smaller
    value of the group (null in the first row); a chunk's first row takes it from the chunk before.

    ``distinct_values`` has one row per (groups, value) with a non-null value. Groups
    are few (features, pages, labels); values per group may be as many as there are rows.
    The number of chunks grows with the rows; it never changes a result.
    """
    keys = list(groups) or [_ALL]
    source = distinct_values if groups else distinct_values.withColumn(_ALL, F.lit(0))
    # Written once: the cut points, chunk totals and rows below must see one table.
    table = materialize(source, "running")
    chunks = chunks or max(FEWEST_CHUNKS, -(-table.count() // CHUNK_ROWS))
    shares = [i / chunks for i in range(1, chunks)]
    cuts = materialize(
        table.groupBy(*keys).agg(
            F.array_distinct(F.percentile_approx(value, shares, ACCURACY)).alias("cuts"),
            *[F.sum(m).alias(f"{m}_total") for m in measures],
        ),
        "cuts",
    )
    chunk = F.size(F.filter("cuts", lambda cut: cut < F.col(value)))
    chunked = table.join(cuts, keys).withColumn("chunk", chunk).drop("cuts")
    earlier = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    in_order = Window.partitionBy(*keys).orderBy("chunk")
    offsets = (
        chunked.groupBy(*keys, "chunk")
        .agg(*[F.sum(m).alias(m) for m in measures], *[F.max_by(c, value).alias(f"{c}_last") for c in previous])
        .select(
            *keys, "chunk", *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_offset") for m in measures],
            *[F.lag(f"{c}_last").over(in_order).alias(f"{c}_border") for c in previous],
        )
    )
    smaller = (
        Window.partitionBy(*keys, "chunk").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    by_value = Window.partitionBy(*keys, "chunk").orderBy(value)
    added = {f"{m}_before": F.col(f"{m}_offset") + F.coalesce(F.sum(m).over(smaller), F.lit(0)) for m in measures}
    added |= {f"{c}_previous": F.coalesce(F.lag(c).over(by_value), F.col(f"{c}_border")) for c in previous}
    summed = chunked.join(offsets, [*keys, "chunk"]).withColumns(added)
    return summed.drop(_ALL, "chunk", *[f"{m}_offset" for m in measures], *[f"{c}_border" for c in previous])


def _value_at(position: Column, value: str) -> Column:
    """Value at a zero-based position of the sorted rows, as an aggregate."""
    covers = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
    return F.max(F.when(covers, F.col(value)))


def quantile_aggregates(value: str, shares: dict[str, float]) -> list[Column]:
    """Aggregates over ``running_sums`` of ``n`` that pick the neighbours of each quantile."""
    picks = []
    for name, share in shares.items():
        position = (F.col("n_total") - 1) * F.lit(float(share))
        below, above = F.floor(position), F.ceil(position)
        picks += [
            _value_at(below, value).cast("double").alias(f"{name}_low"),
            _value_at(above, value).cast("double").alias(f"{name}_high"),
            F.max(position - below).alias(f"{name}_part"),
        ]
    return picks


def quantile_columns(shares: dict[str, float]) -> list[Column]:
    """Exact quantiles, linear between neighbours, from ``quantile_aggregates``."""
    return [
        (F.col(f"{n}_low") + (F.col(f"{n}_high") - F.col(f"{n}_low")) * F.col(f"{n}_part")).alias(n)
        for n in shares
    ]
