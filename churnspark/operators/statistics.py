"""Tests and correlations over users and features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions.tails import chi_squared_p_value, normal_p_value, rank_sum_p_value
from churnspark.operators.profile import long_features
from churnspark.operators.running import running_sums
from churnspark.runtime import materialize


def _with_margins(table: DataFrame, row: str, column: str, n: str) -> DataFrame:
    """Cells with known row and column value, plus ``row_sum`` and ``column_sum``."""
    cells = materialize(table.where(F.col(row).isNotNull() & F.col(column).isNotNull()), "cells")
    rows = cells.groupBy(row).agg(F.sum(n).alias("row_sum"))
    columns = cells.groupBy(column).agg(F.sum(n).alias("column_sum"))
    return cells.join(rows, row).join(columns, column)


def chi_squared(table: DataFrame, row: str, column: str, n: str = "n", yates: str | bool = "auto") -> DataFrame:
    """Independence test of a long contingency table: statistic, dof, p-value.

    Cells that do not occur need no row: with margins R and C the sum over all cells of
    (O - E)^2 / E is N * (sum O^2 / (R C) - 1), and in a 2x2 table every |O - E| is equal.
    ``yates='auto'`` corrects 2x2 tables only. Rows with a null row or column value are
    left out, as in a cross-tabulation.
    """
    observed = _with_margins(table, row, column, n)
    o, r, c = F.col(n), F.col("row_sum").cast("double"), F.col("column_sum").cast("double")
    summary = observed.agg(
        F.sum(o).alias("total"),
        F.count_distinct(row).alias("n_rows"),
        F.count_distinct(column).alias("n_columns"),
        F.sum(o * o / (r * c)).alias("ratio"),
        # The cells of a row add up to its margin, so these are the sums of 1/R and 1/C.
        F.sum(o / (r * r)).alias("inverse_rows"),
        F.sum(o / (c * c)).alias("inverse_columns"),
    )
    total = F.col("total")
    plain = F.greatest(total * (F.col("ratio") - 1), F.lit(0.0))
    inverse_expected = total * F.col("inverse_rows") * F.col("inverse_columns")
    deviation = F.sqrt(plain / inverse_expected)
    lowered = deviation - F.least(F.lit(0.5), deviation)
    dof = (F.col("n_rows") - 1) * (F.col("n_columns") - 1)
    corrected = {"auto": dof == 1, True: dof == 1, False: F.lit(False)}[yates]
    statistic = F.when(dof == 0, 0.0).when(corrected, lowered * lowered * inverse_expected).otherwise(plain)
    return summary.select(
        total.alias("n"), dof.alias("dof"), statistic.alias("chi2")
    ).withColumn("p_value", F.when(F.col("dof") == 0, 1.0).otherwise(chi_squared_p_value("chi2", "dof")))


def expected_counts(table: DataFrame, row: str, column: str, n: str = "n") -> DataFrame:
    """Observed cells with the count expected under independence."""
    observed = _with_margins(table, row, column, n)
    total = observed.agg(F.sum(n)).scalar()
    expected = F.col("row_sum").cast("double") * F.col("column_sum") / total
    return observed.select(row, column, n, expected.alias("expected"))


# The exact law of U is used up to these sizes: of the smaller sample, and of all values of U.
EXACT_SAMPLE, EXACT_VALUES = 8, 10_000


def rank_tests(
    values: DataFrame,
    groups: Sequence[str],
    value: str = "value",
    label: str = "churn",
    alpha: float = 0.05,
    method: str = "normal",
) -> DataFrame:
    """Two-sided Mann-Whitney U per group, class 0 against class 1.

    Equal values are counted per group first; the rank of a tie group is its mid-rank from a
    running sum. ``normal``: normal approximation with tie correction and continuity 0.5.
    ``auto``: the exact law of U where no value repeats, the smaller class has at most
    ``EXACT_SAMPLE`` rows and U at most ``EXACT_VALUES`` values; ``method`` says which one was used.
    A group that lacks a class has p = 1. Null and NaN values are left out.
    """
    if method not in ("normal", "auto"):
        raise ValueError(f"method must be normal or auto, not {method}")
    known = values.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counted = known.groupBy(*groups, value).agg(F.count("*").alias("n"), F.count_if(F.col(label) == 0).alias("n0"))
    ranked = running_sums(counted, groups, value, ["n", "n0"])
    ties = F.col("n").cast("double")
    summed = ranked.groupBy(*groups).agg(
        F.max("n_total").cast("double").alias("n"),
        F.max("n0_total").cast("double").alias("n0"),
        F.sum(F.col("n0") * (F.col("n_before") + (F.col("n") + 1) / 2)).alias("rank_sum"),
        F.sum(ties * ties * ties - ties).alias("tie_sum"),
    )
    n, n0 = F.col("n"), F.col("n0")
    n1 = n - n0
    u = F.col("rank_sum") - n0 * (n0 + 1) / 2
    spread = F.sqrt(n0 * n1 / 12 * ((n + 1) - F.try_divide(F.col("tie_sum"), n * (n - 1))))
    above = F.greatest(F.col("u"), n0 * n1 - F.col("u")) - n0 * n1 / 2 - 0.5
    # Within the continuity correction of the centre, or all values equal: p is 1.
    normal = F.when((F.col("z") < 0) | (F.col("spread") == 0), 1.0).otherwise(normal_p_value("z"))
    small = (F.least(n0, n1).between(1, EXACT_SAMPLE)) & (n0 * n1 <= EXACT_VALUES) & (F.col("tie_sum") == 0)
    exact = small if method == "auto" else F.lit(False)
    p_value = normal
    if method == "auto":
        # Null arguments where the exact law does not apply, so that nothing is counted there.
        p_value = F.coalesce(rank_sum_p_value(F.when(small, F.col("u")), n0, n1), normal)
    tested = (
        summed.withColumns({"u": u, "spread": spread})
        .withColumn("z", F.try_divide(above, F.col("spread")))
        .withColumn("p_value", p_value)
    )
    return tested.select(
        *groups, n0.cast("long").alias("n0"), n1.cast("long").alias("n1"), "u", "z", "p_value",
        (F.col("p_value") < alpha).alias("reject"), F.when(exact, "exact").otherwise("normal").alias("method"),
    )


def mann_whitney(
    features: DataFrame, columns: Sequence[str], label: str = "churn", alpha: float = 0.05, method: str = "normal"
) -> DataFrame:
    """``rank_tests`` per feature."""
    tested = rank_tests(long_features(features, columns, [label]), ["feature"], "value", label, alpha, method)
    return tested if method == "auto" else tested.drop("method")


def _pair_sums(names: Sequence[str], means: Sequence[float]):
    """Rows (i, j, n, x, y, xx, yy, xy): what a partition adds to the sums of each pair, numbers less their means."""
    size = len(names)
    one, two = np.tril_indices(size, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, size, size))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
            known = ~np.isnan(x)
            x = np.where(known, x - means, 0.0)
            known = known.astype(np.float64)
            # Sums of one column over the rows where the other is known too.
            single, square = x.T @ known, (x * x).T @ known
            sums += np.stack([known.T @ known, single, single.T, square, square.T, x.T @ x])
        columns = [pa.array(one.astype(np.int32)), pa.array(two.astype(np.int32)), *[pa.array(s[one, two]) for s in sums]]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    return run


def feature_correlation(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strict lower triangle of the Pearson matrix: (a, b, corr), b before a in ``columns``.

    Every pair is correlated over the rows where both numbers are known; NaN counts as null.
    One pass finds means and constant columns, a second adds up all pairs at once: a
    partition hands on one row per pair. A pair with a constant column, or constant over its
    common rows, gives null.
    """
    names = list(columns)
    numbers = {c: F.col(c).cast("double") for c in names}
    plain = features.select(*[F.when(~F.isnan(n), n).alias(c) for c, n in numbers.items()])
    spread = plain.agg(
        *[F.avg(c).alias(f"mean_{i}") for i, c in enumerate(names)],
        *[(F.min(c) < F.max(c)).alias(f"varies_{i}") for i, c in enumerate(names)],
    ).first()
    means = [spread[f"mean_{i}"] or 0.0 for i in range(len(names))]
    varies = [bool(spread[f"varies_{i}"]) for i in range(len(names))]
    sums = ["n", "x", "y", "xx", "yy", "xy"]
    schema = "i int, j int, " + ", ".join(f"{c} double" for c in sums)
    pairs = plain.mapInArrow(_pair_sums(names, np.array(means)), schema)
    pairs = pairs.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])
    x, y, n = F.col("x"), F.col("y"), F.col("n")
    spread_x, spread_y = F.col("xx") - F.try_divide(x * x, n), F.col("yy") - F.try_divide(y * y, n)
    both = F.col("xy") - F.try_divide(x * y, n)
    # Sums of squares this small against what they came from are rounding, not variance.
    real = (spread_x > 1e-14 * F.col("xx")) & (spread_y > 1e-14 * F.col("yy"))
    vary = F.array(*[F.lit(v) for v in varies])
    usable = F.get(vary, F.col("i")) & F.get(vary, F.col("j")) & real
    name = F.array(*[F.lit(c) for c in names])
    corr = F.when(usable, F.least(F.greatest(both / F.sqrt(spread_x * spread_y), F.lit(-1.0)), F.lit(1.0)))
    return pairs.select(F.get(name, F.col("i")).alias("a"), F.get(name, F.col("j")).alias("b"), corr.alias("corr"))
