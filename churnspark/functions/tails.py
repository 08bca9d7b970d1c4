"""Tail probabilities for one-row test results.

Spark SQL has neither ``erfc`` nor the incomplete gamma function, so these run as
Pandas UDFs on results that are already aggregated to one row per test.
"""

from __future__ import annotations

import math
import sys
from functools import lru_cache

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


# Workers get these small functions by value and need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi_squared_tail(statistic: float, dof: float) -> float:
    """P(X >= statistic) of a chi-squared variable, by adding up two degrees at a time.

    With h = x/2, Q(a+1, h) = Q(a, h) + h^a e^-h / Gamma(a+1), where a = dof/2 begins at
    1/2 (erfc of the root) for odd degrees and at 1 (the exponential) for even ones.
    """
    if statistic <= 0:
        return 1.0
    h = statistic / 2.0
    if int(dof) % 2:
        a, tail = 0.5, math.erfc(math.sqrt(h))
    else:
        a, tail = 1.0, math.exp(-h)
    while a < dof / 2.0:
        tail += math.exp(a * math.log(h) - h - math.lgamma(a + 1.0))
        a += 1.0
    return min(tail, 1.0)


@lru_cache(maxsize=256)
def rank_sum_counts(a: int, b: int) -> tuple[list[int], int]:
    """(ways to reach U or more, for U from 0 to a * b; all ways) for samples of sizes a and b without ties.

    The ways to reach each U are the coefficients of a Gaussian binomial: the product of
    (1 - q^(b + i)) / (1 - q^i) over i from 1 to a, multiplied and divided in place.
    """
    size = a * b + 1
    ways = [1] + [0] * (size - 1)
    for i in range(1, a + 1):
        for u in range(size - 1, b + i - 1, -1):
            ways[u] -= ways[u - b - i]
        for u in range(i, size):
            ways[u] += ways[u - i]
    upward, total = [], 0
    for count in reversed(ways):
        total += count
        upward.append(total)
    return upward[::-1], total


def rank_sum_two_sided(u: float, n0: int, n1: int) -> float:
    """P of a U at least as far from its centre, for samples without ties."""
    upward, total = rank_sum_counts(min(n0, n1), max(n0, n1))
    far = round(max(u, n0 * n1 - u))
    return min(1.0, 2 * upward[far] / total)


@F.pandas_udf(DoubleType())
def rank_sum_p_value(u: pd.Series, n0: pd.Series, n1: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna(x) else rank_sum_two_sided(x, int(a), int(b)) for x, a, b in zip(u, n0, n1)], dtype="float64"
    )


@F.pandas_udf(DoubleType())
def normal_p_value(z: pd.Series) -> pd.Series:
    return z.map(normal_two_sided, na_action="ignore").astype("float64")


@F.pandas_udf(DoubleType())
def chi_squared_p_value(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna(s) or pd.isna(d) or d < 1 else chi_squared_tail(s, d) for s, d in zip(statistic, dof)],
        dtype="float64",
    )
