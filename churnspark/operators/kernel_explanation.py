"""Contributions of features to any prediction, by weighted least squares over coalitions.

A coalition is a set of features that keep a row's own values while the others take those of
background rows. Its worth is the mean prediction over the background. Contributions are the linear
function of membership that fits the worths best under the Shapley kernel, and they add up to
the prediction minus the mean prediction of the background. As all rows share one design of
coalitions, the normal equations are solved once, and every row's contributions are fixed weighted
sums of its worths: aggregates that combine before their shuffle.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows with an array column "x" -> the same rows with a double column "prediction".
Predict = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Design:
    """Coalitions as rows of 0 and 1, none of them empty or full, and their weights."""

    members: np.ndarray
    weights: np.ndarray

    def solution(self) -> tuple[np.ndarray, np.ndarray]:
        """(matrix, vector): contributions = matrix @ worths + vector * prediction, both less the base."""
        size = self.members.shape[1]
        if size == 1:
            return np.zeros((1, len(self.members))), np.ones(1)
        weighted = self.members.T * self.weights
        inverse = np.linalg.inv(weighted @ self.members)
        ones = inverse.sum(axis=1)
        free = inverse - np.outer(ones, ones) / ones.sum()
        return free @ weighted, ones / ones.sum()


def _kernel(size: int, chosen: int) -> float:
    """Weight of all coalitions of one size together."""
    return (size - 1) / (chosen * (size - chosen))


def coalitions(size: int, most: int = 512, seed: int = 42) -> Design:
    """All coalitions of ``size`` features, or about ``most`` of them with the kernel's weights.

    Sizes are taken whole from the outside in (1 and all but 1, 2 and all but 2, ...) as long as they
    fit. What is left over is drawn from the other sizes in pairs of a set and its complement;
    equal draws add up.
    """
    if size < 1:
        raise ValueError("there is nothing to explain")
    found: dict[tuple[int, ...], float] = {}
    left, open_sizes = most, []
    for small in range(1, size // 2 + 1):
        both = {small, size - small}
        many = sum(comb(size, s) for s in both)
        if not open_sizes and many <= left:
            for s in sorted(both):
                for chosen in combinations(range(size), s):
                    found[chosen] = _kernel(size, s) / comb(size, s)
            left -= many
        else:
            open_sizes.append(small)
    if open_sizes and left >= 2:
        generator = random.Random(seed)
        masses = [sum(_kernel(size, s) for s in {small, size - small}) for small in open_sizes]
        each = sum(masses) / (2 * (left // 2))
        for small in generator.choices(open_sizes, masses, k=left // 2):
            chosen = tuple(sorted(generator.sample(range(size), small)))
            for own in (chosen, tuple(sorted(set(range(size)) - set(chosen)))):
                found[own] = found.get(own, 0.0) + each
    members = np.zeros((len(found), size))
    for i, chosen in enumerate(found):
        members[i, list(chosen)] = 1
    return Design(members, np.array(list(found.values())))


def background_rows(rows: DataFrame, values: Column, most: int = 100, id_column: str = "userId") -> list[list[float]]:
    """The arrays of at most ``most`` rows: those whose ids have the least hashes, the same ones on every run."""
    chosen = rows.select(F.md5(F.col(id_column).cast("string")).alias("hash"), values.alias("x"))
    return [[float(v) for v in r["x"]] for r in chosen.orderBy("hash", "x").limit(most).collect()]


def model_prediction(model, vector: str = "scaled_features") -> Predict:
    """The positive probability of a fitted classifier."""
    from churnspark.operators.training import with_probability

    def run(rows: DataFrame) -> DataFrame:
        return with_probability(model, rows.withColumn(vector, array_to_vector("x")), "prediction")

    return run


def kernel_contributions(
    rows: DataFrame,
    predict: Predict,
    names: Sequence[str],
    values: Column,
    background: Sequence[Sequence[float]],
    most_coalitions: int = 512,
    seed: int = 42,
    keep: Sequence[str] = ("userId",),
) -> DataFrame:
    """(keep, contributions, base_value): a map feature -> contribution per row.

    ``keep`` must tell the rows apart; ``values`` is an array of doubles in the order of ``names``.
    Exact where all 2^n - 2 coalitions fit into ``most_coalitions``, and at any number of
    coalitions for a prediction that is linear in the features. Every row takes
    coalitions x background rows predictions, whose mean is formed before anything is shuffled.
    """
    if not background:
        raise ValueError("there are no background rows")
    size = len(names)
    design = coalitions(size, most_coalitions, seed)
    matrix, vector = design.solution()
    # Constants in the plan, bounded by the two parameters: coalition 0 is the full one.
    masks = [[1.0] * size, *design.members.tolist()]
    mask_table = F.from_json(F.lit(json.dumps(masks)), "array<array<double>>")
    background_table = F.from_json(F.lit(json.dumps([list(map(float, b)) for b in background])), "array<array<double>>")
    own = rows.select(*keep, values.alias("own"))
    spread = own.select("*", F.posexplode(mask_table).alias("coalition", "mask"))
    # The full coalition needs no background.
    others = F.when(F.col("coalition") == 0, F.slice(background_table, 1, 1)).otherwise(background_table)
    mixed = spread.withColumn("other", F.explode(others)).withColumn(
        "x", F.transform(F.arrays_zip("mask", "own", "other"), lambda z: F.when(z["mask"] == 1, z["own"]).otherwise(z["other"]))
    )
    predicted = predict(mixed.select(*keep, "coalition", "x")).select(*keep, "coalition", "prediction")
    base = base_value(rows, predict, background)
    # What a prediction adds to each contribution: of the full coalition whole, else its part of the mean.
    many = len(background)
    shares = np.column_stack([vector, matrix / many]).T
    share_table = F.from_json(F.lit(json.dumps(shares.tolist())), "array<array<double>>")
    # The base enters with the same weights.
    lowered = base * (vector + matrix.sum(axis=1))
    share = F.element_at(share_table, F.col("coalition") + 1)
    sums = predicted.withColumn("share", share).groupBy(*keep).agg(
        *[F.sum(F.col("share")[i] * F.col("prediction")).alias(f"_{i}") for i in range(size)]
    )
    entries = [F.col(f"_{i}") - F.lit(float(lowered[i])) for i in range(size)]
    named = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*entries))
    return sums.select(*keep, named.alias("contributions"), F.lit(base).alias("base_value"))


def base_value(rows: DataFrame, predict: Predict, background: Sequence[Sequence[float]]) -> float:
    """The mean prediction of the background rows."""
    table = rows.sparkSession.createDataFrame([([float(v) for v in b],) for b in background], "x array<double>")
    return float(predict(table).agg(F.avg("prediction")).first()[0])
