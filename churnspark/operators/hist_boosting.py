"""Gradient boosting with second-order splits over histograms of binned features.

Features are cut into bins at approximate quantiles; a missing number has a bin of its own. A tree
grows level by level. At each level every partition adds up gradient and Hessian of its rows per
(node, feature, bin), the sums of all partitions meet in one shuffle whose size depends on
nodes, features and bins but not on rows, and the driver picks each node's split by its regularised
gain, sending missing numbers to the side that gains more. Rows keep their bins and their margin
in a stored table, which each round writes anew.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.runtime import materialize

# Relative error of the cut points' ranks is the inverse of this.
ACCURACY = 10_000


@dataclass(frozen=True)
class Node:
    """A split (feature, last bin on the left, side of missing numbers) or, with feature -1, a leaf value."""

    feature: int = -1
    bin: int = -1
    missing_left: bool = True
    left: int = -1
    right: int = -1
    value: float = 0.0


@dataclass
class BoostedTrees:
    """Cut points per feature, starting margin and trees; node 0 is the root of a tree."""

    names: list[str]
    cuts: list[np.ndarray]
    start: float
    trees: list[list[Node]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bin per number: how many cut points are below it; missing numbers one after the last bin."""
        out = np.empty(x.shape, np.int32)
        for j, cuts in enumerate(self.cuts):
            out[:, j] = np.where(np.isnan(x[:, j]), len(cuts) + 1, np.searchsorted(cuts, x[:, j], side="left"))
        return out

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.start + sum((leaf_values(tree, bins, self.cuts) for tree in self.trees), np.zeros(len(bins)))


def places(tree: Sequence[Node], bins: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The leaf that each row reaches."""
    at = np.zeros(len(bins), np.int64)
    feature = np.array([n.feature for n in tree])
    limit, left, right = (np.array([getattr(n, k) for n in tree]) for k in ("bin", "left", "right"))
    missing_left = np.array([n.missing_left for n in tree])
    last = np.array([len(c) + 1 for c in cuts])
    moving = np.flatnonzero(feature[at] >= 0)
    while len(moving):
        node = at[moving]
        own = bins[moving, feature[node]]
        goes_left = np.where(own == last[feature[node]], missing_left[node], own <= limit[node])
        at[moving] = np.where(goes_left, left[node], right[node])
        moving = moving[feature[at[moving]] >= 0]
    return at


def leaf_values(tree: Sequence[Node], bins: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    return np.array([n.value for n in tree])[places(tree, bins, cuts)]


def best_split(
    gradient: np.ndarray, hessian: np.ndarray, cuts: Sequence[np.ndarray], penalty: float, least_gain: float, least_hessian: float
) -> tuple[float, int, int, bool] | None:
    """(gain, feature, bin, missing left) of a node from sums per feature and bin; of equal gains the first."""
    best = None
    for j, cut in enumerate(cuts):
        many = len(cut) + 1
        g, h = gradient[j], hessian[j]
        total_g, total_h = g[: many + 1].sum(), h[: many + 1].sum()
        whole = total_g * total_g / (total_h + penalty)
        below_g, below_h = np.cumsum(g[: many - 1]), np.cumsum(h[: many - 1])
        for missing_left in (True, False):
            left_g = below_g + (g[many] if missing_left else 0.0)
            left_h = below_h + (h[many] if missing_left else 0.0)
            right_g, right_h = total_g - left_g, total_h - left_h
            gain = (left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - whole) / 2
            gain = np.where((left_h >= least_hessian) & (right_h >= least_hessian), gain, -np.inf)
            if len(gain) and gain.max() > (best[0] if best else least_gain) + 1e-12:
                best = float(gain.max()), j, int(gain.argmax()), missing_left
    return best


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margin))


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _histograms(model: BoostedTrees, tree: list[Node], open_nodes: list[int], width: int):
    """Rows (slot, g, h): sums of one partition, slot = (open node x features + feature) x bins + bin."""
    bins_wide = max(len(c) for c in model.cuts) + 2
    slot_of = np.full(len(tree), -1)
    slot_of[open_nodes] = np.arange(len(open_nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(open_nodes) * width * bins_wide
        g_sums, h_sums = np.zeros(size), np.zeros(size)
        for batch in batches:
            bins = _matrix(batch.column(0), width, np.int64)
            label, weight, margin = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            node = slot_of[places(tree, bins, model.cuts)]
            here = node >= 0
            p = _sigmoid(margin[here])
            g, h = weight[here] * (p - label[here]), weight[here] * p * (1 - p)
            slots = (node[here, None] * width + np.arange(width)) * bins_wide + bins[here]
            g_sums += np.bincount(slots.ravel(), np.repeat(g, width), size)
            h_sums += np.bincount(slots.ravel(), np.repeat(h, width), size)
        used = np.flatnonzero(h_sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(g_sums[used]), pa.array(h_sums[used])], names=["slot", "g", "h"]
        )

    return run


def _moved(model: BoostedTrees, tree: list[Node], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = batch.column(3).to_numpy(zero_copy_only=False)
            more = leaf_values(tree, _matrix(batch.column(0), width, np.int64), model.cuts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(margin + more)], names=batch.schema.names)

    return run


def _binned(model: BoostedTrees, keep: int):
    """Replace the array of numbers, the column after the first ``keep``, by the array of bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(model.names)
        for batch in batches:
            bins = model.binned(_matrix(batch.column(keep), width, np.float64))
            cuts = np.arange(0, len(bins) * width + 1, width, dtype=np.int32)
            columns = list(batch.columns)
            columns[keep] = pa.ListArray.from_arrays(pa.array(cuts), pa.array(bins.ravel()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def cut_points(rows: DataFrame, names: Sequence[str], bins: int = 64) -> list[np.ndarray]:
    """At most ``bins - 1`` cut points per column, between distinct values; null and NaN count for none."""
    shares = [i / bins for i in range(1, bins)]
    numbers = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in names]
    row = rows.agg(
        *[F.percentile_approx(n, shares, ACCURACY).alias(f"c{i}") for i, n in enumerate(numbers)],
        *[F.max(n).alias(f"m{i}") for i, n in enumerate(numbers)],
    ).first()
    found = []
    for i in range(len(names)):
        cuts = np.unique(np.array(row[f"c{i}"] or [], np.float64))
        # Nothing lies beyond the highest value, so a cut there would separate nothing.
        found.append(cuts[cuts < row[f"m{i}"]] if len(cuts) else cuts)
    return found


def _values(names: Sequence[str]) -> Column:
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in names])


def train_boosting(
    rows: DataFrame,
    names: Sequence[str],
    label: str = "churn",
    weight: str | None = None,
    rounds: int = 50,
    depth: int = 3,
    learning_rate: float = 0.1,
    bins: int = 64,
    penalty: float = 1.0,
    least_gain: float = 0.0,
    least_hessian: float = 1e-3,
) -> BoostedTrees:
    """Boosted trees on the log loss of 0/1 labels; rows without label are left out.

    The driver sees sums per (node, feature, bin) only, at most 2^depth x columns x bins of them. A
    column without two distinct values is never split. With one class only, or no rows, no
    tree is grown and the margin is that of the smoothed share of positives.
    """
    names = list(names)
    usable = rows.where(F.col(label).isNotNull())
    weighed = F.coalesce(F.col(weight), F.lit(0.0)) if weight else F.lit(1.0)
    plain = usable.select(_values(names).alias("x"), F.col(label).cast("double").alias("label"), weighed.cast("double").alias("weight"))
    total, positive = plain.agg(F.coalesce(F.sum("weight"), F.lit(0.0)), F.coalesce(F.sum(F.col("weight") * F.col("label")), F.lit(0.0))).first()
    share = (positive + 0.5) / (total + 1.0)
    model = BoostedTrees(names, cut_points(usable, names, bins), float(np.log(share / (1 - share))))
    width = len(names)
    schema = T.StructType(
        [
            T.StructField("bins", T.ArrayType(T.IntegerType())), T.StructField("label", T.DoubleType()),
            T.StructField("weight", T.DoubleType()), T.StructField("margin", T.DoubleType()),
        ]
    )
    source = plain.select(F.col("x").alias("bins"), "label", "weight", F.lit(model.start).alias("margin"))
    state = materialize(source.mapInArrow(_binned(model, 0), schema), "boosting")
    if positive in (0.0, total):
        return model
    bins_wide = max(len(c) for c in model.cuts) + 2
    for _ in range(rounds):
        tree = [Node()]
        open_nodes = [0]
        sums: dict[int, tuple[float, float]] = {}
        for level in range(depth + 1):
            parts = state.mapInArrow(_histograms(model, tree, open_nodes, width), "slot bigint, g double, h double")
            g, h = (np.zeros(len(open_nodes) * width * bins_wide) for _ in range(2))
            for r in parts.groupBy("slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
                g[r["slot"]], h[r["slot"]] = r["g"], r["h"]
            g, h = (v.reshape(len(open_nodes), width, bins_wide) for v in (g, h))
            following = []
            for i, node in enumerate(open_nodes):
                sums[node] = float(g[i, 0].sum()), float(h[i, 0].sum())
                split = best_split(g[i], h[i], model.cuts, penalty, least_gain, least_hessian) if level < depth else None
                if split:
                    _, feature, limit, missing_left = split
                    tree[node] = Node(feature, limit, missing_left, len(tree), len(tree) + 1)
                    following += [len(tree), len(tree) + 1]
                    tree += [Node(), Node()]
            open_nodes = following
            if not open_nodes:
                break
        tree = [
            n if n.feature >= 0 else Node(value=-learning_rate * sums[i][0] / (sums[i][1] + penalty)) for i, n in enumerate(tree)
        ]
        model.trees.append(tree)
        if len(tree) == 1:
            break
        state = materialize(state.mapInArrow(_moved(model, tree, width), schema), "boosting")
    return model


def boosting_scores(rows: DataFrame, model: BoostedTrees, keep: Sequence[str], column: str = "score") -> DataFrame:
    """(keep, score): the positive probability of every row."""
    source = rows.select(*keep, _values(model.names).alias(column))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(batch.num_columns - 1), len(model.names), np.float64)
            scores = pa.array(_sigmoid(model.margins(model.binned(x))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=batch.schema.names)

    return source.mapInArrow(run, schema)
