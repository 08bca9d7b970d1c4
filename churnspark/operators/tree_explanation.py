"""Exact contributions of features to the predictions of tree models.

The value of an unknown feature is averaged over the training rows that reach a split: a leaf is
then reached with the product, over the features of its path, of 1 or 0 for a known feature (inside
the path's interval or not) and of the share of training weight that passes for an unknown one. The
Shapley value of a feature in such a product is the integral over t in (0, 1) of a polynomial, the
product over the other features of ``share + t * (known - share)``; its degree is below the number of
features on the path, so a Gauss-Legendre rule of half as many points gives it exactly.

A model becomes one row per leaf with an interval and a share per feature of its path. These rows
are as large as the model, which the driver holds anyway, and go to the tasks with the job. Users
are then explained where they are: no explode, no shuffle, one array per row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    RandomForestClassificationModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.runtime import new_path

# Numbers of a batch that are held at once: rows x leaves x features of a path.
_CELLS = 1 << 21


@dataclass(frozen=True)
class LeafPaths:
    """Leaves of one or more trees; rows are leaves, columns the distinct features of their paths.

    A row of data is inside where ``low < x <= high``. Paths with fewer features are filled up with
    intervals that hold every number and shares of 1.
    """

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray
    units: str

    @property
    def base(self) -> float:
        """The mean prediction over the training weight."""
        return float((self.value * self.share.prod(axis=1)).sum())


class _PathBuilder:
    """Gathers leaves, each as feature -> (low, high, share)."""

    def __init__(self) -> None:
        self.paths: list[dict[int, tuple[float, float, float]]] = []
        self.values: list[float] = []

    def add(self, path: dict[int, tuple[float, float, float]], value: float) -> None:
        self.paths.append(path)
        self.values.append(value)

    def done(self, units: str) -> LeafPaths:
        width = max((len(p) for p in self.paths), default=0) or 1
        shape = (len(self.paths), width)
        feature, share = np.zeros(shape, np.int64), np.ones(shape)
        low, high = np.full(shape, -np.inf), np.full(shape, np.inf)
        for i, path in enumerate(self.paths):
            for j, (name, (a, b, part)) in enumerate(sorted(path.items())):
                feature[i, j], low[i, j], high[i, j], share[i, j] = name, a, b, part
        return LeafPaths(feature, low, high, share, np.array(self.values, np.float64), units)


def _narrowed(path: dict, feature: int, low: float, high: float, share: float) -> dict:
    a, b, part = path.get(feature, (-np.inf, np.inf, 1.0))
    return {**path, feature: (max(a, low), min(b, high), part * share)}


def _saved_nodes(model: Model) -> dict[int, dict[int, dict]]:
    """Nodes by tree and number, as the model writes them."""
    spark = SparkSession.active()
    path = new_path(spark, "model")
    model.write().overwrite().save(path)
    stored = spark.read.parquet(f"{path}/data")
    if "nodeData" in stored.columns:
        stored = stored.select("treeID", "nodeData.*")
    else:
        stored = stored.withColumn("treeID", F.lit(0))
    trees: dict[int, dict[int, dict]] = {}
    for node in stored.select("treeID", "id", "prediction", "impurityStats", "leftChild", "rightChild", "split").toLocalIterator():
        trees.setdefault(node["treeID"], {})[node["id"]] = node.asDict(recursive=True)
    return trees


def leaf_paths(model: Model) -> LeafPaths:
    """The leaves of a decision tree, random forest or boosted trees.

    Values are probabilities of the positive class, or log odds for boosted trees. Training weight
    per node comes from the model's own statistics. Categorical splits are an error: encode
    categories as dummies, as ``encoding`` does.
    """
    boosted = isinstance(model, GBTClassificationModel)
    if boosted:
        # The probability of a margin m is 1 / (1 + exp(-2 m)).
        scales = [2.0 * w for w in model.treeWeights]
    elif isinstance(model, RandomForestClassificationModel):
        scales = [1.0 / model.getNumTrees] * model.getNumTrees
    elif isinstance(model, DecisionTreeClassificationModel):
        scales = [1.0]
    else:
        raise TypeError(f"{type(model).__name__} is no tree model")

    def weight(node: dict) -> float:
        return node["impurityStats"][0] if boosted else sum(node["impurityStats"])

    found = _PathBuilder()
    for tree, nodes in sorted(_saved_nodes(model).items()):
        waiting = [(nodes[0], {})]
        while waiting:
            node, path = waiting.pop()
            if node["leftChild"] < 0:
                value = node["prediction"] if boosted else node["impurityStats"][1] / sum(node["impurityStats"])
                found.add(path, value * scales[tree])
                continue
            split = node["split"]
            if split["numCategories"] >= 0:
                raise ValueError("categorical splits cannot be explained")
            feature, threshold = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
            left, right = nodes[node["leftChild"]], nodes[node["rightChild"]]
            waiting.append((left, _narrowed(path, feature, -np.inf, threshold, weight(left) / weight(node))))
            waiting.append((right, _narrowed(path, feature, threshold, np.inf, weight(right) / weight(node))))
    return found.done("log_odds" if boosted else "probability")


# A given tree: None for a leaf, or (feature, threshold, tree for x <= threshold, tree for larger x).
Tree = tuple | None


def fixed_tree(rows: DataFrame, tree: Tree, names: Sequence[str], label: str = "churn") -> LeafPaths:
    """A tree of given splits, with shares and label means counted over ``rows`` in one aggregate.

    A leaf that no row reaches has value 0; below a node without rows every share is 0.
    """
    counts: list[Column] = []
    leaves: list[tuple[dict, int]] = []

    def counted(reached: Column) -> int:
        counts.extend([F.count_if(reached).alias(f"n{len(counts)}"), F.sum(F.when(reached, F.col(label))).alias(f"p{len(counts)}")])
        return len(counts) - 2

    def walk(node: Tree, reached: Column, own: int, path: list[tuple]) -> None:
        if node is None:
            leaves.append((path, own))
            return
        name, threshold, left, right = node
        for child, inside, low, high in (
            (left, F.col(name) <= threshold, -np.inf, threshold), (right, F.col(name) > threshold, threshold, np.inf)
        ):
            here = reached & inside
            at = counted(here)
            walk(child, here, at, [*path, (names.index(name), low, high, at, own)])

    walk(tree, F.lit(True), counted(F.lit(True)), [])
    row = rows.agg(*counts).first()
    found = _PathBuilder()
    for steps, at in leaves:
        path: dict = {}
        for feature, low, high, child, parent in steps:
            path = _narrowed(path, feature, float(low), float(high), row[child] / row[parent] if row[parent] else 0.0)
        found.add(path, float(row[at + 1]) / row[at] if row[at] else 0.0)
    return found.done("probability")


def _sums(paths: LeafPaths, width: int):
    """Rows of numbers -> contributions of the features to the prediction of each row."""
    depth = paths.feature.shape[1]
    points, weights = np.polynomial.legendre.leggauss((depth + 1) // 2)
    points, weights = (points + 1) / 2, weights / 2
    step = max(1, _CELLS // (256 * depth))

    def run(x: np.ndarray) -> np.ndarray:
        # Trees send what is no number the way of large ones.
        x = np.where(np.isnan(x), np.inf, x)
        out = np.zeros((len(x), width))
        for first in range(0, len(paths.value), step):
            part = slice(first, first + step)
            feature, share = paths.feature[part], paths.share[part]
            at = x[:, feature]
            gain = ((at > paths.low[part]) & (at <= paths.high[part])) - share
            total = np.zeros(gain.shape)
            for t, weight in zip(points, weights, strict=True):
                factor = share + t * gain
                others = np.ones(gain.shape)
                others[..., 1:] = np.cumprod(factor[..., :-1], axis=-1)
                others[..., :-1] *= np.cumprod(factor[..., :0:-1], axis=-1)[..., ::-1]
                total += weight * others
            total *= gain * paths.value[part][:, None]
            order = np.argsort(feature.ravel(), kind="stable")
            sorted_features = feature.ravel()[order]
            starts = np.flatnonzero(np.concatenate([[True], sorted_features[1:] != sorted_features[:-1]]))
            out[:, sorted_features[starts]] += np.add.reduceat(total.reshape(len(x), feature.size)[:, order], starts, axis=1)
        return out

    return run


def _explained(paths: LeafPaths, width: int):
    work = _sums(paths, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                lists = rows.column(rows.num_columns - 1)
                known = lists.is_valid().to_numpy(zero_copy_only=False)
                x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
                cuts = np.concatenate([[0], np.cumsum(np.where(known, width, 0))]).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(cuts), pa.array(work(x).ravel()), mask=pa.array(~known))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], values], names=rows.schema.names)

    return run


def tree_contributions(
    rows: DataFrame, paths: LeafPaths, names: Sequence[str], values: Column, keep: Sequence[str] = ("userId",)
) -> DataFrame:
    """(keep, contributions, units, base_value): a map feature -> contribution per row.

    ``values`` is an array of doubles in the order of ``names``; a null or NaN entry counts as larger
    than every threshold, as in the trees, and a null array gives a null map. The contributions of a
    row add up to its prediction minus ``base_value``, the prediction averaged over training.
    """
    width = len(names)
    if paths.feature.max(initial=0) >= width:
        raise ValueError("the model uses features that have no name")
    filled = F.transform(values, lambda v: F.coalesce(v, F.lit(float("nan"))))
    source = rows.select(*keep, filled.alias("contributions"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("contributions", T.ArrayType(T.DoubleType()))])
    found = source.mapInArrow(_explained(paths, width), schema)
    named = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.col("contributions"))
    return found.select(
        *keep, named.alias("contributions"), F.lit(paths.units).alias("units"), F.lit(paths.base).alias("base_value")
    )


def model_contributions(
    rows: DataFrame, model: Model, names: Sequence[str], vector: str = "scaled_features", keep: Sequence[str] = ("userId",)
) -> DataFrame:
    """``tree_contributions`` of a Spark tree model over its vector column."""
    return tree_contributions(rows, leaf_paths(model), names, vector_to_array(vector), keep)
