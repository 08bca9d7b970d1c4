"""Tree and kernel contributions against sums over all subsets, and against each other."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from churnspark.operators import kernel_explanation as kernel
from churnspark.operators import training, tree_explanation

NAMES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    random_ = random.Random(3)
    made = []
    for i in range(200):
        x = [random_.gauss(0, 1), random_.choice([0.0, 1.0]), random_.random() * 5, random_.gauss(2, 3), float(i % 7)]
        label = int(x[0] + 2 * x[1] * (x[2] > 2) - 0.3 * x[3] + random_.gauss(0, 0.5) > 0)
        made.append((str(i), *x, label, 1.0 + i % 3))
    table = spark.createDataFrame(made, "userId string, a double, b double, c double, d double, e double, churn int, weight double")
    return table.withColumn(training.VECTOR, array_to_vector(F.array(*NAMES))).repartition(3).cache()


def subsets(worth, size):
    """Shapley values by their definition."""
    found = []
    for i in range(size):
        others = [j for j in range(size) if j != i]
        value = 0.0
        for many in range(size):
            weight = math.factorial(many) * math.factorial(size - many - 1) / math.factorial(size)
            for chosen in itertools.combinations(others, many):
                value += weight * (worth({*chosen, i}) - worth(set(chosen)))
        found.append(value)
    return found


def walked(nodes, boosted, x, known, number=0):
    """The prediction of a tree when only the known features are."""
    node = nodes[number]
    if node["leftChild"] < 0:
        return node["prediction"] if boosted else node["impurityStats"][1] / sum(node["impurityStats"])
    split = node["split"]
    left, right = node["leftChild"], node["rightChild"]
    if split["featureIndex"] in known:
        goes_left = x[split["featureIndex"]] <= split["leftCategoriesOrThreshold"][0]
        return walked(nodes, boosted, x, known, left if goes_left else right)
    weights = [nodes[n]["impurityStats"][0] if boosted else sum(nodes[n]["impurityStats"]) for n in (left, right)]
    parts = [walked(nodes, boosted, x, known, n) for n in (left, right)]
    return sum(w * p for w, p in zip(weights, parts)) / sum(weights)


MODELS = {
    "tree": (DecisionTreeClassifier, {"maxDepth": 6, "weightCol": "weight", "seed": 1}),
    "forest": (RandomForestClassifier, {"numTrees": 7, "maxDepth": 4, "weightCol": "weight", "seed": 1}),
    "boosted": (GBTClassifier, {"maxIter": 6, "maxDepth": 3, "stepSize": 0.3, "seed": 1}),
}


@pytest.mark.parametrize("kind", sorted(MODELS))
def test_tree_contributions_equal_all_subsets(spark, rows, kind):
    estimator, settings = MODELS[kind]
    model = estimator(featuresCol=training.VECTOR, labelCol="churn", **settings).fit(rows)
    boosted = kind == "boosted"
    trees = tree_explanation._saved_nodes(model)
    scales = {t: 2 * model.treeWeights[t] if boosted else 1 / len(trees) for t in trees}
    scored = training.with_probability(model, rows, "score")
    found = tree_explanation.model_contributions(scored, model, NAMES, keep=("userId", "score")).collect()
    assert len(found) == 200
    x_of = {r["userId"]: [r[n] for n in NAMES] for r in rows.collect()}
    for r in found:
        total = r["base_value"] + sum(r["contributions"].values())
        told = 1 / (1 + math.exp(-total)) if r["units"] == "log_odds" else total
        assert told == pytest.approx(r["score"], abs=1e-9)
    for r in found[:12]:
        x = x_of[r["userId"]]
        exact = subsets(lambda known: sum(scales[t] * walked(n, boosted, x, known) for t, n in trees.items()), 5)
        assert [r["contributions"][n] for n in NAMES] == pytest.approx(exact, abs=1e-9)
    empty = sum(scales[t] * walked(n, boosted, [0] * 5, set()) for t, n in trees.items())
    assert found[0]["base_value"] == pytest.approx(empty, abs=1e-9)


def test_deep_trees_keep_their_sum(spark, rows):
    model = DecisionTreeClassifier(maxDepth=20, minInstancesPerNode=1, featuresCol=training.VECTOR, labelCol="churn").fit(rows)
    scored = training.with_probability(model, rows, "score")
    for r in tree_explanation.model_contributions(scored, model, NAMES, keep=("userId", "score")).collect():
        assert r["base_value"] + sum(r["contributions"].values()) == pytest.approx(r["score"], abs=1e-9)


def test_missing_numbers_go_right_and_null_rows_stay(spark):
    data = [(str(i), float(i), int(i >= 5)) for i in range(10)]
    table = spark.createDataFrame(data, "userId string, a double, churn int")
    paths = tree_explanation.fixed_tree(table, ("a", 4, None, None), ["a"])
    assert paths.base == pytest.approx(0.5)
    odd = spark.createDataFrame([("n", [None]), ("x", [float("nan")]), ("l", [1.0]), ("z", None)], "userId string, v array<double>")
    got = {r["userId"]: r["contributions"] for r in tree_explanation.tree_contributions(odd, paths, ["a"], F.col("v")).collect()}
    assert got == {"n": {"a": 0.5}, "x": {"a": 0.5}, "l": {"a": -0.5}, "z": None}
    assert tree_explanation.tree_contributions(odd.where("false"), paths, ["a"], F.col("v")).count() == 0
    unreached = tree_explanation.fixed_tree(table, ("a", 100, None, ("a", 200, None, None)), ["a"])
    assert unreached.base == pytest.approx(0.5)
    with pytest.raises(TypeError, match="no tree model"):
        tree_explanation.leaf_paths(LogisticRegression())  # an estimator, not a model of trees


def test_design_has_the_kernel_weights():
    full = kernel.coalitions(4, most=14)
    assert len(full.weights) == 14
    assert sorted(set(full.members.sum(axis=1))) == [1, 2, 3]
    sampled = kernel.coalitions(12, most=200, seed=1)
    by_size = {s: sampled.weights[sampled.members.sum(axis=1) == s].sum() for s in range(1, 12)}
    whole = {s: kernel._kernel(12, s) for s in range(1, 12)}
    assert by_size[1] == pytest.approx(whole[1]) and by_size[11] == pytest.approx(whole[11])
    assert sum(by_size.values()) == pytest.approx(sum(whole.values()))
    assert all(by_size[s] == pytest.approx(by_size[12 - s]) for s in range(1, 12))
    assert np.array_equal(sampled.members, kernel.coalitions(12, most=200, seed=1).members)
    assert not np.array_equal(sampled.members, kernel.coalitions(12, most=200, seed=2).members)


def values():
    return F.array(*NAMES)


def test_kernel_is_exact_with_all_coalitions(spark, rows):
    model = LogisticRegression(featuresCol=training.VECTOR, labelCol="churn", regParam=0.05).fit(rows)
    background = kernel.background_rows(rows, values(), most=7)
    assert background == kernel.background_rows(rows.repartition(5), values(), most=7)
    some = rows.where("cast(userId as int) < 6")
    found = kernel.kernel_contributions(some, kernel.model_prediction(model), NAMES, values(), background).collect()
    weights, intercept = model.coefficients.toArray(), model.intercept

    def probability(x):
        return 1 / (1 + math.exp(-(float(np.dot(weights, x)) + intercept)))

    for r, x in ((r, [t[n] for n in NAMES]) for r in found for t in rows.collect() if t["userId"] == r["userId"]):
        exact = subsets(
            lambda known: sum(probability([x[j] if j in known else b[j] for j in range(5)]) for b in background) / len(background), 5
        )
        assert [r["contributions"][n] for n in NAMES] == pytest.approx(exact, abs=1e-9)
        assert r["base_value"] + sum(r["contributions"].values()) == pytest.approx(probability(x), abs=1e-9)


def test_kernel_is_exact_for_a_linear_prediction_at_any_size(spark):
    size = 14
    random_ = random.Random(5)
    slopes = [random_.gauss(0, 1) for _ in range(size)]
    data = [(str(i), [random_.gauss(0, 2) for _ in range(size)]) for i in range(8)]
    table = spark.createDataFrame(data, "userId string, own array<double>")

    def linear(rows):
        terms = F.zip_with("x", F.array(*[F.lit(s) for s in slopes]), lambda v, s: v * s)
        return rows.withColumn("prediction", F.aggregate(terms, F.lit(0.0), lambda a, v: a + v))

    background = [x for _, x in data[:3]]
    names = [f"f{i}" for i in range(size)]
    found = kernel.kernel_contributions(table, linear, names, F.col("own"), background, most_coalitions=120).collect()
    means = np.mean(background, axis=0)
    for r in found:
        x = dict(data)[r["userId"]]
        exact = [s * (v - m) for s, v, m in zip(slopes, x, means)]
        assert [r["contributions"][n] for n in names] == pytest.approx(exact, abs=1e-8)


def test_sampled_kernel_is_near_the_full_one(spark, rows):
    """Stated error: 0.02 on probabilities, with a third of all coalitions."""
    model = RandomForestClassifier(numTrees=5, maxDepth=4, featuresCol=training.VECTOR, labelCol="churn", seed=2).fit(rows)
    wide = rows.withColumn("own", F.concat(values(), values())).where("cast(userId as int) < 5")
    names = [f"f{i}" for i in range(10)]

    def predict(frame):
        # The forest sees the mean of two copies of every feature.
        halves = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: (F.get("x", i) + F.get("x", i + 5)) / 2)
        return training.with_probability(model, frame.withColumn(training.VECTOR, array_to_vector(halves)), "prediction")

    background = kernel.background_rows(rows, F.concat(values(), values()), most=3)
    full = {r["userId"]: r for r in kernel.kernel_contributions(wide, predict, names, F.col("own"), background, 1022).collect()}
    part = kernel.kernel_contributions(wide, predict, names, F.col("own"), background, 340, seed=4).collect()
    for r in part:
        assert sum(r["contributions"].values()) == pytest.approx(sum(full[r["userId"]]["contributions"].values()), abs=1e-9)
        for n in names:
            assert r["contributions"][n] == pytest.approx(full[r["userId"]]["contributions"][n], abs=0.02)


def test_one_feature_takes_all(spark):
    table = spark.createDataFrame([("u", [3.0])], "userId string, own array<double>")
    found = kernel.kernel_contributions(
        table, lambda t: t.withColumn("prediction", F.col("x")[0] * 2), ["a"], F.col("own"), [[1.0], [2.0]]
    ).first()
    assert found["contributions"] == {"a": pytest.approx(3.0)} and found["base_value"] == pytest.approx(3.0)
    with pytest.raises(ValueError, match="background"):
        kernel.kernel_contributions(table, lambda t: t, ["a"], F.col("own"), [])
