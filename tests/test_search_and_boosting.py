"""Adaptive search on known losses, and histogram boosting against a version on one array."""

from __future__ import annotations

import random

import numpy as np
import pytest

from churnspark.operators import hist_boosting as hb
from churnspark.operators import search, training

SPACE = {"x": ("uniform", -5.0, 5.0), "y": ("quniform", 10, 1000, 10), "z": ("uniform", 0.01, 1.0)}


def loss(drawn):
    return (drawn["x"] - 2) ** 2 / 10 + ((drawn["y"] - 300) / 400) ** 2 + (drawn["z"] - 0.2) ** 2 * 3


def adaptive(seed, trials, round_size=4):
    return search.minimise(SPACE, lambda draws: [loss(d) for d in draws], trials, seed, round_size)


def test_search_beats_random_draws_at_the_same_budget():
    wins, ours, theirs = 0, [], []
    for seed in range(30):
        found = adaptive(seed, 30).best()[1]
        generator = random.Random(seed)
        drawn = min(loss(search.random_draw(SPACE, generator)) for _ in range(30))
        ours.append(found)
        theirs.append(drawn)
        wins += found < drawn
    assert wins >= 21 and np.median(ours) < 0.6 * np.median(theirs)


def test_search_is_seeded_and_keeps_to_the_space():
    one, two = adaptive(7, 25), adaptive(7, 25)
    assert one.trials == two.trials and one.trials != adaptive(8, 25).trials
    assert len(one.trials) == 25
    for drawn, _ in one.trials:
        assert -5 <= drawn["x"] <= 5 and 0.01 <= drawn["z"] <= 1
        assert isinstance(drawn["y"], int) and drawn["y"] % 10 == 0 and 10 <= drawn["y"] <= 1000


def test_rounds_do_not_repeat_draws_and_small_spaces_are_seen_whole():
    seen = []

    def evaluate(draws):
        seen.extend(d["k"] for d in draws)
        return [abs(d["k"] - 3) for d in draws]

    found = search.minimise({"k": ("quniform", 1, 5, 1)}, evaluate, 12, seed=1, round_size=3)
    assert len(found.trials) == 12 and sorted(seen) == [1, 2, 3, 4, 5]
    assert found.best() == ({"k": 3}, 0)


def test_fixed_parameter_and_step_within_bounds():
    generator = random.Random(1)
    assert search.random_draw({"a": ("uniform", 2.0, 2.0)}, generator) == {"a": 2}
    assert {search.random_draw({"a": ("quniform", 5, 24, 10)}, generator)["a"] for _ in range(50)} == {10, 20}
    assert search.minimise({"a": ("uniform", 2.0, 2.0)}, lambda d: [0.0] * len(d), 8).best() == ({"a": 2}, 0.0)


def test_adaptive_search_of_a_classifier(spark):
    from pyspark.ml.functions import array_to_vector

    rows = spark.createDataFrame(
        [(str(i), [float(i % 10), float(i % 3)], int(i % 10 > 6), 1.0) for i in range(60)],
        "userId string, x array<double>, churn int, weight double",
    ).withColumn(training.VECTOR, array_to_vector("x"))
    space = {"maxDepth": ("quniform", 1, 4, 1)}
    found = training.adaptive_search(rows, training.classifiers()["decision_tree"], space, trials=6, seed=2)
    assert found == training.adaptive_search(rows, training.classifiers()["decision_tree"], space, trials=6, seed=2)
    assert found[1] == 1.0


# --- histogram boosting -------------------------------------------------------------------------------

TABLE = "id int, a double, b double, c double, d double, churn int, weight double"


def data(many=400):
    random_ = np.random.default_rng(2)
    x = np.column_stack(
        [random_.normal(size=many), random_.integers(0, 4, many).astype(float), random_.exponential(size=many), np.ones(many)]
    )
    x[random_.random(many) < 0.2, 0] = np.nan
    label = ((np.nan_to_num(x[:, 0], nan=1.5) + (x[:, 1] == 2) - 0.5 * x[:, 2] + random_.normal(0, 0.4, many)) > 0.3).astype(int)
    return x, label, 1.0 + random_.integers(0, 2, many)


@pytest.fixture(scope="module")
def table(spark):
    x, label, weight = data()
    rows = [
        (i, *[None if np.isnan(v) and i % 2 else float(v) for v in r], int(t), float(w))
        for i, (r, t, w) in enumerate(zip(x, label, weight))
    ]
    return spark.createDataFrame(rows, TABLE).repartition(4)


def plain_boosting(x, label, weight, cuts, rounds, depth, rate, penalty):
    """The same algorithm on one array, splits found by trying every one."""
    p = (weight @ label + 0.5) / (weight.sum() + 1)
    margin = np.full(len(x), np.log(p / (1 - p)))
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-margin))
        g, h = weight * (q - label), weight * q * (1 - q)
        groups = [np.arange(len(x))]
        for _ in range(depth):
            following = []
            for rows in groups:
                best = (1e-12, None)
                for j, cut in enumerate(cuts):
                    for c in cut:
                        for missing_left in (True, False):
                            left = np.where(np.isnan(x[rows, j]), missing_left, x[rows, j] <= c)
                            parts = [rows[left], rows[~left]]
                            if min(h[s].sum() for s in parts) < 1e-3:
                                continue
                            gain = sum(g[s].sum() ** 2 / (h[s].sum() + penalty) for s in parts)
                            gain = (gain - g[rows].sum() ** 2 / (h[rows].sum() + penalty)) / 2
                            if gain > best[0] + 1e-12:
                                best = (gain, parts)
                following.extend([s for s in best[1]] if best[1] else [rows])
            groups = following
        for rows in groups:
            margin[rows] -= rate * g[rows].sum() / (h[rows].sum() + penalty)
    return 1 / (1 + np.exp(-margin))


def test_boosting_equals_the_version_on_one_array(table):
    x, label, weight = data()
    model = hb.train_boosting(table, ["a", "b", "c", "d"], weight="weight", rounds=5, depth=3, learning_rate=0.3, bins=8)
    assert [len(c) for c in model.cuts][1:] == [3, 7, 0] and len(model.trees) == 5
    want = plain_boosting(x, label, weight, model.cuts, 5, 3, 0.3, 1.0)
    got = {r["id"]: r["score"] for r in hb.boosting_scores(table, model, ["id"]).collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(want.tolist(), abs=1e-9)
    losses = -(label * np.log(want) + (1 - label) * np.log(1 - want))
    assert losses.mean() < 0.45


def test_boosting_does_not_depend_on_partitions(table):
    one, two = (hb.train_boosting(t, ["a", "b", "c", "d"], rounds=3, bins=8) for t in (table, table.repartition(7)))
    assert [[(n.feature, n.bin, n.missing_left) for n in t] for t in one.trees] == [
        [(n.feature, n.bin, n.missing_left) for n in t] for t in two.trees
    ]


def test_missing_numbers_go_the_better_way(spark):
    rows = [(i, None if i % 2 else float(i % 8), 0.0, 0.0, 0.0, int(i % 2 == 1), 1.0) for i in range(80)]
    model = hb.train_boosting(spark.createDataFrame(rows, TABLE), ["a"], rounds=1, depth=1, bins=4)
    root = model.trees[0][0]
    left, right = (model.trees[0][i].value for i in (root.left, root.right))
    assert (left > right) == root.missing_left


def test_one_class_no_rows_and_no_labels(spark, table):
    only = hb.train_boosting(table.where("churn = 1"), ["a", "b"], rounds=3)
    assert only.trees == [] and only.start > 0
    nothing = hb.train_boosting(table.where("false"), ["a", "b"], rounds=3)
    assert nothing.trees == [] and nothing.start == 0.0
    assert hb.boosting_scores(table, nothing, ["id"]).where("score = 0.5").count() == 400
    assert hb.boosting_scores(table.where("false"), only, ["id"]).count() == 0
    constant = hb.train_boosting(table, ["d"], rounds=3)
    assert len(constant.trees) == 1 and len(constant.trees[0]) == 1
