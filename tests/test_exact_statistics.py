"""Exact rank tests, automatic bins, sketches, corners of the ROC curve, agent tokens, places."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.functions import agents, tails
from churnspark.operators import evaluation, profile, running, statistics
from churnspark.plans import scoring
from churnspark.workloads.fixtures import AGENT_SAMPLES
from churnspark.workloads.oracles import AGENT_KINDS

# --- exact law of U -----------------------------------------------------------------------------------


@pytest.mark.parametrize(("a", "b"), [(1, 1), (1, 5), (2, 3), (3, 3), (4, 6), (5, 4)])
def test_counts_equal_all_rankings(a, b):
    found = [0] * (a * b + 1)
    for chosen in itertools.combinations(range(1, a + b + 1), a):
        found[sum(chosen) - a * (a + 1) // 2] += 1
    upward, total = tails.rank_sum_counts(a, b)
    assert total == math.comb(a + b, a) == sum(found)
    assert upward == [sum(found[u:]) for u in range(a * b + 1)]


def test_known_p_values():
    assert tails.rank_sum_two_sided(0, 3, 3) == pytest.approx(0.1)
    assert tails.rank_sum_two_sided(9, 3, 3) == pytest.approx(0.1)
    assert tails.rank_sum_two_sided(4, 3, 3) == 1.0
    assert tails.rank_sum_two_sided(0, 8, 1000) == pytest.approx(2 / math.comb(1008, 8))


def test_exact_law_is_used_where_it_holds(spark):
    values = [("few", v, int(v > 5)) for v in (1.0, 2.0, 3.0, 6.0, 7.0, 8.0)]
    values += [("ties", v, i % 2) for i, v in enumerate((1.0, 1.0, 2.0, 3.0))]
    values += [("many", i + 0.5, i % 2) for i in range(40)]
    values += [("one class", 1.0, 0), ("one class", 2.0, 0), ("few", None, 1), ("few", float("nan"), 0)]
    table = spark.createDataFrame(values, "g string, value double, churn int").repartition(4)
    got = {r["g"]: r for r in statistics.rank_tests(table, ["g"], method="auto").collect()}
    assert (got["few"]["method"], got["few"]["u"], got["few"]["p_value"]) == ("exact", 0.0, pytest.approx(0.1))
    assert (got["few"]["n0"], got["few"]["n1"], got["few"]["reject"]) == (3, 3, False)
    assert got["ties"]["method"] == got["many"]["method"] == got["one class"]["method"] == "normal"
    assert got["one class"]["p_value"] == 1.0
    normal = {r["g"]: r for r in statistics.rank_tests(table, ["g"]).collect()}
    assert {r["method"] for r in normal.values()} == {"normal"}
    assert normal["many"]["p_value"] == pytest.approx(got["many"]["p_value"]) and normal["few"]["p_value"] != got["few"]["p_value"]
    with pytest.raises(ValueError, match="method"):
        statistics.rank_tests(table, ["g"], method="other")


# --- bins and sketches --------------------------------------------------------------------------------


def test_automatic_bins_follow_the_spread(spark):
    random_ = random.Random(1)
    rows = [(str(i), i % 2, random_.gauss(0, 1), float(i % 3), 7.0) for i in range(1000)] + [("x", 0, None, float("nan"), None)]
    table = spark.createDataFrame(rows, "userId string, churn int, a double, b double, c double")
    got = {r["feature"]: r for r in profile.automatic_bins(table, ["a", "b", "c"]).collect()}
    for name, column in (("a", 2), ("b", 3), ("c", 4)):
        x = np.array([r[column] for r in rows if r[column] is not None and not math.isnan(r[column])])
        edges = np.histogram_bin_edges(x, "auto")
        assert got[name]["bins"] == (len(edges) - 1 if x.max() > x.min() else 1)
        assert got[name]["width"] == pytest.approx((x.max() - x.min()) / got[name]["bins"])
    filled = profile.feature_histogram_auto(table, ["a", "b", "c"]).collect()
    assert sum(r["n"] for r in filled if r["feature"] == "a") == 1000
    assert profile.feature_histogram_auto(table.where("false"), ["a"]).count() == 0


def test_sketch_is_exact_below_its_size_and_near_beyond(spark):
    rows = [("small", float(v)) for v in (5, 1, 4, 2, 3)] + [("large", float(i * 7919 % 20011)) for i in range(20000)] + [("small", None)]
    table = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r["g"]: r for r in profile.describe_by_sketch(table, ["g"], "v").collect()}
    small = got["small"]
    assert (small["count"], small["min"], small["q1"], small["median"], small["q3"], small["max"]) == (5, 1, 2, 3, 4, 5)
    assert small["std"] == pytest.approx(math.sqrt(2.5))
    exact = {r["g"]: r for r in profile.describe_by(table, ["g"], "v").collect()}
    assert got["large"]["median"] == pytest.approx(exact["large"]["median"], abs=20011 * 0.01)
    errors = profile.sketch_rank_errors(table, ["g"], "v", [0.1, 0.5, 0.9], size=100).collect()
    assert len(errors) == 6 and all(0 <= r["error"] <= r["bound"] < 0.05 for r in errors)
    assert max(r["error"] for r in errors if r["g"] == "large") > 0


# --- corners ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("chunks", [None, 5])
def test_corners_are_the_points_where_the_curve_turns(spark, monkeypatch, chunks):
    if chunks:
        monkeypatch.setattr(running, "FEWEST_CHUNKS", chunks)
    random_ = random.Random(3)
    rows = [(str(i), int(random_.random() < 0.3 + 0.4 * (i % 20 > 12)), (i % 20 if i % 3 else i) / 400) for i in range(400)]
    scored = spark.createDataFrame(rows, "id string, label int, score double").repartition(5)
    curve = sorted(((r["threshold"], r["fpr"], r["tpr"]) for r in evaluation.roc_curve(scored).collect()), key=lambda p: -9 if p[0] is None else -p[0])
    kept = [curve[0]]
    for a, b, c in zip(curve, curve[1:], curve[2:]):
        if abs((b[1] - a[1]) * (c[2] - b[2]) - (b[2] - a[2]) * (c[1] - b[1])) > 1e-12:
            kept.append(b)
    kept.append(curve[-1])
    got = sorted(((r["threshold"], r["fpr"], r["tpr"]) for r in evaluation.roc_corners(scored).collect()), key=lambda p: -9 if p[0] is None else -p[0])
    assert got == kept and len(got) < len(curve)

    def area(points):
        return sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(points, points[1:]))

    assert area(got) == pytest.approx(area(curve)) == pytest.approx(evaluation.areas(scored).first()["roc_auc"])


def test_corners_of_small_curves(spark):
    one = spark.createDataFrame([("a", 1, 0.5), ("b", 0, 0.5)], "id string, label int, score double")
    assert sorted((r["fpr"], r["tpr"]) for r in evaluation.roc_corners(one).collect()) == [(0.0, 0.0), (1.0, 1.0)]
    assert evaluation.roc_corners(one.where("false")).count() == 1


def test_previous_rows_cross_chunks(spark):
    rows = [("g", i, i * 10, 1) for i in range(0, 100, 3)] + [("h", 5, 50, 1)]
    table = spark.createDataFrame(rows, "k string, v int, c int, n int").repartition(4)
    got = running.running_sums(table, ["k"], "v", ["n"], chunks=7, previous=["c"]).collect()
    for r in got:
        assert r["c_previous"] == (r["c"] - 30 if r["k"] == "g" and r["v"] else None)
        assert r["n_before"] == (r["v"] // 3 if r["k"] == "g" else 0)


# --- agents -------------------------------------------------------------------------------------------


def test_agents_are_read_by_their_tokens(spark):
    rows = [*enumerate(AGENT_SAMPLES), (len(AGENT_SAMPLES), None)]
    tokens = spark.createDataFrame(rows, "i int, a string").withColumn("t", agents.agent_tokens(F.col("a")))
    found = tokens.select(
        "i", agents.platform_of(F.col("t")).alias("p"), agents.browser_of(F.col("t")).alias("b"),
        agents.version_of(F.col("t"), agents.browser_of(F.col("t"))).alias("v"),
    )
    assert len(AGENT_SAMPLES) >= 40 and len(AGENT_KINDS) == len(rows)
    assert sorted((r["i"], r["p"], r["b"], r["v"]) for r in found.collect()) == sorted(AGENT_KINDS)


def test_tokens_keep_their_kind(spark):
    agent = "Mozilla/5.0 (X11; Linux x86_64; rv:1.2) Gecko/2 Plain"
    got = spark.createDataFrame([(agent,)], "a string").select(agents.agent_tokens(F.col("a")).alias("t")).first()["t"]
    assert [tuple(t) for t in got] == [
        ("product", "Mozilla", "5.0"), ("product", "Gecko", "2"), ("product", "Plain", None),
        ("part", "X11", None), ("part", "Linux x86_64", None), ("part", "rv", "1.2"),
    ]


# --- places and pairs ---------------------------------------------------------------------------------


def test_places_follow_the_probability(spark):
    rows = [(f"u{i:03d}", (i * 37 % 50) / 50 if i % 11 else None) for i in range(300)]
    got = scoring.ranked(spark.createDataFrame(rows, "userId string, churn_probability double").repartition(6)).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [tuple(r)[1:] for r in sorted(got, key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in got) == list(range(1, 301))
    assert scoring.ranked(spark.createDataFrame([], "userId string, churn_probability double")).count() == 0


def test_correlation_over_common_rows(spark):
    random_ = np.random.default_rng(1)
    x = random_.normal(size=(200, 3)) @ random_.normal(size=(3, 4)) + [1e6, 0, 5, -3]
    x[random_.random(x.shape) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) + (3.0,) for i, r in enumerate(x)]
    table = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(3)
    got = {(r["a"], r["b"]): r["corr"] for r in statistics.feature_correlation(table, list("abcde")).collect()}
    assert len(got) == 10
    for (one, two), corr in got.items():
        if "e" in (one, two):
            assert corr is None
            continue
        i, j = "abcd".index(one), "abcd".index(two)
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert corr == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
