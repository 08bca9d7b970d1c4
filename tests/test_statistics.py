"""Running sums, quantiles, tests and evaluation against brute force and known values."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.functions.tails import chi_squared_tail, normal_two_sided
from churnspark.operators import evaluation, profile, statistics
from churnspark.operators.running import running_sums


@pytest.mark.parametrize(
    ("statistic", "dof", "p"),
    [(3.841, 1, 0.05), (6.635, 1, 0.01), (5.991, 2, 0.05), (7.815, 3, 0.05), (18.307, 10, 0.05), (30.578, 15, 0.01)],
)
def test_chi_squared_tail_table(statistic, dof, p):
    assert chi_squared_tail(statistic, dof) == pytest.approx(p, abs=5e-5)


def test_normal_tail_table():
    assert normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert normal_two_sided(-2.575829) == pytest.approx(0.01, abs=1e-6)


@pytest.mark.parametrize("chunks", [2, 5, 64])
def test_running_sums_with_any_number_of_chunks(spark, chunks):
    generator = random.Random(chunks)
    rows = []
    for group in ("a", "b"):
        # Most values lie close together, so that equal-width chunks would be useless.
        values = sorted({generator.random() ** 9 for _ in range(300)} | {-5.0, 1e6})
        rows += [(group, v, generator.randrange(5)) for v in values]
    table = spark.createDataFrame(rows, "g string, v double, n long")
    got = {(r.g, r.v): (r.n_before, r.n_total) for r in running_sums(table, ["g"], "v", ["n"], chunks=chunks).collect()}
    for group in ("a", "b"):
        total, seen = sum(n for g, _, n in rows if g == group), 0
        for g, v, n in rows:
            if g == group:
                assert got[g, v] == (seen, total)
                seen += n
    assert len(got) == len(rows)


def test_describe_matches_numpy(spark):
    generator = np.random.default_rng(3)
    rows = [(str(g), float(v)) for g in range(3) for v in generator.exponential(size=57 + g).round(1)]
    rows.append(("single", 4.0))
    described = profile.describe_by(spark.createDataFrame(rows, "g string, x double"), ["g"], "x").collect()
    assert len(described) == 4
    for r in described:
        values = np.array([v for g, v in rows if g == r.g])
        assert r["count"] == len(values)
        expected = [values.mean(), values.min(), *np.percentile(values, [25, 50, 75]), values.max()]
        assert [r["mean"], r["min"], r.q1, r.median, r.q3, r["max"]] == pytest.approx(expected)
        if len(values) > 1:
            assert r["std"] == pytest.approx(values.std(ddof=1))
        else:
            assert r["std"] is None


def _chi(spark, cells, **options):
    table = spark.createDataFrame([(str(i), str(j), n) for i, row in enumerate(cells) for j, n in enumerate(row) if n], "a string, b string, n long")
    return statistics.chi_squared(table, "a", "b", **options).first()


def test_chi_squared_known_tables(spark):
    plain = _chi(spark, [[10, 20], [30, 5]], yates=False)
    corrected = _chi(spark, [[10, 20], [30, 5]])
    n, a, b, c, d = 65, 10, 20, 30, 5
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    assert plain.chi2 == pytest.approx(n * (a * d - b * c) ** 2 / margins)
    assert corrected.chi2 == pytest.approx(n * (abs(a * d - b * c) - n / 2) ** 2 / margins)
    assert (plain.dof, corrected.n) == (1, 65)
    assert corrected.p_value == pytest.approx(math.erfc(math.sqrt(corrected.chi2 / 2)))


def test_chi_squared_with_an_empty_cell(spark):
    cells = [[8, 0, 4, 3, 1], [2, 9, 1, 5, 7]]
    found = _chi(spark, cells)
    table = np.array(cells, dtype=float)
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    assert found.chi2 == pytest.approx(((table - expected) ** 2 / expected).sum())
    assert found.dof == 4
    # Independent rows give 0, not a rounding error below it.
    assert _chi(spark, [[2, 4], [3, 6]], yates=False).chi2 == pytest.approx(0.0, abs=1e-9)


def test_expected_counts(spark):
    table = spark.createDataFrame([("x", "p", 3), ("x", "q", 1), ("y", "p", 2)], "a string, b string, n long")
    got = {(r.a, r.b): r.expected for r in statistics.expected_counts(table, "a", "b").collect()}
    assert got == pytest.approx({("x", "p"): 20 / 6, ("x", "q"): 4 / 6, ("y", "p"): 10 / 6})


def test_mann_whitney_by_counting_pairs(spark):
    generator = random.Random(8)
    rows = [(i % 3 == 0, round(generator.random(), 1), float(i % 3 == 0), 5.0) for i in range(90)]
    table = spark.createDataFrame([(int(c), t, d, k) for c, t, d, k in rows], "churn int, tied double, apart double, constant double")
    got = {r.feature: r for r in statistics.mann_whitney(table, ["tied", "apart", "constant"]).collect()}
    x = [t for c, t, _, _ in rows if not c]
    y = [t for c, t, _, _ in rows if c]
    u = sum((a > b) + 0.5 * (a == b) for a in x for b in y)
    assert got["tied"].u == u
    n0, n1, n = len(x), len(y), 90
    ties = sum(k**3 - k for k in (sum(1 for r in rows if r[1] == v) for v in {r[1] for r in rows}))
    spread = math.sqrt(n0 * n1 / 12 * (n + 1 - ties / (n * (n - 1))))
    z = (max(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5) / spread
    assert got["tied"].z == pytest.approx(z)
    assert got["tied"].p_value == pytest.approx(min(1.0, math.erfc(z / math.sqrt(2))))
    assert got["apart"].u == 0
    assert got["apart"].p_value < 1e-9
    assert got["apart"].reject
    assert got["constant"].p_value == 1.0


def test_correlation_with_nulls_and_constants(spark):
    rows = [(float(i), float(i * i), 3.0, float(i) if i % 2 else None) for i in range(8)]
    table = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.a, r.b): r["corr"] for r in statistics.feature_correlation(table, ["a", "b", "c", "d"]).collect()}
    a, b = np.arange(8.0), np.arange(8.0) ** 2
    assert got["b", "a"] == pytest.approx(np.corrcoef(a, b)[0, 1])
    assert got["d", "a"] == pytest.approx(1.0)
    assert got["d", "b"] == pytest.approx(np.corrcoef(a[1::2], b[1::2])[0, 1])
    assert got["c", "a"] is None
    assert got["d", "c"] is None
    assert len(got) == 6


def _scored(spark, pairs):
    return spark.createDataFrame([(str(i), y, float(s)) for i, (y, s) in enumerate(pairs)], "id string, label int, score double")


def _brute(pairs):
    points = []
    positives = sum(y for y, _ in pairs)
    for t in sorted({s for _, s in pairs}):
        predicted = [y for y, s in pairs if s >= t]
        points.append((t, sum(predicted) / len(predicted), sum(predicted) / positives))
    return points


@pytest.mark.parametrize("seed", range(3))
def test_curves_areas_and_threshold(spark, seed):
    generator = random.Random(seed)
    pairs = [(generator.randrange(2), round(generator.random(), 1 + seed)) for _ in range(60)]
    scored = _scored(spark, pairs)
    points = _brute(pairs)
    got = sorted((r.threshold, r.precision, r.recall) for r in evaluation.pr_curve(scored).collect() if r.threshold is not None)
    assert got == [pytest.approx(p) for p in points]
    curve = [*points, (None, 1.0, 0.0)]
    pr_auc = sum((a[2] - b[2]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    ones, zeros = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    roc_auc = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))
    areas = evaluation.areas(scored).first()
    assert (areas.pr_auc, areas.roc_auc) == pytest.approx((pr_auc, roc_auc))
    f2 = [5 * p * r / (4 * p + r) if p + r else 0.0 for _, p, r in points]
    best = evaluation.best_threshold(scored).first()
    assert best.threshold == points[int(np.argmax(np.round(f2, 12)))][0]
    # Order-preserving changes of the score leave the area under the ROC curve alone.
    squeezed = scored.withColumn("score", F.col("score") * F.col("score") / 2)
    assert evaluation.areas(squeezed).first().roc_auc == pytest.approx(roc_auc)


def test_spark_evaluator_agrees_on_roc(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector

    generator = random.Random(4)
    scored = _scored(spark, [(generator.randrange(2), generator.random()) for _ in range(80)])
    raw = scored.withColumn("raw", array_to_vector(F.array(-F.col("score"), F.col("score"))))
    expected = BinaryClassificationEvaluator(rawPredictionCol="raw", metricName="areaUnderROC", numBins=0).evaluate(raw)
    assert evaluation.areas(scored).first().roc_auc == pytest.approx(expected)


def test_strict_and_inclusive_decisions(spark):
    scored = _scored(spark, [(1, 0.9), (1, 0.6), (0, 0.6), (0, 0.1)])
    best = evaluation.best_threshold(scored).first()
    assert (best.threshold, best.recall) == (0.6, 1.0)
    strict = evaluation.classification_metrics(scored).first()
    inclusive = evaluation.classification_metrics(scored, inclusive=True).first()
    assert (strict.recall, strict.precision, strict.accuracy) == (0.5, 1.0, 0.75)
    assert (inclusive.recall, inclusive.precision) == (1.0, pytest.approx(2 / 3))
    assert strict.f1_weighted == pytest.approx((2 / 3 * 2 + 0.8 * 2) / 4)


@pytest.mark.parametrize("pairs", [[(0, 0.3), (0, 0.4)], [(1, 0.3), (1, 0.4)], [(1, 0.5), (0, 0.5)]])
def test_degenerate_scores_do_not_fail(spark, pairs):
    scored = _scored(spark, pairs)
    row = evaluation.evaluation_summary(scored).first()
    assert 0.0 <= row.accuracy <= 1.0
    assert evaluation.roc_curve(scored).count() == len({s for _, s in pairs}) + 1
    cells = evaluation.confusion_matrix(evaluation.decide(scored, 0.35)).collect()
    assert len(cells) == 4


def test_top_score_negative_and_perfect(spark):
    negative_top = evaluation.pr_curve(_scored(spark, [(0, 0.9), (1, 0.5)]))
    assert {(r.threshold, r.precision) for r in negative_top.collect()} == {(0.9, 0.0), (0.5, 0.5), (None, 1.0)}
    perfect = evaluation.evaluation_summary(_scored(spark, [(1, 1.0), (0, 0.0)])).first()
    assert perfect.roc_auc == perfect.pr_auc == 1.0
    assert perfect.brier_score == 0.0
    assert perfect.log_loss == pytest.approx(0.0, abs=1e-12)
    worst = evaluation.log_loss(_scored(spark, [(0, 1.0)])).first().log_loss
    assert worst == pytest.approx(52 * math.log(2))


def test_calibration_edges_belong_to_the_lower_bin(spark):
    rows = evaluation.calibration_curve(_scored(spark, [(1, 0.0), (0, 0.1), (1, 0.100001), (1, 1.0)])).collect()
    assert {r.bin: r.n for r in rows} == {0: 2, 1: 1, 9: 1}


def test_histograms_of_equal_scores(spark):
    assert [tuple(r) for r in evaluation.score_histogram(_scored(spark, [(1, 0.4), (0, 0.4)])).collect()] == [(0, 2)]
    features = spark.createDataFrame([(0, 1.0, 5.0), (0, 2.0, 5.0), (1, 3.0, 5.0)], "churn int, x double, c double")
    bins = {(r.feature, r.churn, r.bin): (r.n, r.density) for r in profile.feature_histogram(features, ["x", "c"], bins=4).collect()}
    assert bins == {
        ("x", 0, 0): (1, 1.0), ("x", 0, 2): (1, 1.0), ("x", 1, 3): (1, 2.0), ("c", 0, 0): (2, None), ("c", 1, 0): (1, None),
    }


def test_boxplot_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    table = spark.createDataFrame([(0, v) for v in values], "churn int, x double")
    box = profile.feature_boxplot(table, ["x"]).first()
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high, box.n_outliers) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)
