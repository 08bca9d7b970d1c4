"""Embedding whitening against numpy, and the spectrum's updates on their own."""

from __future__ import annotations

import math

import numpy as np
import pytest

from churnspark.llm import queries, whitening
from churnspark.llm.spectrum import Spectrum, rank_one

TABLE = "vec_id bigint, embedding array<float>, label int, n bigint, whitened string"


def scatter_of(rows):
    off = rows - rows.mean(axis=0)
    return off.T @ off


def cases():
    random_ = np.random.default_rng(5)
    plain = np.floor(random_.normal(size=(400, 12)) * random_.uniform(5, 300, 12)) + 100_000
    yield "plain", plain
    yield "few rows", plain[:5]
    yield "repeated rows", plain[random_.integers(0, 3, 200)]
    yield "dependent columns", np.hstack([plain[:, :4], plain[:, :4] * 2])
    yield "one column", plain[:, :1]
    yield "equal variances", np.vstack([np.eye(6), -np.eye(6)] * 5)
    yield "constant", np.full((20, 4), 7.0)


@pytest.mark.parametrize(("name", "rows"), list(cases()), ids=[n for n, _ in cases()])
def test_spectrum_follows_rows_and_merges(name, rows):
    size = rows.shape[1]
    whole, left, right = Spectrum(size), Spectrum(size), Spectrum(size)
    for i, row in enumerate(rows):
        whole.add(row)
        (left if i % 3 else right).add(row)
    left.merge(Spectrum.from_bytes(right.to_bytes(), size))
    left.merge(Spectrum(size))
    want = scatter_of(rows)
    largest = max(np.abs(want).max(), 1.0)
    for found in (whole, left):
        assert found.n == len(rows) and np.allclose(found.mean, rows.mean(axis=0), rtol=1e-12)
        assert np.abs((found.vectors * found.values) @ found.vectors.T - want).max() < 1e-10 * largest
        assert np.abs(found.vectors.T @ found.vectors - np.eye(size)).max() < 1e-11
        assert np.all(np.diff(found.values) >= 0)


def test_update_without_effect_is_deflated():
    values, vectors = np.array([1.0, 2.0, 3.0]), np.eye(3)
    found, _ = rank_one(values, vectors, np.zeros(3), 1.0)
    assert np.array_equal(found, values)
    found, turned = rank_one(values, vectors, np.array([0.0, 2.0, 0.0]), 1.0)
    assert np.allclose(found, [1, 3, 6]) and np.allclose(np.abs(turned).sum(axis=0), 1)


def table(spark, rows):
    full = [(i, None if v is None else [None if c is None else float(c) for c in v], 0, 5, "x") for i, v in rows]
    return spark.createDataFrame(full, TABLE).repartition(5)


def vectors(seed, many, size=10):
    random_ = np.random.default_rng(seed)
    return (random_.normal(size=(many, size)) * np.linspace(0.05, 0.6, size)).astype(np.float32)


def test_whitened_rows_match_numpy(spark):
    plain = vectors(1, 300)
    rows = [(i, v) for i, v in enumerate(plain)] + [(300, plain[0])] * 150 + [(None, plain[1])]
    bad = [(900, None), (901, [None] * 10), (902, [math.nan] * 10), (903, [math.inf] + [0.0] * 9), (904, [1.0, 2.0]), (905, [])]
    got = whitening.whiten(table(spark, rows + bad)).collect()
    assert len(got) == 8 * len(rows)
    x = np.array([np.floor(1024 * v.astype(np.float64)) + 100_000 for _, v in rows])
    n, sums = len(x), x.sum(axis=0)
    values, basis = np.linalg.eigh(scatter_of(x) / n)
    values, basis = values[::-1], basis[:, ::-1]
    want = {}
    for (i, v), row in zip(rows, x):
        want[i] = (int(((n * row - sums) ** 2).sum()), (row - x.mean(axis=0)) @ basis[:, :8] / np.sqrt(values[:8]))
    signs = {}
    for r in got:
        deviation, white = want[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == deviation
        sign = signs.setdefault(r["component"], 1 if r["whitened"] * white[r["component"] - 1] > 0 else -1)
        assert abs(sign * white[r["component"] - 1] - r["whitened"]) < 1e-9
        assert abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-9
        assert r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in got}) == 1


def test_merged_basis_is_close_before_refinement(spark):
    rows = vectors(2, 200)
    found, size = whitening.usable_vectors(table(spark, list(enumerate(rows))))
    fitted = whitening.fit(found.select("embedding"), size)
    x = np.floor(1024 * rows.astype(np.float64)) + 100_000
    values = np.linalg.eigvalsh(scatter_of(x))
    assert fitted.merged.n == 200 and np.abs(fitted.merged.values / values - 1).max() < 1e-9
    assert np.abs(fitted.values * 200 / values[::-1][:8] - 1).max() < 1e-12


def test_no_variance_few_dimensions_and_empty(spark, nothing):
    same = whitening.whiten(table(spark, [(i, [0.5, 1.5]) for i in range(4)])).collect()
    assert len(same) == 8 and {(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in same} == {(0, 0, 0, 0)}
    one = whitening.whiten(table(spark, [(1, [0.5, 2.0, 1.0])])).collect()
    assert sorted(r["component"] for r in one) == [1, 2, 3] and {r["n"] for r in one} == {1}
    line = whitening.whiten(table(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert {r["component"]: r["explained"] for r in line} == pytest.approx({1: 1.0, 2: 0.0})
    empty = whitening.whiten(table(spark, [(1, None)]))
    assert empty.count() == 0
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_a_long_is_null():
    rows = np.array([[3_100_000_000, 0], [0, 0]], np.int64)
    assert whitening._deviations(rows, 2, [3_100_000_000, 0]) == [None, None]
    assert whitening._deviations(np.array([[100_003]]), 1 << 30, [100_003 << 30]) == [0]


def test_query_over_the_table(spark):
    got = queries.op13_whitening(spark, "/root/testdata/sf0.001")
    assert got.count() == 8 * 500
    assert got.selectExpr("max(identity_error)").first()[0] < 1e-10
