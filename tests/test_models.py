"""Boosted trees and Newton regression against plain arithmetic and Spark's own fit."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from thermolens.operators import blocks, boosting, newton

SCHEMA = "id long, label double, features vector"


def frame(spark, x, y, parts=3):
    return spark.createDataFrame(
        [(i, float(k), Vectors.dense(v)) for i, (v, k) in enumerate(zip(x.tolist(), y.tolist()))],
        ["id", "label", "features"]).repartition(parts)


@pytest.fixture(scope="module")
def points():
    """Three classes by two of five columns, one column constant, one of few values."""
    r = np.random.default_rng(1)
    x = np.column_stack((r.normal(size=(1500, 3)), r.integers(0, 3, 1500), np.ones(1500)))
    y = np.where(x[:, 0] + x[:, 1] > 0.8, 1, np.where(x[:, 0] * x[:, 1] < -0.5, 2, 0))
    return x, y


def plain_round(codes, y, raw, base, offsets, depth, rate, ridge, least):
    """One round as the formulas say it, a node and a split at a time."""
    shares = np.exp(raw) / np.exp(raw).sum(1, keepdims=True)
    out = raw.copy()
    for k in range(raw.shape[1]):
        slope, bend = shares[:, k] - (y == k), shares[:, k] * (1 - shares[:, k])
        leaves = [(np.arange(y.size), 0)]
        while leaves:
            rows, level = leaves.pop()
            best = (1e-9, None)
            g, h = slope[rows].sum(), bend[rows].sum()
            for c in range(len(codes)) if level < depth else ():
                for cut in range(offsets[c + 1] - offsets[c] - 1):
                    left = codes[c, rows] <= cut
                    a, b = slope[rows][left].sum(), bend[rows][left].sum()
                    if b < least or h - b < least:
                        continue
                    gain = a * a / (b + ridge) + (g - a) ** 2 / (h - b + ridge) - g * g / (h + ridge)
                    if gain > best[0] + 1e-9:
                        best = (gain, left)
            if best[1] is None:
                out[rows, k] += -rate * g / (h + ridge)
            else:
                leaves += [(rows[best[1]], level + 1), (rows[~best[1]], level + 1)]
    return out


def test_rounds_are_those_of_the_formulas(spark, points):
    x, y = points
    trainer = boosting.BoostedTrees(rounds=12, depth=3, bins=16)
    model = trainer.fit(frame(spark, x, y))
    codes = boosting.coded(x, model.edges)
    offsets = np.concatenate(([0], np.cumsum([e.size + 1 for e in model.edges])))
    raw = np.tile(model.base, (y.size, 1))
    assert len(model.rounds) == 12 and np.allclose(
        np.exp(model.base), np.bincount(y) / y.size, atol=1e-5)
    for trees in model.rounds:
        expected = plain_round(codes, y, raw, model.base, offsets, 3, 0.1, 1.0, 1.0)
        raw = raw + trees.values(codes)
        assert np.allclose(raw, expected, atol=1e-5)
        raw = expected


def test_boosted_probabilities_are_calibrated_and_saved(spark, points, tmp_path):
    x, y = points
    train = frame(spark, x[:1000], y[:1000])
    model = boosting.BoostedTrees(rounds=60, depth=4).fit(train)
    assert np.allclose(boosting.BoostedTrees(rounds=60, depth=4).fit(train.repartition(7))
                       .probabilities(x[1000:]), model.probabilities(x[1000:]), atol=1e-6)
    p = model.probabilities(x[1000:])
    assert np.allclose(p.sum(1), 1) and (p.argmax(1) == y[1000:]).mean() > 0.93
    assert np.allclose(p.mean(0), np.bincount(y[1000:]) / 500, atol=0.03)
    assert model.gains().argmax() in (0, 1) and abs(model.gains().sum() - 1) < 1e-12
    told = model.transform(frame(spark, x, y)).orderBy("id").collect()
    assert [r.prediction for r in told] == model.probabilities(x).argmax(1).tolist()
    model.save(spark, str(tmp_path / "trees"))
    again = boosting.BoostedTreesModel.load(spark, str(tmp_path / "trees"))
    assert np.array_equal(again.probabilities(x), model.probabilities(x))


def test_newton_steps_reach_the_converged_fit(spark, points):
    x, y = points
    data = frame(spark, x, y).persist()
    model = newton.SoftmaxRegression().fit(data)
    assert model.steps < 25 and model.slope <= 1e-9
    slow = LogisticRegression(family="multinomial", maxIter=5000, tol=1e-13, regParam=1 / y.size,
                              standardization=False).fit(data)
    assert np.abs(slow.coefficientMatrix.toArray() - model.coefficients).max() < 1e-6
    assert np.abs(slow.interceptVector.toArray() - model.intercepts).max() < 1e-5
    told = model.transform(data).select("probability", "prediction").collect()
    assert all(abs(sum(r.probability) - 1) < 1e-12 and r.probability.argmax() == r.prediction
               for r in told)
    data.unpersist()


def test_derivatives_are_those_of_the_loss(points):
    x, y = points
    r = np.random.default_rng(2)
    w = r.normal(size=(3, 6)) / 5
    loss, slope, bend = newton.derivatives(x, y, w)
    for _ in range(5):
        d = r.normal(size=w.shape)
        d *= 1e-4 / np.abs(d).max()
        up, down = (newton.derivatives(x, y, w + s * d) for s in (1, -1))
        assert np.isclose((up[0] - down[0])[0] / 2, (slope * d).sum(), rtol=1e-6)
        assert np.isclose((up[1] - down[1]) / 2, np.einsum("ijkl,jl->ik", bend, d), rtol=1e-4,
                          atol=1e-6).all()


def test_nulls_one_class_and_empty_tables(spark, points, tmp_path):
    x, y = points
    rows = frame(spark, x, y)
    gaps = rows.withColumn("label", F.when(F.col("id") % 3 > 0, F.col("label")))
    empty, one = rows.limit(0), rows.filter("label = 1")
    for trainer in (boosting.BoostedTrees(rounds=3, depth=2), newton.SoftmaxRegression()):
        model = trainer.fit(gaps)
        assert np.allclose(model.probabilities(x), trainer.fit(
            rows.filter("id % 3 > 0")).probabilities(x), atol=1e-9)
        assert trainer.fit(empty).transform(empty).count() == 0
        assert (trainer.fit(one).probabilities(x).argmax(1) == 1).all()
    model.save(spark, str(tmp_path / "newton"))
    again = newton.SoftmaxModel.load(spark, str(tmp_path / "newton"))
    assert np.array_equal(again.probabilities(x), model.probabilities(x))
    big = blocks.packed(rows.coalesce(1)).select(F.sum("n"), F.max("n")).first()
    assert tuple(big) == (1500, 1500)


def test_rounds_have_no_more_tasks_than_cores(spark, points, monkeypatch):
    """Every task sends sums of its own, 500 times: partitions must not decide how many there are."""
    x, y = points
    seen, original = [], boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda scored, *args: seen.append(
        scored.getNumPartitions()) or original(scored, *args))
    for module in (blocks, boosting):
        monkeypatch.setattr(module, "ROWS", 10)
    model = boosting.BoostedTrees(rounds=2, depth=2).fit(frame(spark, x, y, 60))
    assert len(model.rounds) == 2 and max(seen) <= spark.sparkContext.defaultParallelism


def test_sums_of_grouped_columns_are_those_of_each(points):
    r = np.random.default_rng(4)
    sizes = [64, 64, 1, 3, 64, 200, 2, 7]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    assert boosting.column_groups(offsets) == [[0, 1, 2], [3, 4], [5, 6, 7]]
    codes = np.stack([r.integers(0, s, 900) for s in sizes]).astype(np.uint8)
    y, raw = r.integers(0, 3, 900), r.normal(size=(900, 3))
    trees = boosting.Trees.empty(3, 2)
    trees.column[:, 0], trees.cut[:, 0] = [1, 5, 7], [30, 100, 3]
    asked = [np.array([1]), np.array([1, 2]), np.zeros(0, np.int64)]
    found = boosting.histograms(codes, y, raw, trees, 1, asked, offsets)
    p = np.exp(raw) / np.exp(raw).sum(1, keepdims=True)
    for k, nodes in enumerate(asked):
        at = 1 + (codes[trees.column[k, 0]] > trees.cut[k, 0])
        for i, node in enumerate(nodes):
            for c, size in enumerate(sizes):
                here = slice(offsets[c], offsets[c + 1])
                for side, w in enumerate((p[:, k] - (y == k), p[:, k] * (1 - p[:, k]))):
                    assert np.allclose(found[k][side, i, here], np.bincount(
                        codes[c][at == node], w[at == node], size))
    assert found[2].shape == (2, 0, offsets[-1])
