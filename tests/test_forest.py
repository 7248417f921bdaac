"""The binned forest against plain arithmetic; its parts; few tasks whatever the partitions."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from thermolens.operators import blocks, boosting, forest, ml


@pytest.fixture(scope="module")
def points():
    r = np.random.default_rng(3)
    x = np.column_stack((r.normal(size=(1200, 4)), r.integers(0, 3, 1200)))
    y = np.where(x[:, 0] + x[:, 1] > 0.8, 1, np.where(x[:, 0] * x[:, 4] < -0.5, 2, 0))
    return x, y


@pytest.fixture(scope="module")
def data(spark, points):
    x, y = points
    rows = [(i, float(k), Vectors.dense(v)) for i, (v, k) in enumerate(zip(x.tolist(), y.tolist()))]
    made = spark.createDataFrame(rows, ["id", "label", "features"]).repartition(3).persist()
    yield made
    made.unpersist()


def plain_gain(codes, y, w, cut):
    """Impurity taken away, times rows, as the formula says it."""
    def gini(rows):
        n = np.bincount(y[rows], w[rows], 3)
        return n.sum() * (1 - ((n / max(n.sum(), 1)) ** 2).sum())
    left = codes <= cut
    return gini(np.ones(y.size, bool)) - gini(left) - gini(~left)


def test_every_split_is_the_best_of_its_columns(data):
    model = ml.forest(3, 4, seed=5).fit(data)
    matrices = blocks.matrices(data).collect()
    codes = np.concatenate([boosting.coded(b[2], model.edges) for b in matrices], 1)
    y = np.concatenate([b[1] for b in matrices])
    for t, tree in enumerate(model.trees):
        w = np.concatenate([forest.drawn(5, t, b[0], b[1].size) for b in matrices])
        assert 0.9 < w.mean() < 1.1
        here = {0: w > 0}
        for level in range(4):
            nodes = np.array([i for i in sorted(here) if (tree.counts[i] > 0).sum() > 1])
            picks = np.sort(np.random.default_rng([5, t, level, 1]).random(
                (nodes.size, 5)).argsort(1)[:, :3], 1)
            below = {}
            for i, columns in zip(nodes, picks):
                rows = here[i]
                assert np.array_equal(np.bincount(y[rows], w[rows], 3), tree.counts[i])
                best = max(plain_gain(codes[c, rows], y[rows], w[rows], cut)
                           for c in columns for cut in range(31))
                assert tree.gain[i] == pytest.approx(best, abs=1e-6)
                if tree.column[i] >= 0:
                    right = codes[tree.column[i]] > tree.cut[i]
                    assert tree.column[i] in columns
                    below |= {tree.child[i]: rows & ~right, tree.child[i] + 1: rows & right}
            here = below
        assert (tree.column[list(here)] < 0).all()


def test_grid_points_are_parts_of_one_forest(points, data, monkeypatch):
    x, _ = points
    whole = ml.forest(seed=7)
    grid = [{whole.maxDepth: d, whole.numTrees: n} for d in (2, 5) for n in (3, 6)]
    fits, original = [], forest.ForestClassifier._fit
    monkeypatch.setattr(forest.ForestClassifier, "_fit",
                        lambda self, df: fits.append(1) or original(self, df))
    parts = dict(whole.fitMultiple(data, grid))
    assert len(fits) == 1 and sorted(parts) == [0, 1, 2, 3]
    for i, point in enumerate(grid):
        alone = whole.copy(point).fit(data)
        assert len(alone.trees) == point[whole.numTrees]
        assert np.array_equal(alone.probabilities(x), parts[i].probabilities(x))
        assert alone.featureImportances == parts[i].featureImportances


def test_wide_levels_take_more_scans(points, data, monkeypatch):
    x, y = points
    model = ml.forest(10, 12).fit(data)
    assert (model.probabilities(x).argmax(1) == y).mean() > 0.97
    monkeypatch.setattr(forest, "NODES", 3)
    monkeypatch.setattr(forest, "HELD", 50)
    assert np.array_equal(ml.forest(4, 6).fit(data).probabilities(x),
                          model.part(4, 6).probabilities(x))


def test_scans_have_no_more_tasks_than_cores(spark, data):
    """Every task sends counts of its own, so 150 partitions must not mean 150 tasks."""
    many = blocks.matrices(data.repartition(150))
    cores = spark.sparkContext.defaultParallelism
    assert blocks.tasks_for(many, 10_000_000) == cores
    assert blocks.tasks_for(many, cores * 3 * blocks.TASK_ROWS) == cores * 3
    assert blocks.tasks_for(many, 10) == 1


def test_saved_scored_and_empty(spark, points, data, tmp_path):
    x, y = points
    model = ml.forest(5, 6).fit(data)
    model.write().overwrite().save(str(tmp_path / "forest"))
    again = forest.ForestModel.load(str(tmp_path / "forest"))
    assert np.array_equal(again.probabilities(x), model.probabilities(x))
    told = again.transform(data).orderBy("id").collect()
    assert np.allclose([r.probability.toArray() for r in told], model.probabilities(x))
    assert [r.prediction for r in told] == model.probabilities(x).argmax(1).tolist()
    empty = ml.forest(2, 3).fit(data.limit(0))
    assert empty.transform(data.limit(0)).count() == 0
    assert np.allclose(empty.probabilities(x), 1 / 3)
    one = ml.forest(2, 3).fit(data.filter("label = 1"))
    assert (one.probabilities(x)[:, 1] == 1).all()
    gaps = data.withColumn("label", F.when(F.col("id") % 3 > 0, F.col("label")))
    assert (ml.forest(5, 8).fit(gaps).probabilities(x).argmax(1) == y).mean() > 0.9
