"""Random forests over binned columns: all trees grow a level at a time, in one scan."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession

from thermolens.operators.blocks import kept, matrices, tasks_for, with_probabilities
from thermolens.operators.boosting import coded, column_edges
from thermolens.schema import LABELS

#: Nodes whose counts one scan adds up: some 60 MB a task with 24 columns, 32 bins, 3 classes.
NODES = 32_768
#: Entries that a task holds before it counts them.
HELD = 2 ** 22

# How often a row is drawn: Poisson shares with mean 1, by the number's 16 bits.
_POISSON = np.searchsorted(
    np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 9)])) * 65_536, np.arange(65_536) + 0.5,
).astype(np.uint8)


@dataclass
class Tree:
    """Nodes in the order they were made, the root first; ``column`` is -1 at leaves. Rows with a code
    over ``cut`` go to the node after ``child``, others to ``child``."""

    column: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    counts: np.ndarray  # nodes x classes
    gain: np.ndarray

    @classmethod
    def root(cls, classes: int) -> "Tree":
        return cls(np.full(1, -1, np.int16), np.zeros(1, np.uint8), np.zeros(1, np.int32),
                   np.zeros((1, classes)), np.zeros(1))

    def split(self, nodes: np.ndarray, column, cut, gain, left, right) -> np.ndarray:
        """Give ``nodes`` two children each; returns those that are not pure."""
        first = len(self.column) + 2 * np.arange(nodes.size)
        self.column[nodes], self.cut[nodes] = column, cut
        self.child[nodes], self.gain[nodes] = first, gain
        n = 2 * nodes.size
        made = np.stack((left, right), 1).reshape(n, self.counts.shape[1])
        self.column = np.concatenate((self.column, np.full(n, -1, np.int16)))
        self.cut = np.concatenate((self.cut, np.zeros(n, np.uint8)))
        self.child = np.concatenate((self.child, np.zeros(n, np.int32)))
        self.gain = np.concatenate((self.gain, np.zeros(n)))
        self.counts = np.concatenate((self.counts, made))
        return (len(self.column) - n + np.arange(n))[(made > 0).sum(1) > 1]

    def cut_at(self, depth: int) -> "Tree":
        """The tree as it was when it had ``depth`` levels."""
        level = np.zeros(len(self.column), np.int64)
        for i in np.flatnonzero(self.column >= 0):  # parents come before their children
            level[self.child[i]:self.child[i] + 2] = level[i] + 1
        kept_ = level <= depth
        place = np.cumsum(kept_) - 1
        leaf = level[kept_] == depth
        return Tree(np.where(leaf, -1, self.column[kept_]).astype(np.int16), self.cut[kept_],
                    np.where(leaf | (self.column[kept_] < 0), 0,
                             place[self.child[kept_]]).astype(np.int32),
                    self.counts[kept_], np.where(leaf, 0.0, self.gain[kept_]))

    def add_shares(self, codes: np.ndarray, out: np.ndarray) -> None:
        """Add the class shares of every row's leaf to ``out``."""
        flat, n = codes.ravel(), codes.shape[1]
        shares = self.counts / np.maximum(self.counts.sum(1, keepdims=True), 1e-300)
        rows, at = np.arange(n), np.zeros(n, np.int64)
        while rows.size:
            column = self.column[at]
            inner = column >= 0
            if not inner.all():
                out[rows[~inner]] += shares[at[~inner]]
                rows, at, column = rows[inner], at[inner], column[inner]
            at = self.child[at] + (flat[column * np.int64(n) + rows] > self.cut[at])


def drawn(seed: int, tree: int, number: tuple[int, int], n: int) -> np.ndarray:
    """How often each row of a matrix is in a tree's sample; the same in every scan."""
    r = np.random.default_rng([seed, tree, *number])
    return _POISSON[r.integers(0, 65_536, n, np.uint16)]


def node_keys(block: tuple, parts: tuple, level: int, nodes: np.ndarray, picks: np.ndarray,
              weights: np.ndarray, bins: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The drawn rows that stand at one of ``nodes``: for each column picked there their places in its
    counts, and their weights. Rows that ended in leaves are left behind on the way."""
    _, y, codes = block
    column_of, cut_of, child_of = parts
    flat, n = codes.ravel(), y.size
    begins = column_of.astype(np.int64) * n  # where a node's column begins; negative at leaves
    rows = np.flatnonzero(weights)
    at = np.zeros(rows.size, np.int64)
    for _ in range(level):
        begin = begins.take(at)
        inner = begin >= 0
        if not inner.all():
            rows, at, begin = rows[inner], at[inner], begin[inner]
        begin += rows
        at = child_of.take(at) + (flat.take(begin) > cut_of.take(at))
    place = np.full(len(column_of), -1)
    place[nodes] = np.arange(nodes.size)
    slot = place.take(at)
    here = slot >= 0
    if not here.all():
        rows, slot = rows[here], slot[here]
    first = slot * (bins * classes) + y.take(rows)
    keys = np.empty((picks.shape[1], rows.size), np.int64)
    for j, begin in enumerate(np.ascontiguousarray(picks.T) * np.int64(n)):
        np.add(first, flat.take(begin.take(slot) + rows) * np.int64(classes), out=keys[j])
    return keys, weights.take(rows).astype(float)


def best_splits(sums: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of nodes x columns x bins x classes: column (-1 without a split that lowers the Gini impurity),
    cut, impurity taken away times rows, counts left and right. Ties take the first column and bin."""
    passed = np.cumsum(sums.astype(float), 2)
    left, total = passed[:, :, :-1], passed[:, :, -1:]
    right = total - left

    def purity(c: np.ndarray) -> np.ndarray:
        n = c.sum(-1)
        return (c ** 2).sum(-1) / np.maximum(n, 1)

    gain = purity(left) + purity(right) - purity(total)
    gain[(left.sum(-1) == 0) | (right.sum(-1) == 0)] = 0
    m, _, cuts = gain.shape
    best = gain.reshape(m, -1).argmax(1)
    at, pick, cut = np.arange(m), best // cuts, best % cuts
    top = gain[at, pick, cut]
    good = top > 1e-9 * np.maximum(total[:, 0, 0].sum(-1), 1)
    return (np.where(good, picks[at, pick], -1), cut, np.where(good, top, 0.0),
            left[at, pick, cut], right[at, pick, cut])


class _ForestParams(Params):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels under the root", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a column", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of samples and column choice", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(numTrees=20, maxDepth=5, maxBins=32, seed=42)


class ForestClassifier(_ForestParams, Estimator):
    """Trees over rows drawn with replacement, each node choosing among the square root of the columns
    by Gini impurity, down to ``maxDepth`` levels or pure nodes.

    Columns are cut into bins by one scan for quantiles; rows become matrices of one byte per entry,
    which Spark keeps. One scan counts classes by (node, column, bin) for a level of all trees; the
    counts of a tree meet in one task, which picks its splits, and the driver sees only these. A scan
    has at most NODES nodes, so that no task holds more counts than that; a wider level takes more
    scans. Matrices are read by one task per core, as each task sends counts of its own.

    A tree depends on seed, its number and the matrices only: a smaller or flatter forest is a part
    of a larger one. ``fitMultiple`` grows one forest for all grid points that differ in these two.
    Null labels and null vectors are left out; without rows all classes are equally likely.
    """

    @keyword_only
    def __init__(self, *, numTrees: int = 20, maxDepth: int = 5, maxBins: int = 32, seed: int = 42):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ForestModel":
        classes, bins = len(LABELS), self.getOrDefault("maxBins")
        edges = column_edges(dataset.filter("label is not null"), bins)
        trees = [Tree.root(classes) for _ in range(self.getOrDefault("numTrees"))]
        if edges:
            shared = dataset.sparkSession.sparkContext.broadcast(edges)
            with kept(matrices(dataset).map(
                    lambda b: (b[0], b[1], coded(b[2], shared.value)))) as blocks:
                rows = sum(blocks.map(lambda b: b[1].size).collect())
                self._grow(blocks.coalesce(tasks_for(blocks, rows)), trees, len(edges))
        return self._copyValues(ForestModel(trees, edges))

    def _grow(self, blocks, trees: list[Tree], width: int) -> None:
        seed, classes = self.getOrDefault("seed"), len(LABELS)
        bins, picked = self.getOrDefault("maxBins"), int(np.ceil(np.sqrt(width)))
        open_ = {t: np.zeros(1, np.int64) for t in range(len(trees))}
        for level in range(self.getOrDefault("maxDepth")):
            # Trees are independent of each other: each has its own numbers.
            asked = [(t, nodes, np.sort(np.random.default_rng([seed, t, level, 1]).random(
                (nodes.size, width)).argsort(1)[:, :picked], 1)) for t, nodes in open_.items()]
            open_ = {}
            for scan in _scans(asked):
                parts = {t: (trees[t].column, trees[t].cut, trees[t].child) for t, *_ in scan}
                for t, nodes, found in _splits(blocks, scan, parts, level, seed, bins, classes):
                    column, cut, gain, left, right = found
                    if not level:
                        trees[t].counts[0] = left[0] + right[0]
                    good = column >= 0
                    more = trees[t].split(nodes[good], *(a[good] for a in found))
                    if more.size:
                        open_[t] = np.concatenate((open_.get(t, more[:0]), more))
            if not open_:
                break

    def fitMultiple(self, dataset: DataFrame, paramMaps) -> Iterator:  # noqa: N802
        """Grid points that differ in trees and depth are parts of one forest, grown once."""
        free, lock = {self.numTrees, self.maxDepth}, threading.Lock()
        each = [self.copy(p) for p in paramMaps]
        if any(set(p) - free for p in paramMaps):
            return super().fitMultiple(dataset, paramMaps)
        largest = self.copy({p: max((e.getOrDefault(p) for e in each), default=0) for p in free})
        grown: list[ForestModel] = []

        class Parts:
            todo = iter(range(len(each)))

            def __iter__(self):
                return self

            def __next__(self):
                with lock:
                    i = next(self.todo)
                    if not grown:
                        grown.append(largest.fit(dataset))
                return i, each[i]._copyValues(grown[0].part(
                    each[i].getOrDefault("numTrees"), each[i].getOrDefault("maxDepth")))
        return Parts()


def _scans(asked: list[tuple]) -> Iterator[list[tuple]]:
    """(tree, nodes, picks) in groups of at most NODES nodes."""
    group, n = [], 0
    for t, nodes, picks in asked:
        for k in range(0, nodes.size, NODES):
            part = t, nodes[k:k + NODES], picks[k:k + NODES]
            if n + part[1].size > NODES:
                yield group
                group, n = [], 0
            group.append(part)
            n += part[1].size
    if group:
        yield group


def _splits(blocks, scan: list[tuple], parts: dict, level: int, seed: int, bins: int,
            classes: int) -> list[tuple]:
    """(tree, nodes, splits) of one scan, tree by tree."""
    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        held = list(rows)
        for i, (t, nodes, picks) in enumerate(scan):
            m, width = picks.shape
            sums, keys, n = np.zeros((width, m * bins * classes)), [], 0
            for block in held:
                keys.append(node_keys(block, parts[t], level, nodes, picks,
                                      drawn(seed, t, block[0], block[1].size), bins, classes))
                n += keys[-1][0].size
                if n > HELD or block is held[-1]:
                    weights = np.concatenate([w for _, w in keys])
                    for j in range(width):
                        sums[j] += np.bincount(np.concatenate([k[j] for k, _ in keys]), weights,
                                               m * bins * classes)
                    keys, n = [], 0
            yield i, sums.astype(np.int32)

    def pick(entry: tuple) -> tuple:
        i, sums = entry
        picks = scan[i][2]
        return i, best_splits(sums.reshape(picks.shape[1], -1, bins, classes).swapaxes(0, 1), picks)

    found = dict(blocks.mapPartitions(count).reduceByKey(np.add, blocks.getNumPartitions()).map(
        pick).collect())
    return [(t, nodes, found[i]) for i, (t, nodes, _) in enumerate(scan) if i in found]


class ForestModel(_ForestParams, Model, MLReadable, MLWritable):
    """The mean of the class shares in the leaves a row reaches."""

    def __init__(self, trees: list[Tree] | None = None, edges: list[np.ndarray] | None = None):
        super().__init__()
        self.trees, self.edges = trees or [], edges or []

    @property
    def numClasses(self) -> int:  # noqa: N802
        return self.trees[0].counts.shape[1] if self.trees else len(LABELS)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Impurity taken away by each column, every tree counting alike, as shares."""
        total = np.zeros(len(self.edges))
        for t in self.trees:
            inner = t.column >= 0
            own = np.bincount(t.column[inner], t.gain[inner], total.size)
            total += own / max(own.sum(), 1e-300)
        return DenseVector(total / max(total.sum(), 1e-300))

    def part(self, trees: int, depth: int) -> "ForestModel":
        return ForestModel([t.cut_at(depth) for t in self.trees[:trees]], self.edges)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.numClasses))
        if self.edges:
            codes = coded(x, self.edges)
            for tree in self.trees:
                tree.add_shares(codes, out)
        total = out.sum(1, keepdims=True)
        return np.where(total > 0, out / np.maximum(total, 1e-300), 1 / self.numClasses)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(
            ForestShares(self.trees, self.edges, self.numClasses))
        return with_probabilities(dataset, lambda x: shared.value.probabilities(x))

    def copy(self, extra=None):
        copied = super().copy(extra)
        copied.trees, copied.edges = self.trees, self.edges
        return copied

    def write(self):
        return _ForestWriter(self)

    @classmethod
    def read(cls):
        return _ForestReader()


@dataclass
class ForestShares:
    """What tasks need of a model."""

    trees: list[Tree]
    edges: list[np.ndarray]
    numClasses: int  # noqa: N815
    probabilities = ForestModel.probabilities


class _ForestWriter(MLWriter):
    def __init__(self, instance: ForestModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        """Bounds of the bins with the metadata, one row per tree."""
        model = self.instance
        DefaultParamsWriter.saveMetadata(model, path, self.sparkSession, extraMetadata={
            "edges": json.dumps([e.tolist() for e in model.edges])})
        self.sparkSession.createDataFrame(
            [(i, t.column.tolist(), t.cut.tolist(), t.child.tolist(), t.counts.tolist(),
              t.gain.tolist()) for i, t in enumerate(model.trees)],
            "tree int, columns array<int>, cuts array<int>, children array<int>, "
            "counts array<array<double>>, gains array<double>").write.parquet(f"{path}/trees")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        model = ForestModel(
            [Tree(np.array(r.columns, np.int16), np.array(r.cuts).astype(np.uint8),
                  np.array(r.children, np.int32), np.array(r.counts), np.array(r.gains))
             for r in rows], [np.array(e) for e in json.loads(metadata["edges"])])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
