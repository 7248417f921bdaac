"""Multiclass boosting over binned columns: one softmax round grows a tree for every class."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermolens.operators.blocks import (ROWS, add_up, kept, matrices, softmax, tasks_for,
                                          with_probabilities)
from thermolens.schema import LABELS
from thermolens.session import shared_folder

#: Rounds after which scores are written, so that a lost executor costs no more of them.
CUT = 25
#: Combinations of bins that are counted at once, at most.
CELLS = 4096
#: Matrices that are joined for the rounds, as sums of a matrix cost the same for few rows.
JOINED = 4


@dataclass
class Trees:
    """One tree per class as complete binary trees, node i having the children 2i+1 and 2i+2.

    ``column`` is -1 at leaves; rows with a code over ``cut`` go to the second child.
    """

    column: np.ndarray  # classes x nodes
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, classes: int, depth: int) -> "Trees":
        shape = classes, 2 ** (depth + 1) - 1
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.uint8), np.zeros(shape))

    def node(self, codes: np.ndarray, k: int, levels: int) -> np.ndarray:
        """Where the rows of ``codes`` (columns x rows) stand in tree k after some levels."""
        at = np.zeros(codes.shape[1], np.int64)
        every = np.arange(at.size)
        for _ in range(levels):
            column = self.column[k][at]
            further = 2 * at + 1 + (codes[column, every] > self.cut[k][at])
            at = np.where(column >= 0, further, at)
        return at

    @property
    def depth(self) -> int:
        return (self.value.shape[1] + 1).bit_length() - 2

    def values(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([self.value[k][self.node(codes, k, self.depth)]
                         for k in range(len(self.value))], 1)


def column_edges(df: DataFrame, bins: int, features: str = "features") -> list[np.ndarray]:
    """Up to ``bins`` - 1 upper bounds of bins per column, from approximate quantiles in one scan;
    a value equal to a bound belongs to the bin below it. A column of few values gets one bin each."""
    rows = df.select(vector_to_array(features).alias("x")).filter("x is not null")
    first = rows.first()
    if first is None:
        return []
    steps = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[i], steps, 20 * bins).alias(f"c{i}")
                       for i in range(len(first["x"]))]).first()
    return [np.unique(np.array(edges, float)) for edges in found]


def coded(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers, columns x rows."""
    return np.stack([np.searchsorted(e, x[:, c]).astype(np.uint8) for c, e in enumerate(edges)])


def column_groups(offsets: np.ndarray) -> list[list[int]]:
    """Neighbouring columns whose bins make at most CELLS combinations."""
    groups, cells = [], CELLS + 1
    for c, size in enumerate(np.diff(offsets).tolist()):
        if cells * size > CELLS:
            groups.append([])
            cells = 1
        groups[-1].append(c)
        cells *= size
    return groups


def histograms(codes: np.ndarray, y: np.ndarray, raw: np.ndarray, trees: Trees, level: int,
               active: list[np.ndarray], offsets: np.ndarray) -> list[np.ndarray]:
    """Sums of gradients and Hessians per class: active node x (column, bin).

    Columns are added up in groups, by the combination of their bins, and told apart afterwards."""
    shares, width = np.ascontiguousarray(softmax(raw.astype(float)).T), int(offsets[-1])
    groups = []
    for columns in column_groups(offsets):
        sizes = [int(offsets[c + 1] - offsets[c]) for c in columns]
        joint = codes[columns[0]]
        for c, size in zip(columns[1:], sizes[1:]):
            joint = joint.astype(np.uint16) * np.uint16(size) + codes[c]
        groups.append((columns, sizes, joint))
    out = []
    for k, nodes in enumerate(active):
        p, own, rows = shares[k], y == k, None
        if level:
            place = np.full(trees.value.shape[1], -1)
            place[nodes] = np.arange(nodes.size)
            at = place[trees.node(codes, k, level)]
            rows = np.flatnonzero(at >= 0)
            at, p, own = at[rows], p[rows], own[rows]
        slope, bend = p - own, p * (1 - p)
        sums = np.zeros((2, nodes.size, width))
        for columns, sizes, joint in groups if nodes.size else ():
            cells = int(np.prod(sizes))
            key = joint if rows is None else at * cells + joint[rows]
            for side, weights in enumerate((slope, bend)):
                found = np.bincount(key, weights, nodes.size * cells).reshape(-1, *sizes)
                for i, c in enumerate(columns):
                    others = tuple(j + 1 for j in range(len(columns)) if j != i)
                    sums[side, :, offsets[c]:offsets[c + 1]] = found.sum(others)
        out.append(sums)
    return out


def best_splits(sums: np.ndarray, offsets: np.ndarray, ridge: float, least: float):
    """For every node the gain, column and cut of its best split, by second-order gains. Both sides
    need a Hessian of ``least``; without such a split the gain is 0."""
    passed = np.cumsum(sums, 2)
    begins = np.repeat(offsets[:-1], np.diff(offsets))
    before = np.concatenate((np.zeros((*sums.shape[:2], 1)), passed), 2)[:, :, begins]
    left = passed - before
    total = left[:, :, offsets[1] - 1:offsets[1]]
    right = total - left

    def part(s: np.ndarray) -> np.ndarray:
        return s[0] ** 2 / (s[1] + ridge)

    gain = part(left) + part(right) - part(total)
    gain[(left[1] < least) | (right[1] < least)] = 0
    best = gain.argmax(1)
    column = np.searchsorted(offsets, best, "right") - 1
    return gain.max(1), column, best - offsets[column], total[:, :, 0]


def grow(scored: RDD, classes: int, offsets: np.ndarray, depth: int, rate: float, ridge: float,
         least: float) -> Trees:
    """One round: all classes' trees, a level of all of them in one job."""
    trees = Trees.empty(classes, depth)
    # The nodes whose sums are asked for, and the sums of their parents.
    asked = [np.zeros(1, np.int64) for _ in range(classes)]
    parents: list[np.ndarray | None] = [None] * classes
    for level in range(depth):
        def work(block: tuple) -> list[np.ndarray]:
            y, codes, raw = block
            return histograms(codes, y, raw, trees, level, asked, offsets)  # noqa: B023

        found = add_up(scored, work)
        for k, (nodes, sums) in enumerate(zip(asked, found)):
            if parents[k] is not None:  # a sibling has what its parent has beyond the node
                sums = np.concatenate((sums, parents[k] - sums), 1)
                nodes = np.concatenate((nodes, np.where(nodes % 2, nodes + 1, nodes - 1)))
            gain, column, cut, total = best_splits(sums, offsets, ridge, least)
            if not level:
                trees.value[k, 0] = -rate * total[0, 0] / (total[1, 0] + ridge)
            split = gain > 1e-9
            at, column, cut = nodes[split], column[split], cut[split]
            trees.column[k, at], trees.cut[k, at] = column, cut
            passed = np.cumsum(sums[:, split], 2)
            ends, begins = offsets[column] + cut, offsets[column]
            rows = np.arange(at.size)
            first = passed[:, rows, ends] - np.where(begins > 0, passed[:, rows, begins - 1], 0)
            second = total[:, split] - first
            trees.value[k, 2 * at + 1] = -rate * first[0] / (first[1] + ridge)
            trees.value[k, 2 * at + 2] = -rate * second[0] / (second[1] + ridge)
            # Where neither child can be split, both are leaves.
            wide = np.maximum(first[1], second[1]) >= 2 * least
            asked[k] = np.where(first[1] <= second[1], 2 * at + 1, 2 * at + 2)[wide]
            parents[k] = sums[:, split][:, wide]
        if not any(nodes.size for nodes in asked):
            break
    return trees


@dataclass
class BoostedTreesModel:
    """What a fit leaves: bounds of the bins, one score per class to begin with, and the rounds."""

    edges: list[np.ndarray]
    base: np.ndarray
    rounds: list[Trees]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        raw = np.tile(self.base, (len(x), 1))
        if self.rounds:
            codes = coded(x, self.edges)
            for trees in self.rounds:
                raw += trees.values(codes)
        return softmax(raw)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with the probability of every class and the likeliest class."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        return with_probabilities(df, lambda x: shared.value.probabilities(x), features)

    def gains(self) -> np.ndarray:
        """How many splits each column has, as shares."""
        counts = sum((np.bincount(t.column[t.column >= 0], minlength=len(self.edges))
                      for t in self.rounds), np.zeros(len(self.edges)))
        return counts / max(counts.sum(), 1)

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per round, with bounds and first scores in a row of their own."""
        rows = [(-1, [0.0], [e.tolist() for e in self.edges], [self.base.tolist()])] + [
            (i, t.column.astype(float).ravel().tolist(), t.cut.astype(float).tolist(),
             t.value.tolist()) for i, t in enumerate(self.rounds)]
        spark.createDataFrame(rows, "round int, columns array<double>, cuts array<array<double>>, "
                                    "leaves array<array<double>>").write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedTreesModel":
        first, *rounds = spark.read.parquet(path).orderBy("round").collect()
        return cls([np.array(e) for e in first.cuts], np.array(first.leaves[0]),
                   [Trees(np.array(r.columns, np.int16).reshape(len(r.cuts), -1),
                          np.array(r.cuts).astype(np.uint8), np.array(r.leaves)) for r in rounds])


@dataclass
class BoostedTrees:
    """Boosting by second-order softmax rounds.

    Columns are cut into at most ``bins`` bins by one scan for quantiles; rows become matrices of
    one byte per entry, which Spark keeps. A round grows one tree per class, all classes a level at
    a time: one job adds up gradients and Hessians by (node, column, bin) in every task, and the
    driver, which sees only these sums, picks the splits. The rows' scores are kept beside them and
    move on by one round at a time; every CUT rounds they are written to the shared folder.

    A class without rows gets a probability near 0. Without rows, or with one class, there are no
    trees. Null labels and null vectors are left out. Equal gains take the first column and bin.
    """

    rounds: int = 100
    depth: int = 5
    rate: float = 0.1
    bins: int = 64
    ridge: float = 1.0
    least_hessian: float = 1.0
    classes: int = len(LABELS)

    def fit(self, df: DataFrame) -> BoostedTreesModel:
        edges = column_edges(df.filter("label is not null"), self.bins)
        spark = df.sparkSession
        if not edges:
            return BoostedTreesModel([], np.zeros(self.classes), [])
        shared = spark.sparkContext.broadcast(edges)
        blocks = matrices(df).map(lambda b: (b[1], coded(b[2], shared.value)))
        offsets = np.concatenate(([0], np.cumsum([e.size + 1 for e in edges])))
        shared_folder(spark)  # sets the folder of checkpoints
        with kept(blocks):
            counts = add_up(blocks, lambda b: [np.bincount(b[0], minlength=self.classes)])[0]
            tasks = tasks_for(blocks, int(counts.sum()))
            base = np.log((counts + 1e-3) / (counts.sum() + 1e-3 * self.classes))
            rounds: list[Trees] = []
            scored, old = blocks.coalesce(tasks).mapPartitions(_joined).map(
                lambda b: (*b, np.tile(base.astype(np.float32), (b[0].size, 1)))), []
            for i in range(self.rounds if (counts > 0).sum() > 1 else 0):
                scored.persist(StorageLevel.MEMORY_AND_DISK)
                if i and i % CUT == 0:
                    scored.checkpoint()
                rounds.append(grow(scored, self.classes, offsets, self.depth, self.rate,
                                   self.ridge, self.least_hessian))
                for rdd in old:  # the first job of this round has read them
                    rdd.unpersist()
                if (rounds[-1].column < 0).all():
                    break
                old, scored = [scored], scored.map(_add_round(rounds[-1]))
            for rdd in old:
                rdd.unpersist()
            scored.unpersist()
        return BoostedTreesModel(edges, base, rounds)


def _joined(blocks: Iterator[tuple]) -> Iterator[tuple]:
    """(y, codes) of up to JOINED full matrices in one."""
    held, n = [], 0
    for block in blocks:
        if n + block[0].size > JOINED * ROWS:
            yield np.concatenate([b[0] for b in held]), np.concatenate([b[1] for b in held], 1)
            held, n = [], 0
        held.append(block)
        n += block[0].size
    if held:
        yield np.concatenate([b[0] for b in held]), np.concatenate([b[1] for b in held], 1)


def _add_round(trees: Trees):
    def add(block: tuple) -> tuple:
        y, codes, raw = block
        return y, codes, raw + trees.values(codes).astype(np.float32)
    return add
