"""Multinomial logistic regression by Newton steps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from thermolens.operators.blocks import add_up, kept, matrices, softmax, with_probabilities
from thermolens.schema import LABELS

#: Rows whose Hessian products are formed at a time.
PART = 8192


def derivatives(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Loss, gradient (classes x entries) and Hessian (classes x classes x entries x entries) of one
    matrix, summed over rows. The last entry of ``weights`` is the intercept's."""
    classes, width = weights.shape
    loss, slope = np.zeros(1), np.zeros((classes, width))
    bend = np.zeros((classes, classes, width, width))
    for k in range(0, len(x), PART):
        rows = np.column_stack((x[k:k + PART], np.ones(len(x[k:k + PART]))))
        shares, own = softmax(rows @ weights.T), y[k:k + PART]
        at = np.arange(own.size)
        loss -= np.log(np.maximum(shares[at, own], 1e-300)).sum()
        for i in range(classes):
            slope[i] += (shares[:, i] - (own == i)) @ rows
        for i in range(classes - 1):
            for j in range(i + 1):
                both = (shares[:, i] * ((i == j) - shares[:, j]))[:, None]
                bend[i, j] += rows.T @ (rows * both)
    # Shares add up to 1, so the blocks of a class add up to 0: the last ones follow.
    last = classes - 1
    for i in range(last):
        for j in range(i):
            bend[j, i] = bend[i, j]
    for i in range(classes):
        bend[i, last] = -bend[i, :last].sum(0)
        bend[last, i] = bend[i, last]
    return [loss, slope, bend]


@dataclass
class SoftmaxModel:
    """Coefficients (classes x entries) and intercepts, which add up to 0; ``steps`` scans were
    needed, and the largest entry of the last gradient was ``slope``."""

    coefficients: np.ndarray
    intercepts: np.ndarray
    steps: int = 0
    slope: float = 0.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(x @ self.coefficients.T + self.intercepts)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with the probability of every class and the likeliest class."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        return with_probabilities(df, lambda x: shared.value.probabilities(x), features)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(i, c.tolist(), float(b)) for i, (c, b) in enumerate(
            zip(self.coefficients, self.intercepts))],
            "class int, coefficients array<double>, intercept double").write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SoftmaxModel":
        rows = spark.read.parquet(path).orderBy("class").collect()
        return cls(np.array([r.coefficients for r in rows]), np.array([r.intercept for r in rows]))


@dataclass
class SoftmaxRegression:
    """Least mean log-loss plus ``penalty`` / 2 times the squared coefficients (intercepts are free).

    Each step is one scan of the kept matrices, in which tasks add up the loss, its slope and its
    Hessian; the driver solves a system of (entries + 1) x classes. A step that does not lower the
    loss is halved. The fit ends when no entry of the slope is over ``tolerance``. Newton steps need
    a dozen scans where a first-order method needs hundreds, and the product of the two bounds what
    a task sends, so vectors should have at most some thousand entries.

    Null labels and null vectors are left out. Without rows all coefficients are 0 and all classes
    equally likely; the intercept of a class without rows falls until the slope is small enough.
    """

    penalty: float | None = None  # 1 / rows if not given
    tolerance: float = 1e-9
    most_steps: int = 100
    classes: int = len(LABELS)

    def fit(self, df: DataFrame) -> SoftmaxModel:
        blocks = matrices(df)
        with kept(blocks):
            sizes = add_up(blocks, lambda b: [np.array([b[2].shape[0]])])
            if sizes is None or not sizes[0][0]:
                first = df.select("features").first()
                width = len(first["features"]) if first and first["features"] is not None else 0
                return SoftmaxModel(np.zeros((self.classes, width)), np.zeros(self.classes))
            n = int(sizes[0][0])
            width = blocks.map(lambda b: b[2].shape[1]).max() + 1
            penalty = np.full(width, self.penalty if self.penalty is not None else 1 / n)
            penalty[-1] = 0

            def at(weights: np.ndarray):
                loss, slope, bend = add_up(blocks, lambda b: derivatives(b[2], b[1], weights))
                ridge = np.zeros_like(bend)
                for i in range(self.classes):
                    ridge[i, i] = np.diag(penalty)
                size = self.classes * width
                return (loss[0] / n + (penalty * weights ** 2).sum() / 2,
                        slope / n + penalty * weights,
                        (bend / n + ridge).transpose(0, 2, 1, 3).reshape(size, size))

            weights, steps = np.zeros((self.classes, width)), 1
            loss, slope, bend = at(weights)
            while np.abs(slope).max() > self.tolerance and steps < self.most_steps:
                # Intercepts may move together without effect; the shortest step leaves that out.
                step = np.linalg.lstsq(bend, slope.ravel(), rcond=1e-14)[0].reshape(weights.shape)
                share = 1.0
                while steps < self.most_steps:
                    tried = weights - share * step
                    found = at(tried)
                    steps += 1
                    if found[0] <= loss + 1e-15 * abs(loss) or share < 1e-6:
                        break
                    share /= 2
                if found[0] > loss + 1e-12 * abs(loss):
                    break  # the loss cannot be lowered any more
                weights, (loss, slope, bend) = tried, found
        intercepts = weights[:, -1] - weights[:, -1].mean()
        return SoftmaxModel(weights[:, :-1].copy(), intercepts, steps, float(np.abs(slope).max()))
