"""Pearson correlations of any number of columns in one scan, by masked Gram matrices."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolens.operators.features import add_label_indicators
from thermolens.schema import ENGINEERED, LABELS, TARGET

#: What is added up for a pair, over the rows where both values exist: how many rows, the values,
#: their squares, and the products.
SUMS = ("n", "x", "y", "xx", "yy", "xy")
#: A sum of squares around the mean that is less than this part of the one around the origin is
#: rounding: the value is constant.
NOISE = 1e-13
#: Rows whose mean is the origin. Another origin gives the same sums, but for rounding.
HEAD = 1000


def _some_mean(values: np.ndarray) -> float:
    values = values[np.isfinite(values)]
    # one of the values, so that a constant column has no deviations at all
    return float(values[np.abs(values - values.mean()).argmin()]) if values.size else 0.0


def pair_sums(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """(i, j, SUMS) for every column of ``left`` and ``right``, by position; where both lists are
    the same, for i <= j.

    Every task multiplies matrices of values and of presence masks, in which a missing value is 0,
    and sends one row per pair, whatever number of rows it has read. Values are taken relative to
    those of the first row, so that large means do not drown small deviations. Null and NaN are
    missing.
    """
    columns = list(dict.fromkeys([*left, *right]))
    doubles = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    head = doubles.limit(HEAD).toArrow()
    origin = np.array([_some_mean(c.to_numpy()) for c in head.columns])
    at_left, at_right = ([columns.index(c) for c in side] for side in (left, right))
    same = list(left) == list(right)
    pairs = np.triu_indices(len(left)) if same else tuple(
        k.ravel() for k in np.indices((len(left), len(right))))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), len(left), len(right)))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            there = ~np.isnan(x)
            x = np.where(there, x - origin, 0.0)
            there = there.astype(float)
            a, b = x[:, at_left], x[:, at_right]
            in_a, in_b = there[:, at_left], there[:, at_right]
            total[0] += in_a.T @ in_b
            total[1] += a.T @ in_b
            total[3] += (a * a).T @ in_b
            total[5] += a.T @ b
            if not same:
                total[2] += in_a.T @ b
                total[4] += in_a.T @ (b * b)
        if same:
            total[2], total[4] = total[1].T, total[3].T
        yield pa.RecordBatch.from_arrays(
            [pa.array(k.astype(np.int32)) for k in pairs] + [pa.array(s[pairs]) for s in total],
            ["i", "j", *SUMS])

    parts = doubles.mapInArrow(
        multiply, "i int, j int, " + ", ".join(f"{s} double" for s in SUMS))
    return parts.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])


def correlations(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """(a, b, r) for every column of ``left`` with every one of ``right``, over the rows where both
    exist. A correlation that is undefined (no common rows, or a constant) is 0.0."""
    sums = pair_sums(df, left, right)
    n, x, y = F.col("n"), F.col("x"), F.col("y")

    def around_mean(squares: str, s: Column) -> Column:
        spread = F.col(squares) - F.try_divide(s * s, n)
        return F.when(spread > F.col(squares) * NOISE, spread)

    r = F.try_divide(F.col("xy") - F.try_divide(x * y, n),
                     F.sqrt(around_mean("xx", x)) * F.sqrt(around_mean("yy", y)))
    names_a, names_b = (F.array(*[F.lit(c) for c in side]) for side in (left, right))
    told = sums.select(
        F.get(names_a, F.col("i")).alias("a"), F.get(names_b, F.col("j")).alias("b"),
        F.greatest(F.least(F.coalesce(r, F.lit(0.0)), F.lit(1.0)), F.lit(-1.0)).alias("r"), "i", "j")
    if list(left) != list(right):
        return told.select("a", "b", "r")
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    once = F.array(F.struct("a", "b"))
    return told.select("r", F.explode(F.when(F.col("i") == F.col("j"), once).otherwise(both))
                       .alias("p")).select("p.a", "p.b", "r")


def _with_indicators(df: DataFrame, features: Sequence[str], labels: Sequence[str],
                     target: str) -> tuple[DataFrame, list[str]]:
    made = add_label_indicators(df.select(*features, target), target, labels)
    return made, [f"state_{label}" for label in labels]


def correlation_matrix(df: DataFrame, features: Sequence[str] = ENGINEERED,
                       labels: Sequence[str] = LABELS, target: str = TARGET) -> DataFrame:
    """The full symmetric matrix of the features and one indicator per class, as (a, b, r)."""
    made, states = _with_indicators(df, features, labels, target)
    return correlations(made, [*features, *states], [*features, *states])


def _strongest_first(found: DataFrame, states: Sequence[str]) -> DataFrame:
    wide = found.groupBy(F.col("a").alias("feature")).agg(
        *[F.max(F.when(F.col("b") == s, F.col("r"))).alias(s) for s in states])
    strongest = F.greatest(*[F.abs(F.col(s)) for s in states])
    return (wide.withColumn("max_abs_class_correlation", strongest)
            .orderBy(F.desc("max_abs_class_correlation"), "feature"))


def association_of(matrix: DataFrame, features: Sequence[str] = ENGINEERED,
                   labels: Sequence[str] = LABELS) -> DataFrame:
    """Each feature's correlation with every class, strongest association first: a part of a
    matrix that is there already."""
    states = [f"state_{label}" for label in labels]
    return _strongest_first(
        matrix.filter(F.col("a").isin(*features) & F.col("b").isin(*states)), states)


def class_association(df: DataFrame, features: Sequence[str] = ENGINEERED,
                      labels: Sequence[str] = LABELS, target: str = TARGET) -> DataFrame:
    """Each feature's correlation with every class, strongest association first; only these cells
    are computed."""
    made, states = _with_indicators(df, features, labels, target)
    return _strongest_first(correlations(made, list(features), states), states)
