"""Rows as numpy matrices: what a model reads many times, packed once and kept by Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one matrix.
ROWS = 32_768
#: Rows that one task of a fit reads, at most; below that a fit has a task per core.
TASK_ROWS = 2 ** 21
#: With more partitions than this, partial results are added up in tasks before the driver's turn.
DIRECT = 64


def packed(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """(n, y, x): matrices of up to ROWS rows, y as 32-bit and x as 64-bit numbers, row by row."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out() -> pa.RecordBatch:
            y = np.concatenate([b["y"].to_numpy(zero_copy_only=False) for b in held])
            x = np.concatenate([b["x"].flatten().to_numpy(zero_copy_only=False) for b in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([y.size], pa.int32()), pa.array([y.astype("<i4").tobytes()]),
                 pa.array([x.astype("<f8").tobytes()])], ["n", "y", "x"])

        for batch in batches:
            for k in range(0, len(batch), ROWS):
                part = batch.slice(k, ROWS)
                if n + len(part) > ROWS:
                    yield out()
                    held, n = [], 0
                held.append(part)
                n += len(part)
        if n:
            yield out()

    rows = df.select(F.col(label).cast("int").alias("y"), vector_to_array(features).alias("x"))
    return rows.filter("y is not null and x is not null").mapInArrow(
        pack, "n int, y binary, x binary")


@contextmanager
def kept(rows: RDD) -> Iterator[RDD]:
    """Keep matrices for the length of a fit; lost ones are made again."""
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def matrices(df: DataFrame, features: str = "features", label: str = "label") -> RDD:
    """(number, y, x) of every matrix. This is one of the few places for an RDD: a fit runs hundreds
    of small jobs over the same matrices, and a row of them is a whole block of readings."""
    def unpack(part: int, rows: Iterator) -> Iterator[tuple]:
        for k, r in enumerate(rows):
            x = np.frombuffer(r.x, "<f8")
            yield (part, k), np.frombuffer(r.y, "<i4"), x.reshape(r.n, -1) if r.n else x
    return packed(df, features, label).rdd.mapPartitionsWithIndex(unpack)


def tasks_for(blocks: RDD, rows: int) -> int:
    """How many tasks shall read the matrices of ``rows`` rows: every one sends sums of its own, so
    their number follows the cores, not the partitions. Small tables need no more tasks than half
    full matrices, and large ones as many as keep a task's rows bounded."""
    wanted = max(blocks.context.defaultParallelism, -(-rows // TASK_ROWS))
    return max(1, min(blocks.getNumPartitions(), wanted, -(-2 * rows // ROWS)))


def add_up(blocks: RDD, work: Callable[[tuple], Sequence[np.ndarray]]) -> list[np.ndarray] | None:
    """The sums, array by array, of what ``work`` gives for every block; None without blocks."""
    def both(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> list[np.ndarray]:
        return [x + y for x, y in zip(a, b)]

    def partial(rows: Iterator[tuple]) -> Iterator[list[np.ndarray]]:
        total = None
        for row in rows:
            total = work(row) if total is None else both(total, work(row))
        if total is not None:
            yield total

    sums = blocks.mapPartitions(partial)
    if blocks.getNumPartitions() > DIRECT:
        return sums.treeAggregate(None, lambda a, b: b if a is None else both(a, b),
                                  lambda a, b: b if a is None else a if b is None else both(a, b))
    found = sums.collect()
    return reduce(both, found) if found else None


def with_probabilities(df: DataFrame, score: Callable[[np.ndarray], np.ndarray],
                       features: str = "features") -> DataFrame:
    """``df`` with ``probability`` (vector) and ``prediction`` (the first of the likeliest classes,
    as a double). ``score`` turns a matrix of rows into a matrix of probabilities."""
    @F.arrow_udf("array<double>")
    def shares(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = batch.flatten().to_numpy(zero_copy_only=False)
            made = score(x.reshape(len(batch), -1)) if len(batch) else np.zeros((0, 1))
            ends = np.arange(len(batch) + 1, dtype=np.int32) * made.shape[1]
            yield pa.ListArray.from_arrays(ends, pa.array(made.ravel()))

    told = df.withColumn("probability", shares(vector_to_array(features)))
    best = F.array_position("probability", F.array_max("probability")) - 1
    return told.withColumn("prediction", best.cast("double")).withColumn(
        "probability", array_to_vector("probability"))


def softmax(raw: np.ndarray) -> np.ndarray:
    """Shares along the last axis."""
    e = np.exp(raw - raw.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)
