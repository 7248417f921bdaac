"""Embedding whitening from the exact characteristic polynomial of the integer scatter."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import comb, gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from thermolens.llm.common import partitions

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Rows that are multiplied at a time, and bits of the parts they are split into: their products
#: and sums are whole numbers that a double holds exactly.
ROWS, LIMB = 4096, 20
#: Largest size of a whole number that an entry may become.
LARGEST = 1 << 44
#: Bits of the roots below the trace of the scatter, and digits of the vectors' arithmetic.
BITS, DIGITS = 160, 70


# --- the scatter, exact -------------------------------------------------------------------------

def vectors(table: DataFrame, vec_id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id and vector (doubles) of the rows whose vector is neither null nor holds nulls, NaN or
    infinite entries."""
    doubles = F.col(column).cast("array<double>")
    return table.select(F.col(vec_id).cast("long").alias("vec_id"), doubles.alias("vector")).filter(
        F.col("vector").isNotNull() & F.forall(
            "vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))


def whole_numbers(batch: pa.RecordBatch) -> np.ndarray:
    """floor(SCALE * c) of a batch's vectors, one row each."""
    flat = batch["vector"].flatten().to_numpy(zero_copy_only=False)
    y = np.floor(SCALE * flat)
    if y.size and np.abs(y).max() >= LARGEST:
        raise OverflowError(f"an embedding has an entry beyond {LARGEST // SCALE}")
    return y.reshape(len(batch), -1)


def gram(y: np.ndarray) -> np.ndarray:
    """The exact products of columns, as Python integers. ``y`` holds whole numbers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for k in range(0, len(y), ROWS):
        rest, limbs = y[k:k + ROWS], []
        while True:
            high = np.floor(rest / (1 << LIMB))
            if ((high == 0) | (high == -1)).all():  # the last part keeps the sign
                limbs.append(rest)
                break
            limbs.append(rest - high * (1 << LIMB))
            rest = high
        for i, left in enumerate(limbs):
            for j, right in enumerate(limbs):
                part = (left.T @ right).astype(np.int64).astype(object)
                total += part << LIMB * (i + j) if i + j else part
    return total


@dataclass
class Scatter:
    """n, the sums T of y = x - SHIFT, and the matrix n * sum(y y') - T T', which is n * n * V."""

    n: int
    sums: list[int]
    matrix: np.ndarray


def scatter(rows: DataFrame) -> Scatter:
    """Partial products of every task are added up by entry of the matrix in Spark; what comes to
    the driver is the matrix, whose size is that of one vector squared. Only vectors of the most
    frequent length count (of equally frequent ones, the longest); see ``whiten``."""
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(
        F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    if not d:
        return Scatter(0, [], np.zeros((0, 0), object))
    upper = np.triu_indices(d)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            y = whole_numbers(batch)
            n += len(y)
            for k in range(0, len(y), ROWS):
                sums = sums + y[k:k + ROWS].sum(0).astype(np.int64).astype(object)
            total = total + gram(y)
        if n:
            values = [n, *sums, *total[upper]]
            places = np.concatenate(([-1 - d], np.arange(-d, 0), upper[0] * d + upper[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int64()), pa.array(values, pa.decimal128(38, 0))],
                ["place", "value"])

    added = rows.filter(F.size("vector") == d).select("vector").mapInArrow(
        products, "place long, value decimal(38,0)").groupBy("place").agg(F.sum("value"))
    found = {place: int(value) for place, value in added.collect()}
    n, sums = found[-1 - d], [found[k - d] for k in range(d)]
    matrix = np.empty((d, d), object)
    for i, j in zip(*upper):
        matrix[i, j] = matrix[j, i] = n * found[i * d + j] - sums[i] * sums[j]
    return Scatter(n, sums, matrix)


# --- its characteristic polynomial --------------------------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin with the bases that settle all numbers below 2**32."""
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        if n == base:
            return True
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any(
                (x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes(product: int) -> list[int]:
    """Primes below 2**31, largest first, whose product is over ``product``."""
    found, passed, n = [], 1, (1 << 31) - 1
    while passed <= product:
        if is_prime(n):
            found.append(n)
            passed *= n
        n -= 2
    return found


def hessenberg_polynomial(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients modulo p of the monic det(x I - matrix), the constant one first.

    Similar row and column operations empty the columns below the subdiagonal; the polynomials of
    the leading blocks then follow from one another. Products of residues stay below 2**62.
    """
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for k in range(1, d - 1):
        pivot = np.flatnonzero(h[k:, k - 1])
        if not pivot.size:
            continue
        at = k + int(pivot[0])
        if at != k:
            h[[k, at]] = h[[at, k]]
            h[:, [k, at]] = h[:, [at, k]]
        factors = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factors[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factors % p).sum(1)) % p
    blocks = np.zeros((d + 1, d + 1), np.int64)
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        blocks[k, 1:] = blocks[k - 1, :-1]
        blocks[k] = (blocks[k] - h[k - 1, k - 1] * blocks[k - 1]) % p
        below = 1
        for i in range(k - 1, 0, -1):
            below = below * int(h[i, i - 1]) % p
            if not below:
                break
            blocks[k] = (blocks[k] - below * int(h[i - 1, k - 1]) % p * blocks[i - 1]) % p
    return blocks[d]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Whole coefficients of det(x I - matrix) for a matrix without negative eigenvalues, the
    constant one first.

    Each of as many primes as the coefficients can need is one row of a Spark job. The k-th
    elementary symmetric sum of eigenvalues with the trace t is at most comb(d, k) * (t / d)**k, and
    so the sum of all of them at most (1 + t / d)**d.
    """
    d = len(matrix)
    trace = sum(matrix[i, i] for i in range(d))
    moduli = primes(2 * (2 + trace // d) ** d)
    shared = spark.sparkContext.broadcast(matrix)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hessenberg_polynomial(shared.value, p) for p in batch["p"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["p"], pa.array(found, pa.list_(pa.int64()))], ["p", "residues"])

    rows = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(
        min(len(moduli), partitions(spark)), "p").mapInArrow(reduce, "p long, residues array<long>")
    whole, modulus = [0] * (d + 1), 1
    for p, residues in rows.collect():  # Chinese remainders, one prime after the other
        inverse = pow(modulus, -1, p)
        whole = [w + modulus * ((r - w) * inverse % p) for w, r in zip(whole, residues)]
        modulus *= p
    return [w - modulus if 2 * w > modulus else w for w in whole]


# --- its roots ----------------------------------------------------------------------------------

def roots_above(coefficients: list[int], a: int) -> int:
    """How many roots of a polynomial with only real roots are over ``a``: the changes of sign among
    the coefficients of p(x + a), by Descartes' rule, which is exact for such a polynomial."""
    shifted = coefficients[::-1]
    if a:
        for k in range(len(shifted) - 1, 0, -1):
            value = 0
            for i in range(k + 1):
                value = shifted[i] = shifted[i] + a * value
    signs = [c > 0 for c in shifted if c]
    return sum(s != t for s, t in zip(signs, signs[1:]))


def _sign(coefficients: list[int], x: int) -> int:
    value = 0
    for c in reversed(coefficients):
        value = value * x + c
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], bound: int, wanted: int) -> list[tuple[int, int]]:
    """The ``wanted`` largest positive roots as (x, multiplicity): each is in (x, x + 1].

    All roots are real and in [0, bound]. Intervals are halved, and counted by ``roots_above``, until
    each holds one root, or is one wide and holds all roots that cannot be told apart there. One
    root is then closed in on by signs.
    """
    found, taken = [], 0
    waiting = [(0, bound, roots_above(coefficients, 0), 0)]  # the rightmost interval on top
    while waiting and taken < wanted:
        low, high, above_low, above_high = waiting.pop()
        count = above_low - above_high
        if not count:
            continue
        if count == 1:
            right = _sign(coefficients, high)
            while right and high - low > 1:
                middle = (low + high) // 2
                sign = _sign(coefficients, middle)
                if sign == 0:
                    low, high = middle - 1, middle
                elif sign == right:
                    high = middle
                else:
                    low = middle
            if not right:
                low = high - 1
        if count == 1 or high - low <= 1:
            found.append((low, count))
            taken += count
            continue
        middle = (low + high) // 2
        above = roots_above(coefficients, middle)
        waiting.append((low, middle, above_low, above))
        waiting.append((middle, high, above, above_high))
    return found


# --- its vectors --------------------------------------------------------------------------------

def null_space(matrix: np.ndarray, root: Decimal, size: int) -> np.ndarray:
    """Orthonormal vectors that ``matrix`` - root * I hardly stretches, as many as the root's
    multiplicity: random vectors after steps of inverse iteration, in DIGITS digits."""
    with localcontext() as context:
        context.prec = DIGITS
        d = len(matrix)
        lower = np.array([[Decimal(int(v)) for v in row] for row in matrix], object)
        lower[np.arange(d), np.arange(d)] -= root
        largest = max(abs(v) for v in lower.ravel()) or Decimal(1)
        order = np.arange(d)
        for k in range(d):  # LU with partial pivoting, in place
            at = k + max(range(d - k), key=lambda i: abs(lower[k + i, k]))
            lower[[k, at]], order[[k, at]] = lower[[at, k]], order[[at, k]]
            if not lower[k, k]:
                lower[k, k] = largest * Decimal(10) ** (10 - DIGITS)
            lower[k + 1:, k] = lower[k + 1:, k] / lower[k, k]
            lower[k + 1:, k + 1:] = lower[k + 1:, k + 1:] - np.outer(
                lower[k + 1:, k], lower[k, k + 1:])
        start = np.random.default_rng(d).standard_normal((d, size))
        block = np.array([[Decimal(float(v)) for v in row] for row in start], object)
        for _ in range(3):
            block = block[order]
            for k in range(d):
                block[k + 1:] = block[k + 1:] - np.outer(lower[k + 1:, k], block[k])
            for k in range(d - 1, -1, -1):
                block[k] = (block[k] - lower[k, k + 1:] @ block[k + 1:]) / lower[k, k]
            for j in range(size):
                for _ in range(2):
                    for i in range(j):
                        block[:, j] = block[:, j] - block[:, i] * (block[:, i] @ block[:, j])
                    block[:, j] = block[:, j] / (block[:, j] @ block[:, j]).sqrt()
        vectors = block.astype(np.float64)
    # either sign will do; this one does not depend on the arithmetic
    heads = np.abs(vectors).argmax(0)
    return vectors * np.sign(vectors[heads, np.arange(size)])


@dataclass
class Components:
    """Unit eigenvectors of V in columns, by falling eigenvalue, with the eigenvalues of n * n * V
    and their shares of its trace; none of eigenvalue 0."""

    vectors: np.ndarray
    roots: np.ndarray
    shares: np.ndarray


def components(spark: SparkSession, found: Scatter, most: int) -> Components:
    """The ``most`` first components, fewer if fewer eigenvalues are positive."""
    d = len(found.matrix)
    divisor = gcd(*found.matrix.ravel().tolist()) if d else 0
    if not divisor:
        return Components(np.zeros((d, 0)), np.zeros(0), np.zeros(0))
    matrix = found.matrix // divisor
    trace = sum(matrix[i, i] for i in range(d))
    polynomial = characteristic_polynomial(spark, matrix)
    bits = max(0, BITS - trace.bit_length())  # roots times 2**bits are told apart in whole steps
    fine = [c << bits * (d - k) for k, c in enumerate(polynomial)]
    roots = largest_roots(fine, trace << bits, most)
    shared = spark.sparkContext.broadcast(matrix)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x, size in zip(*(batch[c].to_pylist() for c in ("i", "x", "size"))):
                with localcontext() as context:
                    context.prec = DIGITS
                    root = (Decimal(x) + Decimal("0.5")) / Decimal(1 << bits)
                vectors = null_space(shared.value, root, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i]), pa.array([vectors.ravel().tolist()])], ["i", "vectors"])

    rows = spark.createDataFrame([(i, str(x), n) for i, (x, n) in enumerate(roots)],
                                 "i long, x string, size long")
    solved = rows.repartition(min(max(len(roots), 1), partitions(spark)), "i").mapInArrow(
        solve, "i long, vectors array<double>")
    blocks = {i: np.array(v).reshape(d, -1) for i, v in solved.collect()}
    columns = np.concatenate([blocks[i] for i in range(len(roots))], 1)[:, :most]
    values = [(2 * x + 1, n) for x, n in roots for _ in range(n)][:most]
    return Components(
        columns, np.array([float(divisor * v / (2 << bits)) if v.bit_length() < 900
                           else float(divisor * (v >> bits + 1)) for v, _ in values]),
        np.array([v / (trace << bits + 1) for v, _ in values]))


# --- whitening ----------------------------------------------------------------------------------

def _centred(batch: pa.RecordBatch, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S of a batch's vectors, exact."""
    y = whole_numbers(batch)
    if y.size and (np.abs(y).max() + 1) * n >= 1 << 61:
        raise OverflowError("n * x does not fit 64 bits")
    return y.astype(np.int64) * n - sums


def identity_error(rows: DataFrame, found: Scatter, parts: Components) -> float | None:
    """The largest entry of the whitened rows' covariance minus the identity, measured on the rows:
    partial sums by task, added up by entry in Spark."""
    size = parts.roots.size
    if not size:
        return None
    d, n, sums = len(found.sums), found.n, np.array(found.sums, np.int64)
    project = parts.vectors / np.sqrt(parts.roots)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            white = _centred(batch, n, sums).astype(np.float64) @ project
            total[0] += white.sum(0)
            total[1:] += white.T @ white
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "value"])

    added = rows.filter(F.size("vector") == d).select("vector").mapInArrow(
        products, "place long, value double").groupBy("place").agg(F.sum("value"))
    total = np.zeros((size + 1, size))
    for place, value in added.collect():
        total.flat[place] = value / n
    covariance = total[1:] - np.outer(total[0], total[0])
    return float(np.abs(covariance - np.eye(size)).max())


def whiten(table: DataFrame, most: int = 32, vec_id: str = "vec_id",
           column: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Entries become whole numbers x = floor(64 * c) + 1,000,000. The scatter of all rows is summed
    exactly; its characteristic polynomial is found modulo primes by Hessenberg reduction, one prime
    a row of a Spark job, and put together by Chinese remainders; real roots are isolated exactly and
    refined to BITS bits; the components are the null spaces at the roots, found by inverse
    iteration in DIGITS digits, one root a row of a Spark job. So the components do not depend on
    the order of rows or on the number of tasks. What comes to the driver has the size of one
    vector squared, the polynomial's digits included; the work on it grows with the fourth power of
    the vector's length and a little more, so vectors should not have much over a few hundred entries.

    ``whitened`` is a row's deviation from the mean, projected on the unit eigenvector of the
    covariance, over the root of its eigenvalue. ``explained`` is the eigenvalue over the trace.
    ``deviation`` is the sum over dimensions of (n*x-S)**2. ``identity_error`` is measured on the
    whitened rows.

    Rows whose vector is null or holds null, NaN or infinite entries are dropped, also from the fit.
    So are vectors of another length than the most frequent one (of equally frequent ones, the
    longest), as they share no dimensions. Eigenvalue 0 (a constant dimension, fewer rows than
    dimensions, one row, equal rows) has no whitened value: there are fewer components then, perhaps
    none and no rows. Vectors without entries and empty tables give no rows. Of equal eigenvalues,
    any orthonormal vectors count. Repeated rows count each; a null vec_id stays null; other columns
    are not read. Entries beyond 2**38, and sums that do not fit 64 bits, raise an OverflowError.
    """
    spark = table.sparkSession
    rows = vectors(table, vec_id, column)
    found = scatter(rows)
    parts = components(spark, found, most)
    error = identity_error(rows, found, parts)
    d, n, size = len(found.sums), found.n, parts.roots.size
    sums = np.array(found.sums, np.int64)
    project = parts.vectors / np.sqrt(parts.roots) if size else parts.vectors
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), ROWS):
                part = batch.slice(k, ROWS)
                centred = _centred(part, n, sums)
                if centred.size and d * int(np.abs(centred).max()) ** 2 >= 1 << 63:
                    if (centred.astype(object) ** 2).sum(1).max() >= 1 << 63:
                        raise OverflowError("a deviation does not fit 64 bits")
                white = centred.astype(np.float64) @ project
                m = len(part) * size
                yield pa.RecordBatch.from_arrays(
                    [part["vec_id"].take(pa.array(np.repeat(np.arange(len(part)), size))),
                     pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(part))),
                     pa.array(np.full(m, n, np.int64)),
                     pa.array(np.repeat((centred ** 2).sum(1), size)), pa.array(white.ravel()),
                     pa.array(np.tile(parts.shares, len(part))),
                     pa.array([error] * m, pa.float64())], names)

    if not size:
        return spark.createDataFrame([], schema)
    return rows.filter(F.size("vector") == d).mapInArrow(spell, schema)
