"""Whitening against plain arithmetic: exact numbers by Python integers, vectors by numpy."""

from math import floor, gcd

import numpy as np
import pytest

from thermolens.llm import whitening
from thermolens.llm.queries import op12_embedding_whitening

SCHEMA = ("vec_id long, embedding array<float>, label int, n string, component string, "
          "vector string")


def write(spark, path, vectors):
    rows = [(i, v, 1, "n", "c", "v") for i, v in vectors]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def by_hand(vectors, most=32):
    """n, exact deviations, eigenvalue shares and vectors by falling eigenvalue."""
    x = [[floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = [[n * c - s for c, s in zip(row, sums)] for row in x]
    told = [sum(c * c for c in row) for row in centred]
    deviations = np.array(centred, np.float64) / n
    values, columns = np.linalg.eigh(deviations.T @ deviations / n)
    order = np.argsort(-values)[:most]
    return n, told, deviations, values[order], columns[:, order], values.sum()


@pytest.mark.parametrize("dimensions", [5, 40])
def test_query_equals_plain_arithmetic(spark, tmp_path, dimensions):
    r = np.random.default_rng(dimensions)
    mixed = r.standard_normal((dimensions, dimensions))
    vectors = [(int(i), (r.standard_normal(dimensions) @ mixed).tolist()) for i in range(150)]
    vectors += [vectors[3], (None, vectors[4][1])]
    bad = [(900, None), (901, [None] + [0.5] * (dimensions - 1)), (902, [float("nan")] * dimensions),
           (903, [float("inf")] * dimensions), (904, [-float("inf")] * dimensions),
           (905, [0.25] * (dimensions - 1)), (906, [])]
    folder = write(spark, tmp_path, vectors + bad)
    found = op12_embedding_whitening(spark, folder).toPandas()
    n, told, deviations, values, columns, trace = by_hand([v for _, v in vectors])
    size = min(32, dimensions)
    assert len(found) == n * size and set(found.n) == {n}
    assert set(found.vec_id.dropna()) == {i for i, _ in vectors if i is not None}
    by_id = found[found.component == 1].set_index("vec_id").deviation
    assert all((by_id[[i]] == told[i]).all() for i, _ in vectors if i is not None)
    shares = found.groupby("component").explained.first().to_numpy()
    assert np.allclose(shares, values / trace, rtol=1e-10)
    assert found.identity_error.nunique() == 1 and 0 <= found.identity_error[0] < 1e-9
    rows = found[found.vec_id.notna() & (found.vec_id != 3)].pivot(
        index="vec_id", columns="component", values="whitened")
    expected = deviations[rows.index.to_numpy(int)] @ columns / np.sqrt(values)
    signs = np.sign((expected * rows.to_numpy()).sum(0))
    assert np.allclose(rows.to_numpy() * signs, expected, atol=1e-7)


def test_equal_eigenvalues_and_constant_dimensions(spark, tmp_path):
    corners = [[x, y, 3.0, z] for x in (-1.0, 1.0) for y in (-1.0, 1.0) for z in (-2.0, 2.0)]
    folder = write(spark, tmp_path, list(enumerate(corners * 2)))
    found = op12_embedding_whitening(spark, folder).toPandas()
    assert sorted(set(found.component)) == [1, 2, 3]
    shares = found.groupby("component").explained.first().to_numpy()
    assert np.allclose(shares, [4 / 6, 1 / 6, 1 / 6], rtol=1e-12)
    assert found.identity_error[0] < 1e-12


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[]], [[None]]])
def test_without_variance_there_are_no_components(spark, tmp_path, vectors):
    folder = write(spark, tmp_path, list(enumerate(vectors)))
    found = op12_embedding_whitening(spark, folder)
    assert found.count() == 0 and len(found.columns) == 7


def test_large_numbers_are_exact(spark):
    r = np.random.default_rng(8)
    y = np.floor(r.standard_normal((5000, 4)) * 2.0 ** np.array([43, 30, 5, 41]) / 4)
    whole = [[int(v) for v in row] for row in y]
    expected = [[sum(a[i] * a[j] for a in whole) for j in range(4)] for i in range(4)]
    assert whitening.gram(y).tolist() == expected
    rows = spark.createDataFrame([([c / 64 for c in row],) for row in whole], "vector array<double>")
    found = whitening.scatter(rows)
    sums = [sum(c) for c in zip(*whole)]
    assert found.sums == sums and found.matrix.tolist() == [
        [5000 * e - sums[i] * sums[j] for j, e in enumerate(row)] for i, row in enumerate(expected)]
    with pytest.raises(Exception, match="beyond"):
        whitening.scatter(spark.createDataFrame([([2.0 ** 40],)], "vector array<double>"))


def test_polynomial_roots_and_primes(spark):
    r = np.random.default_rng(2)
    for values in ([0, 0, 3, 7, 7, 7, 1000], [5], [0, 0], [1] * 6):
        d = len(values)
        change = np.eye(d, dtype=np.int64)  # whole numbers, determinant 1
        for _ in range(3 * d if d > 1 else 0):
            i, j = r.choice(d, 2, replace=False)
            change[i] += int(r.integers(-2, 3)) * change[j]
        inverse = np.rint(np.linalg.inv(change)).astype(np.int64)
        matrix = (change @ np.diag(values) @ inverse).astype(object)
        found = whitening.characteristic_polynomial(spark, matrix)
        expected = [1]
        for v in values:
            expected = [a - v * b for a, b in zip([0, *expected], [*expected, 0])]
        assert found == expected
        for a in range(-1, 9):
            assert whitening.roots_above(found, a) == sum(v > a for v in values)
        told = [x + 1 for x, n in whitening.largest_roots(found, 2000, d) for _ in range(n)]
        assert told == sorted((v for v in values if v), reverse=True)
    known = [n for n in range(2, 3000) if all(n % k for k in range(2, int(n ** 0.5) + 1))]
    assert [n for n in range(3000) if whitening.is_prime(n)] == known
    moduli = whitening.primes(10 ** 100)
    assert len(moduli) == 11 and all(
        gcd(a, b) == 1 for i, a in enumerate(moduli) for b in moduli[:i])
