import math
import random
from fractions import Fraction

import numpy as np
import pytest
from tidewatch.llm.whitening import Inertia, feast, largest_eigenpairs, slices, whitened

SCHEMA = "vec_id long, embedding array<float>, label int, n int, component string, vector string, place int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "c", None, 3) for r in rows], SCHEMA).repartition(4)


def vectors(count=400, dimension=12, seed=1):
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.standard_normal((dimension, dimension)))
    spread = np.linspace(0.2, 2, dimension)
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate((rng.standard_normal((count, dimension)) * spread) @ turn)]
    rows += [rows[3], rows[3], (None, rows[9][1])]
    odd = [(900, None), (901, []), (902, [None] * dimension), (903, [float("nan")] * dimension),
           (904, [float("inf")] + [0.0] * (dimension - 1)), (905, [1.0])]
    return rows, odd


def symmetric(values, seed=0):
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (turn * np.array(values, float)) @ turn.T


def test_against_exact_moments_and_a_dense_solver(spark):
    rows, odd = vectors()
    got = whitened(frame(spark, rows + odd), components=5).collect()
    x = [[math.floor(64 * c) + 1000000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    assert len(got) == 5 * n and {r.n for r in got} == {n}
    away = [[n * a - s for a, s in zip(v, sums, strict=True)] for v in x]
    covariance = np.array(
        [[float(Fraction(sum(v[i] * v[j] for v in away), n**3)) for j in range(12)] for i in range(12)]
    )
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    wanted = (np.array(away) / n) @ axes / np.sqrt(values)
    for c in range(5):
        mine = sorted((r for r in got if r.component == c + 1), key=lambda r: (int(r.deviation), r.whitened))
        order = sorted(range(n), key=lambda k: (sum(a * a for a in away[k]), 0))
        assert [int(r.deviation) for r in mine] == [sum(a * a for a in away[k]) for k in order]
        assert np.allclose(sorted(abs(r.whitened) for r in mine), sorted(abs(wanted[:, c])), atol=1e-9)
        assert math.isclose(mine[0].explained, values[c] / values.sum(), rel_tol=1e-10)
        w = {r.vec_id: r.whitened for r in mine if r.vec_id is not None}
        sign = np.sign(w[0] * wanted[0, c])
        assert all(abs(sign * w[k] - wanted[k, c]) < 1e-8 for k in range(400))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


@pytest.mark.parametrize("values", [
    list(range(1, 41)),
    [5.0] * 6 + [4.0] * 30 + [1e-3] * 4,  # many equal ones
    [1.0] * 40,
    [10 + 1e-7 * k for k in range(20)] + [1e-4 * k for k in range(1, 21)],  # clusters
    [1e6, 1e3, 1.0, 1e-2] + [0.0] * 36,
    list(np.geomspace(1e-8, 1e4, 40)),
])
def test_eigenpairs(values):
    matrix = symmetric(values)
    wanted = np.sort(values)[::-1]
    for most in (1, 7, 32, 50):
        found, axes = largest_eigenpairs(matrix, most)
        real = wanted[wanted > 1e-11 * wanted.sum()][:most]
        assert len(found) == len(real) and np.allclose(found, real, rtol=1e-6, atol=1e-13 * wanted[0])
        assert np.abs(axes.T @ axes - np.eye(len(found))).max() < 1e-6
        assert np.abs(matrix @ axes - axes * found).max() < 1e-12 * max(1, wanted[0]) * 40


def test_inertia_counts_and_slices():
    for seed in range(5):
        values = np.sort(np.random.default_rng(seed).uniform(0, 9, 30))
        inertia = Inertia(symmetric(values, seed))
        for shift in np.linspace(-1, 10, 50):
            assert inertia.below(shift) == (values < shift).sum()
        cut = slices(inertia, 1e-6, 10.0, 20)
        assert sum(c for _, _, c in cut) >= 20 and max(c for _, _, c in cut) <= 12
        for a, b, c in cut:
            assert c == ((values >= a) & (values < b)).sum()


def test_a_missed_eigenvalue_is_an_error():
    with pytest.raises(ArithmeticError, match="not all found"):
        feast(symmetric(list(range(1, 31))), 10.5, 14.5, 7)


def test_empty_equal_short_and_huge(spark):
    assert whitened(frame(spark, [])).count() == 0
    assert whitened(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whitened(frame(spark, [(k, [0.5, 1.0, 2.0]) for k in range(5)])).count() == 0
    two = whitened(frame(spark, [(1, [0.0, 1.0, 2.0]), (2, [1.0, 1.0, 2.0])])).collect()
    assert {(r.vec_id, r.component, r.n, int(r.deviation)) for r in two} == {(1, 1, 2, 4096), (2, 1, 2, 4096)}
    assert all(math.isclose(abs(r.whitened), 1) and math.isclose(r.explained, 1) for r in two)
    rng = random.Random(1)
    huge = [(k, [rng.choice([-1, 1]) * 3e38, rng.uniform(-1e6, 1e6)]) for k in range(40)]
    assert whitened(frame(spark, huge)).count() > 0
