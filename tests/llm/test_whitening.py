"""Exact parts against plain integer arithmetic, components against numpy."""

import random
from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pytest

from dunlin.llm import whitening


def test_gram_and_sums_are_exact():
    rng = random.Random(1)
    for bits in (5, 18, 30, 50):
        x = np.array([[rng.randrange(-(1 << bits), 1 << bits) for _ in range(5)] for _ in range(9_000)], np.int64)
        o = x.astype(object)
        assert whitening.exact_gram(x).tolist() == (o.T @ o).tolist()
        assert whitening.exact_sums(x) == o.sum(0).tolist()


def plain_polynomial(m):
    """Faddeev-LeVerrier in exact fractions, lowest coefficient first."""
    n, c, a = len(m), [1], [[Fraction(0)] * len(m) for _ in m]
    for k in range(1, n + 1):
        a = [[sum(m[i][t] * a[t][j] for t in range(n)) + (c[-1] * m[i][j]) for j in range(n)] for i in range(n)]
        c.append(-sum(a[i][i] for i in range(n)) / Fraction(k))
    return [int(v) for v in reversed(c)]


@pytest.mark.parametrize("n, size", [(1, 9), (2, 10), (4, 10**3), (6, 10**12), (7, 2)])
def test_polynomial_equals_plain_one(spark, n, size):
    rng = random.Random(n)
    b = [[rng.randrange(-size, size + 1) for _ in range(n)] for _ in range(n)]
    m = [[sum(b[t][i] * b[t][j] for t in range(n)) for j in range(n)] for i in range(n)]
    assert whitening.characteristic_polynomial(spark, m) == plain_polynomial(m)
    zero = [[0] * n for _ in range(n)]
    zero[0][0] = 5
    assert whitening.characteristic_polynomial(spark, zero) == plain_polynomial(zero)


def test_roots_are_isolated_with_multiplicity():
    c = [1]
    for r in (7, 7, 7, 3, 0, 0, 10**20, 10**20 + 1):  # product of (x - r)
        c = [(c[i - 1] if i else 0) - r * (c[i] if i < len(c) else 0) for i in range(len(c) + 1)]
    got = whitening.largest_roots(c, 16)
    assert [m for _, m in got] == [1, 1, 3, 1]
    assert [round(float(r), 6) for r, _ in got[2:]] == [7.0, 3.0] and abs(got[0][0] - got[1][0] - 1) < Fraction(1, 10**9)
    assert whitening.largest_roots([-2, 0, 1], 1)[0][0] ** 2 - 2 < Fraction(1, 10**40)
    assert whitening.largest_roots([0, 0, 1], 3) == []


def frame(spark, rows, extra="n int, x int, component string"):
    return spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], f"id bigint, vector array<float>, {extra}")


def check(rows, got, wanted=16):
    used = [(i, [floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in used})
    n, u = len(fit), np.array(fit, float)
    c = u - u.mean(0)
    value, vector = np.linalg.eigh(c.T @ c / n)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(wanted, int((value > 1e-9 * value[0]).sum()))
    sums = [sum(x[j] for x in fit) for j in range(len(fit[0]))]
    assert len(got) == len(used) * k and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    deviation = sorted((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in used)
    assert sorted((r.id, r.deviation) for r in got if r.component == 1) == deviation
    mine = {(r.id, r.component): r.whitened for r in got}
    for j in range(k):
        assert abs(next(r.explained for r in got if r.component == j + 1) - value[j] / value.sum()) < 1e-9
    square = sum(np.array([mine[i, j + 1] for i, _ in used]) ** 2 for j in range(k))
    want = sum(((np.array([x for _, x in used]) - u.mean(0)) @ vector[:, j]) ** 2 / value[j] for j in range(k))
    assert np.allclose(square, want, rtol=1e-8)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(4)
    spread = np.array([3, 2, 2, 1, 0.5, 0.1])
    rows = [(k, [float(np.float32(c)) for c in rng.normal(size=6) * spread]) for k in range(400)]
    rows += [(1_000 + k, rows[0][1]) for k in range(200)]  # one frequent vector counts once
    odd = [(None, None), (1, None), (2, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (3, [nan] * 6), (4, [inf] * 6), (5, [1e30] * 6), (6, []), (7, [1.0])]
    check(rows, whitening.whiten(frame(spark, rows + odd)).collect())
    check(rows, whitening.whiten(frame(spark, rows), 2).collect(), 2)


def test_equal_eigenvalues_and_few_rows(spark):
    corners = [(k, [float(2 * (k >> j & 1)) for j in range(3)]) for k in range(8)]  # three equal eigenvalues
    check(corners, whitening.whiten(frame(spark, corners)).collect())
    line = [(k, [float(k), float(k), 0.0, 5.0]) for k in range(3)]  # rank one
    check(line, whitening.whiten(frame(spark, line)).collect())
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(frame(spark, [])).collect() == []


def test_large_entries_stay_exact(spark):
    rows = [(k, [float(2**40 * (k % 3)), float(k)]) for k in range(6)]
    got = whitening.whiten(frame(spark, rows)).collect()
    x = [[64 * int(c) + 1_000_000 for c in v] for _, v in rows]
    want = [sum((6 * a - sum(y[j] for y in x)) ** 2 for j, a in enumerate(v)) for v in x]
    assert {r.id: r.deviation for r in got} == {k: v if v < 2**63 else None for k, v in enumerate(want)}
    assert max(r.identity_error for r in got) < 1e-9
