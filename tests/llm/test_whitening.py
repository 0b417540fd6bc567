"""Whitening against exact rational arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from vitrine.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n string, v string"


def frame(sp, rows):
    return sp.createDataFrame([(i, v, 1, 2, "n", "v") for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(3)
    base = r.normal(size=(300, 12)).astype(np.float32) @ np.diag(np.linspace(3, 0.3, 12)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    return rows + [(3, rows[3][1]), (None, rows[5][1])]


def test_whitening_equals_exact_arithmetic(sp, vectors):
    bad = [(900, None), (901, []), (902, [None] + [1.0] * 11), (903, [math.nan] + [1.0] * 11), (904, [math.inf] * 12), (905, [1.0] * 3)]
    got = W.whiten(frame(sp, vectors + bad).repartition(5)).collect()
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in vectors]
    n, dim = len(x), 12
    s = [sum(r[d] for r in x) for d in range(dim)]
    cov = [[Fraction(sum(n * r[d] * r[e] for r in x) - s[d] * s[e], n * n) for e in range(dim)] for d in range(dim)]
    e, w = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    e, w = e[::-1][:8], w[:, ::-1][:, :8]
    want = {}
    for (i, _), r in zip(vectors, x, strict=True):
        dev = sum((n * r[d] - s[d]) ** 2 for d in range(dim))
        y = np.array([float(Fraction(n * r[d] - s[d], n)) for d in range(dim)]) @ w / np.sqrt(e)
        want.setdefault(i, []).append((dev, y))
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    for r in got:
        dev, y = want[r.vec_id][0]
        assert r.deviation == dev and abs(abs(r.whitened) - abs(y[r.component - 1])) < 1e-9
        assert abs(r.explained - e[r.component - 1] / sum(float(cov[d][d]) for d in range(dim))) < 1e-12
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    # one sign for all rows
    signs = {(r.component, np.sign(r.whitened * want[r.vec_id][0][1][r.component - 1])) for r in got if abs(r.whitened) > 1e-6}
    assert len(signs) == 8


def test_cross_products_equal_products():
    r = np.random.default_rng(1)
    for n, dim, planes in [(1, 3, 1), (63, 2, 5), (64, 4, 11), (1000, 3, 40)]:
        u = r.integers(0, 1 << planes, size=(n, dim))
        big = u.astype(object)
        assert (W.cross_products(u, planes) == big.T @ big).all()


def test_lost_rank_and_empty(sp, vectors):
    assert W.whiten(frame(sp, [])).collect() == []
    assert W.whiten(frame(sp, [(1, [1.0, 2.0])])).collect() == []
    got = W.whiten(frame(sp, [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)])).collect()
    assert {r.component for r in got} == {1} and got[0].identity_error < 1e-9 and abs(got[0].explained - 1) < 1e-12


def test_large_entries_stay_exact(sp):
    data = [(i, [float(1 << 40), -float(1 << 40) * (i + 1) / 7, float(i)]) for i in range(9)]
    got = {r.vec_id: r.deviation for r in W.whiten(frame(sp, data)).collect()}
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in data]
    s = [sum(c) for c in zip(*x, strict=True)]
    for i, r in enumerate(x):
        dev = sum((9 * a - b) ** 2 for a, b in zip(r, s, strict=True))
        assert got[i] == (dev if dev < 1 << 63 else None)
