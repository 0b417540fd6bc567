"""Kernel machines against single-machine fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import kernel as K


def data(n=240, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 3))
    y = ((x**2).sum(axis=1) + 0.3 * r.normal(size=n) > 2.3).astype(int)
    return x, y


@pytest.fixture(scope="module")
def rows(spark):
    x, y = data()
    df = spark.createDataFrame([(i, int(c), [float(v) for v in p]) for i, (p, c) in enumerate(zip(x, y, strict=True))], "id long, y int, x array<double>")
    return K.stratified_folds(df, "y", "id", 4).repartition(3).cache()


def descend(z, t, c):
    """The same loss by plain gradient descent with backtracking."""
    ridge = np.append(np.ones(z.shape[1] - 1), 0)

    def value(w):
        g = np.maximum(0, 1 - t * (z @ w))
        return 0.5 * (w * w * ridge).sum() + c * (g * g).sum(), w * ridge - 2 * c * z.T @ (t * g)

    w, step = np.zeros(z.shape[1]), 1.0
    v, g = value(w)
    for _ in range(20000):
        while True:
            new = value(w - step * g)
            if new[0] <= v - 0.5 * step * (g @ g) or step < 1e-14:
                break
            step /= 2
        w, (v, g), step = w - step * g, new, step * 1.5
        if g @ g < 1e-16:
            break
    return v, w


def test_folds_are_stratified(rows):
    n = {(r.y, r.fold): r.n for r in rows.groupBy("y", "fold").agg(F.count("*").alias("n")).collect()}
    for y in (0, 1):
        sizes = [n[y, f] for f in range(4)]
        assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_models_fitted_together_equal_single_fits(rows, kernel):
    phi = K.fit_map(rows, kernel, 20)
    w = K.fit_many(rows, phi, [0.1, 5.0], 4)
    got = rows.orderBy("id").collect()
    z, t, fold = phi(np.array([r.x for r in got])), np.array([1.0 if r.y else -1.0 for r in got]), np.array([r.fold for r in got])
    for i, c in enumerate([0.1, 5.0]):
        for f in (0, 3, 4):
            on = fold != f
            v, _ = descend(z[on], t[on], c)
            g = np.maximum(0, 1 - t[on] * (z[on] @ w[i, f]))
            mine = 0.5 * (w[i, f, :-1] ** 2).sum() + c * (g * g).sum()
            assert mine <= v * (1 + 1e-6) + 1e-9


def test_map_with_all_rows_is_the_kernel():
    x, _ = data(30)
    for kernel in ("rbf", "poly"):
        m = K.KernelMap(kernel, x, 0.4, 3, 1.0)
        p = m(x)[:, :-1]
        assert np.abs(p @ p.T - m.against(x)).max() < 1e-6 * np.abs(m.against(x)).max()


def test_platt_reaches_the_optimum(spark):
    r = np.random.default_rng(5)
    f = r.normal(size=500)
    y = (r.random(500) < 1 / (1 + np.exp(-(2 * f - 0.5)))).astype(int)
    df = spark.createDataFrame([(1.0, float(a), int(b)) for a, b in zip(f, y, strict=True)] + [(2.0, float(a), int(a > 0)) for a in f], "c double, m double, y int")
    ab = K.platt(df, "c", "m")
    p, q = y.sum(), 500 - y.sum()
    t = np.where(y == 1, (p + 1) / (p + 2), 1 / (q + 2))

    def loss(a, b):
        z = a * f + b
        return (t * z + np.maximum(-z, 0) + np.log1p(np.exp(-np.abs(z)))).sum()

    a, b = ab[1.0]
    assert a < 0 and all(loss(a, b) <= loss(a + da, b + db) + 1e-9 for da in (-1e-3, 0, 1e-3) for db in (-1e-3, 0, 1e-3))
    assert np.isfinite(ab[2.0]).all()
    assert K.platt(df.limit(0), "c", "m") == {}


def test_a_step_shuffles_no_more_for_more_partitions(spark, rows, monkeypatch):
    phi, parts = K.fit_map(rows, "linear"), []
    spied = type(rows).mapInArrow

    def spy(self, *a, **k):
        parts.append(self.rdd.getNumPartitions())
        return spied(self, *a, **k)

    monkeypatch.setattr(type(rows), "mapInArrow", spy)
    many = 3 * spark.sparkContext.defaultParallelism
    w = K.fit_many(rows.repartition(many), phi, [1.0], 4)
    assert parts and max(parts) <= spark.sparkContext.defaultParallelism
    assert np.allclose(w, K.fit_many(rows.coalesce(1), phi, [1.0], 4), rtol=1e-6, atol=1e-9)
