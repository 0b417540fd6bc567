"""Kernel machines whose cross-validation models are fitted together, with calibrated probabilities (TRN4, TRN5).

A kernel becomes a feature map by landmarks (Nystroem): a bounded sample of rows, against which every row is evaluated.
On the mapped rows the machine is linear: |w|^2 / 2 + C * sum of squared hinge losses, the bias free. All models of a sweep
(each C, each fold left out, and the whole) take their Newton steps in the same pass over the rows: tasks add up gradients
and curvatures of every model, and the driver solves one small system per model. Probabilities are Platt's: a sigmoid over
the margins that each row gets from the model that has not seen it, fitted by Newton steps over Spark sums.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.prefix import prefix_sums

#: Most landmark rows; with all rows as landmarks the map is exact.
LANDMARKS = 128
STEPS, TOLERANCE = 60, 1e-9
#: Rows of a model's curvature that are added up in one group.
STRIP = 32


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold``: per class, rows in the order of hash(id, seed) are dealt to 0 .. k - 1 in turn, so that folds differ by
    one row of a class at most. No class is gathered in one task."""
    h = df.withColumn("_h", F.struct(F.xxhash64(F.col(id_col), F.lit(seed)).alias("h"), F.col(id_col).alias("i"))).withColumn("_one", F.lit(1))
    ranked = prefix_sums(h, [label], "_h", ["_one"])
    return ranked.withColumn("fold", ((F.col("cum__one") - 1) % k).cast("int")).select(*df.columns, "fold")


class KernelMap:
    """x -> phi(x) with phi(x) . phi(y) near kernel(x, y); equal to it where x or y is a landmark."""

    def __init__(self, kernel: str, landmarks: np.ndarray | None = None, gamma: float = 1.0, degree: int = 3, coef0: float = 0.0):
        self.kernel, self.landmarks, self.gamma, self.degree, self.coef0 = kernel, landmarks, gamma, degree, coef0
        if kernel != "linear":
            e, u = np.linalg.eigh(self.against(landmarks))
            keep = e > 1e-10 * max(e.max(), 1e-300)
            self.w = u[:, keep] / np.sqrt(e[keep])

    def against(self, x: np.ndarray) -> np.ndarray:
        dot = x @ self.landmarks.T
        if self.kernel == "rbf":
            d = (x * x).sum(1)[:, None] + (self.landmarks**2).sum(1)[None, :] - 2 * dot
            return np.exp(-self.gamma * np.maximum(d, 0))
        if self.kernel == "poly":
            return (self.gamma * dot + self.coef0) ** self.degree
        if self.kernel == "sigmoid":
            return np.tanh(self.gamma * dot + self.coef0)
        raise ValueError(f"unknown kernel {self.kernel}")

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Mapped rows, with a column of ones for the bias."""
        phi = x if self.kernel == "linear" else self.against(x) @ self.w
        return np.hstack((phi, np.ones((len(x), 1))))


def fit_map(rows: DataFrame, kernel: str, landmarks: int = LANDMARKS) -> KernelMap:
    """The map of ``kernel`` for ``rows`` (id, x): landmarks by a hash of the id, gamma 1 / (dimensions * variance)."""
    if kernel == "linear":
        return KernelMap(kernel)
    x = np.array([r["x"] for r in rows.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(landmarks).collect()], dtype=float)
    s = rows.select(F.explode("x").alias("v")).agg(F.var_pop("v").alias("v")).first()["v"]
    return KernelMap(kernel, x, 1.0 / (x.shape[1] * s) if s else 1.0)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    y, fold = batch.column("y").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False)
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return np.where(y > 0, 1.0, -1.0), fold, x


def fit_many(rows: DataFrame, phi: KernelMap, cs: list[float], k: int) -> np.ndarray:
    """Weights by (C, fold left out; the last one leaves none out, dimension), the bias last. ``rows``: y (0 or 1), fold, x.

    A model steps by Newton, halving a step that made its loss larger, until the decrement is under ``TOLERANCE``. In a step
    every task returns its sums of all models, however many rows it adds up; so there are as many tasks as cores, and what a
    step shuffles does not grow with the rows."""
    rows = rows.select("y", "fold", "x").coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    dim = len(rows.select("x").first()["x"]) + 1 if phi.kernel == "linear" else phi.w.shape[1] + 1
    models = [(c, f) for c in cs for f in range(k + 1)]
    starts = range(0, dim, STRIP)
    w, ridge = np.zeros((len(models), dim)), np.append(np.ones(dim - 1), 0.0)

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shared = rows.sparkSession.sparkContext.broadcast((phi, w))

        def run(batches):
            phi, w = shared.value
            total = np.zeros((len(models), dim, dim + 2))
            for b in batches:
                y, fold, x = _rows(b)
                z = phi(x)
                gap = 1.0 - y[:, None] * (z @ w.T)
                for m, (_, f) in enumerate(models):
                    on = (gap[:, m] > 0) & (fold != f)
                    a, g = z[on], gap[on, m]
                    total[m, :, :dim] += a.T @ a
                    total[m, :, dim] -= a.T @ (y[on] * g)
                    total[m, 0, dim + 1] += (g * g).sum()
            m, d = np.divmod(np.arange(len(models) * len(starts)), len(starts))
            yield pa.RecordBatch.from_pydict({"m": pa.array(m, pa.int32()), "d": pa.array(d, pa.int32()), "v": pa.array(
                [total[i, starts[j] : starts[j] + STRIP].reshape(-1).tolist() for i, j in zip(m, d, strict=True)], pa.list_(pa.float64()))})

        def add(f: pd.DataFrame) -> pd.DataFrame:
            return f.iloc[:1].assign(v=[np.sum(np.stack(f["v"].to_list()), axis=0)])

        part = rows.mapInArrow(run, "m int, d int, v array<double>")
        got = part.groupBy("m", "d").applyInPandas(add, "m int, d int, v array<double>").collect()
        t = np.zeros((len(models), dim, dim + 2))
        for r in got:
            t[r["m"], starts[r["d"]] : starts[r["d"]] + STRIP] = np.reshape(r["v"], (-1, dim + 2))
        c = np.array([2 * m[0] for m in models])
        loss = 0.5 * (w * w * ridge).sum(axis=1) + 0.5 * c * t[:, 0, dim + 1]
        return loss, w * ridge + c[:, None] * t[:, :, dim], c[:, None, None] * t[:, :, :dim] + np.diag(ridge + 1e-12)

    loss, grad, curve = sums(w)
    step = -np.linalg.solve(curve, grad[:, :, None])[:, :, 0]
    size, done = np.ones(len(models)), np.zeros(len(models), dtype=bool)
    for _ in range(STEPS):
        done |= -(grad * step).sum(axis=1) < TOLERANCE * (1 + np.abs(loss))
        if done.all():
            break
        tried = np.where(done[:, None], w, w + size[:, None] * step)
        new_loss, new_grad, new_curve = sums(tried)
        better = ~done & (new_loss <= loss + 1e-12 * np.abs(loss))
        size = np.where(better, 1.0, size / 2)
        done |= size < 1e-6
        w = np.where(better[:, None], tried, w)
        loss, grad, curve = (np.where(better.reshape(-1, *[1] * (a.ndim - 1)), b, a) for a, b in ((loss, new_loss), (grad, new_grad), (curve, new_curve)))
        step = -np.linalg.solve(curve, grad[:, :, None])[:, :, 0]
    return w.reshape(len(cs), k + 1, dim)


def margins(rows: DataFrame, phi: KernelMap, cs: list[float], w: np.ndarray) -> DataFrame:
    """id, y, fold, c, unseen (margin by the model that left the row's fold out), margin (by the model of all rows)."""
    k = w.shape[1] - 1
    shared = rows.sparkSession.sparkContext.broadcast((phi, w))

    def run(batches):
        phi, w = shared.value
        for b in batches:
            _, fold, x = _rows(b)
            z, n = phi(x), b.num_rows
            for i, c in enumerate(cs):
                m = z @ w[i].T
                yield pa.RecordBatch.from_pydict({"id": b.column("id"), "y": b.column("y"), "fold": b.column("fold"), "c": pa.array(np.full(n, c)),
                                                  "unseen": pa.array(m[np.arange(n), np.minimum(fold, k)]), "margin": pa.array(m[:, k])})

    return rows.select("id", F.col("y").cast("int").alias("y"), F.col("fold").cast("int").alias("fold"), "x").mapInArrow(
        run, "id long, y int, fold int, c double, unseen double, margin double")


def platt(scored: DataFrame, key: str, margin: str, label: str = "y", steps: int = 50) -> dict:
    """key -> (a, b) of P(1) = 1 / (1 + exp(a * margin + b)), by Newton steps that Spark sums; targets as Platt's, so
    that separable margins keep finite slopes."""
    n = {r[key]: (r["p"], r["n"]) for r in scored.groupBy(key).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")).collect()}
    if not n:
        return {}
    high = {c: (p + 1.0) / (p + 2.0) for c, (p, _) in n.items()}
    low = {c: 1.0 / (q + 2.0) for c, (_, q) in n.items()}
    fit = {c: (0.0, float(np.log((q + 1.0) / (p + 1.0)))) for c, (p, q) in n.items()}
    size, best = dict.fromkeys(fit, 1.0), {}
    look = lambda d: F.create_map(*[F.lit(v) for c, x in d.items() for v in (c, float(x))])[F.col(key)]
    f = F.col(margin)
    for _ in range(steps):
        z = f * look({c: x[0] for c, x in fit.items()}) + look({c: x[1] for c, x in fit.items()})
        t = F.when(F.col(label) == 1, look(high)).otherwise(look(low))
        e = F.exp(-F.abs(z))
        p = F.when(z >= 0, e / (1 + e)).otherwise(1 / (1 + e))
        loss = t * z + F.greatest(-z, F.lit(0.0)) + F.log1p(e)
        s = {r[key]: r for r in scored.groupBy(key).agg(
            F.sum(loss).alias("loss"), F.sum(f * (t - p)).alias("ga"), F.sum(t - p).alias("gb"), F.sum(f * f * p * (1 - p)).alias("aa"),
            F.sum(f * p * (1 - p)).alias("ab"), F.sum(p * (1 - p)).alias("bb")).collect()}
        moved = False
        for c, r in s.items():
            if c not in best or r["loss"] < best[c][0]:
                h = np.array([[r["aa"] + 1e-12, r["ab"]], [r["ab"], r["bb"] + 1e-12]])
                step = -np.linalg.solve(h, [r["ga"], r["gb"]])
                gain = -float(step @ [r["ga"], r["gb"]])
                best[c], size[c] = (r["loss"], fit[c], step, gain), 1.0
            else:
                size[c] /= 2
            _, at, step, gain = best[c]
            if gain > 1e-10 and size[c] > 1e-6:
                fit[c], moved = (at[0] + size[c] * step[0], at[1] + size[c] * step[1]), True
            else:
                fit[c] = at
        if not moved:
            break
    return {c: b[1] for c, b in best.items()}


def probability(margin, ab: dict, key: str):
    """Platt's probability of class 1 from a margin column and the fits by ``key``."""
    look = lambda i: F.create_map(*[F.lit(v) for c, x in ab.items() for v in (c, float(x[i]))])[F.col(key)]
    return 1 / (1 + F.exp(margin * look(0) + look(1)))


def f1_by(df: DataFrame, keys: list, margin: str) -> DataFrame:
    """accuracy, precision, recall, f1 (class 1; 0 where undefined) of margin > 0, by ``keys``."""
    hit, said, true = (F.col(margin) > 0) & (F.col("y") == 1), F.col(margin) > 0, F.col("y") == 1
    g = df.groupBy(*keys).agg(F.count_if(hit).alias("tp"), F.count_if(said).alias("pp"), F.count_if(true).alias("ap"),
                              F.count_if(said == true).alias("ok"), F.count("*").alias("n"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return g.select(*keys, (F.col("ok") / F.col("n")).alias("accuracy"), ratio(F.col("tp"), F.col("pp")).alias("precision"),
                    ratio(F.col("tp"), F.col("ap")).alias("recall"), ratio(2 * F.col("tp"), F.col("pp") + F.col("ap")).alias("f1"))
