"""Embedding whitening from exact cross-products by bit slicing.

Every entry c becomes the integer x = floor(1024 c) + 100000. The scatter of the x-vectors is counted, not multiplied:
entries are shifted by the least one, each dimension's bit planes are packed across rows into 64-bit words, and the
number of rows in which plane a of one dimension and plane b of another are both set, a popcount of their AND, weighs
2^(a+b) in the dimensions' cross-product. Sums and cross-products are integers, added up over tasks as decimals, and
centred as integers: C = n * sum(x y) - sum(x) sum(y), so V = C / n^2 is rounded once, before ``eigh``. Only the D x D
sums reach the driver (D: the vectors' dimension).

Cases: vectors that are null, empty, or hold null or non-finite entries (or entries beyond 2^42, whose squares would not fit
the decimals) are dropped, and so are vectors whose length isn't the commonest one (of equally common ones the longest).
Repeated rows and null ids count as rows. Components whose variance is nothing beside the largest (rank lost: fewer vectors
than dimensions, constant dimensions) can't be whitened and are not returned; so one vector alone returns no rows. A deviation beyond the
longs is null. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Rows whose planes are packed at a time.
ROWS = 8192
LARGEST = float(1 << 42)


def usable(df: DataFrame) -> DataFrame:
    """vec_id, v (doubles) of the rows whose vector has finite entries only."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda c: F.coalesce(F.abs(c) <= LARGEST, F.lit(False)) & ~F.isnan(c))
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(v.isNotNull() & (F.size(v) > 0) & good)


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """The integers x of a list column, rows by dimensions."""
    flat = col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.floor(flat * SCALE).astype(np.int64) + OFFSET


def cross_products(u: np.ndarray, planes: int) -> np.ndarray:
    """sum over rows of u[:, d] * u[:, e], exact (Python integers), of non-negative integers below 2^planes."""
    n, dim = u.shape
    words = -(-n // 64)
    bits = np.zeros((planes, dim, words * 64), dtype=bool)
    for b in range(planes):
        bits[b, :, :n] = ((u >> b) & 1).T
    packed = np.packbits(bits, axis=2).view(np.uint64)
    out = np.zeros((dim, dim), dtype=object)
    for s in range(2 * planes - 1):  # all pairs of planes that weigh 2^s
        count = np.zeros((dim, dim), dtype=np.int64)
        for a in range(max(0, s - planes + 1), min(planes, s + 1)):
            left, right = packed[a], packed[s - a]
            for d in range(dim):
                count[d] += np.bitwise_count(left[d] & right).sum(axis=1, dtype=np.int64)
        out += count.astype(object) << s
    return out


def scatter(vectors: DataFrame, dim: int, n: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(S, sums of x y) over all ``n`` vectors, exact, as Python integers."""
    planes = max(1, (most - least).bit_length())
    upper = [(d, e) for d in range(dim) for e in range(d, dim)]

    def run(batches):
        total, sums, seen = np.zeros((dim, dim), dtype=object), np.zeros(dim, dtype=object), False
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                u = matrix(b.column(0).slice(i, ROWS), dim) - least
                total, sums, seen = total + cross_products(u, planes), sums + u.sum(axis=0).astype(object), True
        if seen:
            d, e = zip(*([(-1, k) for k in range(dim)] + upper), strict=True)
            values = [str(x) for x in [*sums, *[total[p] for p in upper]]]
            yield pa.RecordBatch.from_pydict({"d": pa.array(d, pa.int32()), "e": pa.array(e, pa.int32()), "s": pa.array(values)})

    part = vectors.select("v").mapInArrow(run, "d int, e int, s string")
    got = part.groupBy("d", "e").agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")).collect()
    su, uu = np.zeros(dim, dtype=object), np.zeros((dim, dim), dtype=object)
    for r in got:
        if r.d < 0:
            su[r.e] = int(r.s)
        else:
            uu[r.d, r.e] = uu[r.e, r.d] = int(r.s)
    # back from u = x - least
    return su + n * least, uu + least * (su[:, None] + su[None, :]) + n * least * least


class Whitening:
    """Mean, components, eigenvalues and trace of a fit list."""

    def __init__(self, n: int, s: np.ndarray, xy: np.ndarray, components: int = COMPONENTS):
        self.n, self.s = n, s
        c = n * xy - s[:, None] * s[None, :]
        v = np.array([[float(Fraction(int(x), n * n)) for x in row] for row in c])
        e, w = np.linalg.eigh(v)
        order = np.argsort(-e, kind="stable")[:components]
        order = [i for i in order if e[i] > max(0.0, e[-1]) * len(s) * np.finfo(float).eps]
        self.e, self.w = e[order], w[:, order]
        self.trace = float(Fraction(int(sum(c[i, i] for i in range(len(s)))), n * n))
        self.mean_num = [int(x) for x in s]

    def centred(self, x: np.ndarray, most: int) -> np.ndarray:
        """n * x - S, exact: as 64-bit integers where all (at most ``most`` in size) fit, else as Python integers."""
        if self.n * most < 1 << 62:
            return self.n * x - np.array(self.mean_num, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.mean_num, dtype=object)

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.w / np.sqrt(self.e)


def deviations(centred: np.ndarray, largest: int) -> list[int | None]:
    """Sums of squares by row; null where one is beyond the longs. ``largest``: bound of the entries' size."""
    if centred.dtype != object and centred.shape[1] * largest * largest < 1 << 63:
        return (centred * centred).sum(axis=1).tolist()
    exact = [sum(int(v) * int(v) for v in row) for row in centred]
    return [x if x < 1 << 63 else None for x in exact]


def whiten(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per usable vector of ``df`` (vec_id,
    embedding) and component."""
    vectors = usable(df)
    floor = lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(OFFSET)
    sizes = vectors.groupBy(F.size("v").alias("dim")).agg(
        F.count("*").alias("n"), floor(F.min(F.array_min("v"))).alias("least"), floor(F.max(F.array_max("v"))).alias("most"))
    row = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if row is None:
        return df.sparkSession.createDataFrame([], schema)
    dim, n, least, most = row.dim, row.n, int(row.least), int(row.most)
    vectors = vectors.where(F.size("v") == dim)
    fit = Whitening(n, *scatter(vectors, dim, n, least, most), components)
    k, size, spread = len(fit.e), max(abs(least), abs(most)), n * (most - least)
    shared = df.sparkSession.sparkContext.broadcast(fit)

    def sums(batches):
        got, rows = np.zeros((k + 1, k)), 0
        for b in batches:
            y = shared.value.project(shared.value.centred(matrix(b.column(0), dim), size))
            got += np.vstack((y.sum(axis=0), y.T @ y))
            rows += len(y)
        if rows:
            yield pa.RecordBatch.from_pydict({"s": pa.array([got.reshape(-1).tolist()], pa.list_(pa.float64()))})

    # one row per task: k + 1 sums of k values
    parts = vectors.select("v").mapInArrow(sums, "s array<double>").agg(
        *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range((k + 1) * k)]).first() if k else None
    error = 0.0
    if k:
        m = np.array(parts, dtype=float).reshape(k + 1, k) / n
        error = float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(k)).max())

    def run(batches):
        f = shared.value
        for b in batches:
            c = f.centred(matrix(b.column(1), dim), size)
            y, dev, rows = f.project(c), deviations(c, spread), b.num_rows
            yield pa.RecordBatch.from_pydict({
                "vec_id": b.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                "n": pa.array(np.full(rows * k, n)), "deviation": pa.array([d for d in dev for _ in range(k)], pa.int64()),
                "whitened": pa.array(y.reshape(-1)), "explained": pa.array(np.tile(f.e / f.trace, rows) if k else np.zeros(0)),
                "identity_error": pa.array(np.full(rows * k, error))})

    return vectors.select("vec_id", "v").mapInArrow(run, schema)
