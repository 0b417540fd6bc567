"""The exact neighbour join against all pairs, and SMOTE built on it."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from vitrine.operators import ml as ML
from vitrine.operators import neighbours as N


def brute(x, k):
    out = {}
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        out[i] = [int(j) for j in np.lexsort((np.arange(len(x)), d)) if j != i][:k]
    return out


@pytest.mark.parametrize("kind", ["spread", "one_spot", "ties"])
def test_neighbours_equal_all_pairs(spark, kind):
    r = np.random.default_rng(2)
    x = {"spread": r.normal(size=(500, 6)) * 10, "one_spot": np.concatenate((r.normal(size=(450, 4)) * 1e-3 + 1e3, r.normal(size=(50, 4)) * 1e3)),
         "ties": r.integers(0, 4, size=(400, 3)).astype(float)}[kind]
    df = spark.createDataFrame([(i, [float(c) for c in v], "other") for i, v in enumerate(x)], "id long, f array<double>, dist string").repartition(3)
    got = {}
    for row in N.knn_join(df, "id", "f", 4, block=64, pivots=7).orderBy("a", "r").collect():
        got.setdefault(row.a, []).append(row.b)
    assert got == brute(x, 4)


def test_few_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [5.0]), (3, [6.0])], "id long, f array<double>")
    assert [(r.a, r.b, r.r) for r in N.knn_join(df, "id", "f", 5).orderBy("a", "r").collect()] == [(1, 2, 1), (1, 3, 2), (2, 3, 1), (2, 1, 2), (3, 2, 1), (3, 1, 2)]
    assert N.knn_join(df.limit(1), "id", "f", 5).collect() == [] and N.knn_join(df.limit(0), "id", "f", 5).collect() == []


def test_smote_uses_every_point_and_fresh_ids(spark):
    rows = [(i - 5, 0, [float(i), 0.0]) for i in range(2500)] + [(10_000, 1, [0.0, 1.0]), (10_001, 1, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, y int, f array<double>").withColumn("features", array_to_vector("f")).drop("f")
    out = ML.smote(df, "y", "id")
    n = out.groupBy("y").agg(F.count("*").alias("n")).collect()
    assert {r.n for r in n} == {2500} and out.select("id").distinct().count() == 5000
    made = out.where("synthetic").select("features").collect()
    assert all(0 <= r.features[0] <= 1 and r.features[1] == 1 for r in made)
    with pytest.raises(ValueError):
        ML.smote(df.where("y = 0 or id = 10000"), "y", "id")


def test_a_block_returns_only_what_is_within_a_query_s_bound():
    """Else every block returns k rows of every query, and the rows grow with the square of the points."""
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 5))
    ids = np.arange(3000)
    d = np.sqrt(((x[:50, None] - x[None]) ** 2).sum(axis=2))
    d[ids[:50], ids[:50]] = np.inf
    bound = np.sort(d, axis=1)[:, 1]  # the second nearest
    a, b, dist = N.nearest_in_block(ids[:50], x[:50], ids, x, 4, bound)
    assert [list(b[a == i]) for i in range(50)] == [list(np.argsort(d[i])[:2]) for i in range(50)]
    a, b, dist = N.nearest_in_block(ids[:50], x[:50], ids, x, 4)
    assert [list(b[a == i]) for i in range(50)] == [list(np.argsort(d[i])[:4]) for i in range(50)]
    twice = np.repeat(ids[:8], 2)  # repeated ids are never their own neighbours
    a, b, dist = N.nearest_in_block(twice[:1], x[twice[:1]], twice, x[twice], 4)
    assert len(b) == 4 and 0 not in b
