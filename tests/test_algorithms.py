"""Distributed algorithms against brute force on small fixtures."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitrine.functions import stats as ST
from vitrine.functions.prefix import prefix_sums
from vitrine.operators.store import greedy_unique


def brute_greedy(rows):
    seen_a, seen_b, out = set(), set(), []
    for seq, a, b in sorted(rows):
        if a in seen_a or b in seen_b:
            continue
        seen_a.add(a)
        seen_b.add(b)
        out.append(seq)
    return out


def test_greedy_unique_chains(spark):
    # chains where rejected rows must not block later rows
    rows = [(1, "u1", "t1"), (2, "u2", "t1"), (3, "u2", "t2"), (4, "u3", "t2"), (5, "u3", "t3"), (6, "u4", "t4")]
    rng = random.Random(3)
    rows += [(i, f"u{rng.randint(0, 30)}", f"t{rng.randint(0, 30)}") for i in range(7, 120)]
    df = spark.createDataFrame(rows, "seq long, url string, key string")
    got = sorted(r.seq for r in greedy_unique(df, "seq", ["url"], ["key"]).collect())
    assert got == brute_greedy(rows)


def test_prefix_sums_match_window(spark):
    rng = random.Random(1)
    rows = [(f"m{rng.randint(0, 2)}", float(i), rng.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, s double, v long")
    got = prefix_sums(df, ["k"], "s", ["v"], descending=True)
    w = Window.partitionBy("k").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("ref", F.sum("v").over(w))
    j = got.join(ref, ["k", "s"])
    assert j.where(F.col("cum_v") != F.col("ref")).count() == 0
    assert j.count() == 500


def test_stats_tails():
    assert abs(ST.t_ppf(0.975, 4) - 2.7764451051977987) < 1e-9
    assert abs(ST.t_sf_two_sided(2.0, 10) - 0.0733880347) < 1e-8
    assert abs(ST.f_sf(3.0, 2, 12) - 1.5 ** -6) < 1e-9  # closed form for d1 = 2
    assert abs(ST.wilcoxon_p(0, 5) - 0.0625) < 1e-12
    assert abs(ST.mann_whitney_p(0, 3, 3) - 0.1) < 1e-12


def test_distributed_exact_quantiles(spark):
    from vitrine.functions.quantile import exact_quantiles
    rng = random.Random(5)
    vals = [float(rng.randint(0, 50)) for _ in range(3000)] + [1e6, -1e6]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    qs = [0.05, 0.25, 0.33, 0.5, 0.75, 0.95]
    ref = df.agg(*[F.percentile("v", q).alias(str(i)) for i, q in enumerate(qs)]).first()
    got = exact_quantiles(df, "v", qs, accuracy=100)
    for i, q in enumerate(qs):
        assert abs(got[q] - ref[str(i)]) < 1e-9, q


def test_latest_per_key_hot_key(spark):
    """One key holds a third of all rows: the struct-max aggregate gives the
    window answer and combines map-side (partial aggregation before the shuffle)."""
    from vitrine.operators.relational import latest_per_key
    rng = random.Random(9)
    rows = [(0 if i % 3 == 0 else rng.randint(1, 200), i, rng.randint(0, 50), float(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "product_id long, id long, t long, v double").repartition(8)
    got = latest_per_key(df, "product_id", ["t", "id"])
    w = Window.partitionBy("product_id").orderBy(F.col("t").desc(), F.col("id").desc())
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(map(tuple, got.select("product_id", "id", "t", "v").collect())) == \
        sorted(map(tuple, ref.select("product_id", "id", "t", "v").collect()))
    assert "partial_max" in got._jdf.queryExecution().sparkPlan().toString()
