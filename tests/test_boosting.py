"""Early stopping, permutation importance and exact quantiles against plain computations."""

import random

import pytest
from pyspark.ml.linalg import Vectors


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(8)
    out = []
    for i in range(240):
        v = [r.random(), float(r.random() < 0.2), r.random(), 0.0]
        out.append((i, float(v[0] + 0.3 * v[1] + 0.5 * r.random() > 0.75), Vectors.dense(v) if i % 2 else Vectors.sparse(4, {j: x for j, x in enumerate(v) if x})))
    return spark.createDataFrame(out, ["doc_id", "label", "features"])


def plain_auc(got):
    pos, neg = [m for m, y in got if y], [m for m, y in got if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_staged_auc_equals_refits(spark, rows):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array

    from vitrine.operators.boosting import early_stopped, staged_auc, stop_at
    train, val = rows.where("doc_id % 4 != 0"), rows.where("doc_id % 4 = 0")

    def fit(df, n):
        return GBTClassifier(maxIter=n, stepSize=0.1, maxDepth=3, subsamplingRate=0.8, seed=42).fit(df)
    auc = staged_auc(fit(train, 4), {"v": val})["v"]
    for n in (1, 3, 4):
        got = fit(train, n).transform(val).select(vector_to_array("rawPrediction")[1], "label").collect()
        assert abs(plain_auc([tuple(x) for x in got]) - auc[n - 1]) < 1e-9
    model, history, best = early_stopped(train, val, n_trees=6, patience=2, first=3)
    assert model.getNumTrees == best and [h[0] for h in history] == list(range(1, len(history) + 1)) and len(history) <= 6
    assert stop_at([h[2] for h in history], 2)[0] == best


def test_the_rule_of_stopping():
    from vitrine.operators.boosting import stop_at
    assert stop_at([0.5, 0.6, 0.60005, 0.6, 0.7], 3) == (5, None)
    assert stop_at([0.5, 0.6, 0.60005, 0.6, 0.6, 0.9], 3) == (2, 5)
    assert stop_at([0.4], 1) == (1, None)


def test_permutation_importance_of_all_slots(spark, rows):
    from pyspark.ml.classification import LogisticRegression

    from vitrine.operators.interpret import linear_permutation_importance, permutations
    model = LogisticRegression(regParam=0.01).fit(rows)
    got = {r.feature: (r.importance_mean, r.importance_std) for r in
           linear_permutation_importance(model, rows, "doc_id", ["a", "b", "c", "d"], repeats=3).collect()}
    perm = {}
    for r in permutations(rows, "doc_id", 3).collect():
        perm.setdefault(r.repeat, {})[r.doc_id] = r.donor
    data = {r.doc_id: (r.label, r.features.toArray()) for r in rows.collect()}
    assert all(sorted(p) == sorted(p.values()) == sorted(data) for p in perm.values()) and len(perm) == 3 and perm[0] != perm[1]
    coef, b = model.coefficients.toArray(), model.intercept
    base = sum((coef @ v + b > 0) == y for y, v in data.values()) / len(data)
    for j, name in enumerate("abcd"):
        drops = []
        for p in perm.values():
            hit = 0
            for i, (y, v) in data.items():
                w = v.copy()
                w[j] = data[p[i]][1][j]
                hit += (coef @ w + b > 0) == y
            drops.append(base - hit / len(data))
        mean = sum(drops) / 3
        assert abs(got[name][0] - mean) < 1e-9 and abs(got[name][1] - (sum((x - mean) ** 2 for x in drops) / 3) ** 0.5) < 1e-7


def test_quantiles_are_the_same_by_both_ways(spark):
    from vitrine.functions.quantile import quantiles, quantiles_multi
    x = spark.createDataFrame([(1.0, 5.0), (2.0, None), (float("nan"), 5.0), (None, 7.0)], "a double, b double")
    assert quantiles(x, "a", [0.0, 0.5]) == quantiles(x, "a", [0.0, 0.5], large_rows=0) == {0.0: 1.0, 0.5: 2.0}
    assert quantiles_multi(x, ["b"], [0.25, 0.75]) == quantiles_multi(x, ["b"], [0.25, 0.75], large_rows=0)


def test_each_round_is_evaluated_once(spark, rows, monkeypatch):
    from vitrine.operators import boosting as B
    train, val = rows.where("doc_id % 4 != 0"), rows.where("doc_id % 4 = 0")
    seen, plain = [], B.staged_auc

    def counted(model, sides, after=0):
        out = plain(model, sides, after)
        seen.append((after, after + len(out["train"])))
        return out
    monkeypatch.setattr(B, "staged_auc", counted)
    _, history, _ = B.early_stopped(train, val, n_trees=5, patience=9, first=2)
    assert seen == [(0, 2), (2, 4), (4, 5)]
    from pyspark.ml.classification import GBTClassifier
    whole = plain(GBTClassifier(maxIter=5, stepSize=0.1, maxDepth=3, subsamplingRate=0.8, seed=42).fit(train.select("label", "features")), {"v": val})
    assert [h[2] for h in history] == whole["v"]


def test_running_margins_are_the_models(spark):
    """Continuous and categorical splits, and a plan that does not grow with the trees."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from vitrine.operators.boosting import staged_margins
    r = random.Random(3)
    data = [(x := r.random(), k := r.choice("abcde"), float(x * 0.6 + (k in "bd") * 0.5 + 0.3 * r.random() > 0.6)) for _ in range(300)]
    df = spark.createDataFrame(data, "x double, k string, label double")
    df = StringIndexer(inputCol="k", outputCol="i").fit(df).transform(df)
    df = VectorAssembler(inputCols=["x", "i"], outputCol="features").transform(df)
    model = GBTClassifier(maxIter=7, maxDepth=3, seed=1).fit(df)
    assert "in {" in model.toDebugString and "<=" in model.toDebugString
    both = staged_margins(model, model.transform(df)).withColumn("raw", vector_to_array("rawPrediction")[1]).collect()
    assert all(len(b.margins) == 7 and abs(b.margins[-1] - b.raw) < 1e-12 for b in both)
    late = staged_margins(model, df, 5)
    assert [list(x.margins) for x in late.collect()] == [list(b.margins[5:]) for b in both]
    plan = late._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(") < 7
