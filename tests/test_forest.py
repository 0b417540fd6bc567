"""Forests of the model search: cut short they are the forests that MLlib would grow, and searches use stratified folds."""

import pytest
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def rows(spark):
    """Two continuous slots and one of two categories; classes 3 : 1, not separable."""
    df = spark.range(240).select("id", (F.col("id") % 4 == 0).cast("double").alias("label"),
                                 ((F.col("id") * 37) % 101).cast("double").alias("a"), ((F.col("id") * 17) % 13).cast("double").alias("b"),
                                 F.col("id").bitwiseAND(2).cast("string").alias("s"))
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    df = StringIndexer(inputCol="s", outputCol="i").fit(df).transform(df)
    df = OneHotEncoder(inputCols=["i"], outputCols=["o"], dropLast=False).fit(df).transform(df)
    return VectorAssembler(inputCols=["a", "b", "o"], outputCol="features").transform(df).select("id", "label", "features").coalesce(1).cache()


def _said(model, rows):
    return {r.id: r.prediction for r in model.transform(rows).select("id", "prediction").collect()}


def _differ(a: dict, b: dict) -> int:
    return sum(a[i] != b[i] for i in a)


def test_an_uncut_forest_predicts_as_mllib(spark, rows):
    from vitrine.operators.forest import Forest
    trees = RandomForestClassifier(numTrees=7, maxDepth=6, seed=3)
    assert _differ(_said(Forest(trees).fit(rows), rows), _said(trees.fit(rows), rows)) == 0


def test_one_growth_gives_the_shallower_and_the_weighted_forests(spark, rows):
    from vitrine.operators.forest import Forest
    trees = RandomForestClassifier(numTrees=3, maxDepth=8, seed=3, featureSubsetStrategy="all", bootstrap=False)
    est = Forest(trees)
    grown = []
    est_grow = Forest._grow
    try:
        Forest._grow = lambda self, df, n, depth: grown.append((n, depth)) or est_grow(self, df, n, depth)
        maps = [{trees.maxDepth: 2}, {trees.maxDepth: 8}, {trees.maxDepth: 4, trees.numTrees: 1}]
        models = dict(est.fitMultiple(rows, maps))
    finally:
        Forest._grow = est_grow
    assert grown == [(3, 8)]
    for i, m in enumerate(maps):  # all trees of such a forest are one tree, and a node's split does not hang on the depth
        assert _differ(_said(models[i], rows), _said(trees.fit(rows, m), rows)) == 0
    weighted = trees.copy({trees.weightCol: "w"}).fit(rows.withColumn("w", F.when(F.col("label") == 1, 240 / (2 * 60)).otherwise(240 / (2 * 180))))
    assert _differ(_said(est.fit(rows, {est.classWeight: "balanced"}), rows), _said(weighted, rows)) == 0


def test_nodes_of_few_samples_are_not_split(spark):
    from vitrine.operators.forest import Forest
    # the root parts 1, 2, 3 from 7, 8, 9; each side of three could be parted again
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.createDataFrame(
        [(0, 0.0, 1.0), (1, 0.0, 2.0), (2, 1.0, 3.0), (3, 1.0, 7.0), (4, 1.0, 8.0), (5, 1.0, 9.0)], "id long, label double, a double")).coalesce(1)
    est = Forest(RandomForestClassifier(numTrees=1, maxDepth=5, bootstrap=False, featureSubsetStrategy="all"))
    whole = _said(est.fit(df), df)
    assert whole == {0: 0.0, 1: 0.0, 2: 1.0, 3: 1.0, 4: 1.0, 5: 1.0}
    shares = lambda m: {r.id: max(r.rawPrediction) for r in est.fit(df, {est.minSamplesSplit: m}).transform(df).collect()}
    assert set(shares(6).values()) == {1.0} and {round(v, 6) for v in shares(7).values()} == {round(4 / 6, 6)}


class _Seen(Model):
    def _transform(self, df):
        return df.withColumn("prediction", F.lit(1.0))


class _Probe(Estimator):
    def __init__(self, seen):
        super().__init__()
        self.seen = seen

    def _fit(self, df):
        self.seen.append({r[0]: r[1] for r in df.groupBy("label").count().collect()})
        return _Seen()


def test_folds_are_stratified_and_scored_by_class_one(spark):
    from vitrine.operators.ml import search
    df = spark.range(60).select("id", (F.col("id") < 10).cast("double").alias("label")).repartition(7)
    seen = []
    _, scores = search(_Probe(seen), [{}], df, folds=5, id_col="id")
    assert seen == [{1.0: 8, 0.0: 40}] * 5 + [{1.0: 10, 0.0: 50}]  # five folds, then all rows
    assert scores == [pytest.approx(2 * 2 / (12 + 2))]  # a fold of 12 rows, all said to be 1


def _asked(monkeypatch, query):
    """Estimator, maps and settings with which a query searches."""
    from vitrine.operators import ml as ML
    from vitrine.plans import ml_queries as Q
    got = {}
    monkeypatch.setattr(Q, "prepared", lambda spark, d: (None, None, None, None))
    monkeypatch.setattr(ML, "search", lambda est, maps, data, **k: got.update(est=est, maps=maps, **k) or (None, [0.5] * len(maps)))
    got["rows"] = query(Q)
    return got


def test_cv_rf_tries_the_whole_grid_on_five_stratified_folds(spark, monkeypatch):
    got = _asked(monkeypatch, lambda Q: Q.q_cv_rf(spark, "none").collect())
    assert got["folds"] == 5 and got["id_col"] == "doc_id" and len(got["rows"]) == 24
    values = {}
    for r in got["rows"]:
        for k, v in eval(r.params).items():
            values.setdefault(k, set()).add(v)
    assert values == {"numTrees": {100, 200}, "maxDepth": {10, 20, 30}, "minSamplesSplit": {2, 5}, "featureSubsetStrategy": {"sqrt", "log2"}}
    assert len({r.params for r in got["rows"]}) == 24


def test_random_search_takes_a_hundred_draws_on_five_stratified_folds(spark, monkeypatch):
    got = _asked(monkeypatch, lambda Q: Q.q_random_search(spark, "none").collect())
    assert got["folds"] == 5 and got["id_col"] == "doc_id" and len(got["rows"]) == 100
    draws = [eval(r.params) for r in got["rows"]]
    assert all(50 <= p["numTrees"] <= 500 and 2 <= p["minSamplesSplit"] <= 20 and 1 <= p["minInstancesPerNode"] <= 10 for p in draws)
    assert len({p["numTrees"] for p in draws}) > 50 and {p["maxDepth"] for p in draws} == {5, 10, 15, 20, 25, 30}
    assert {p["classWeight"] for p in draws} == {"none", "balanced", "balanced_subsample"} and {p["bootstrap"] for p in draws} == {True, False}


def test_search_compare_searches_all_four_models_on_stratified_folds(spark, monkeypatch):
    from vitrine.operators import ml as ML
    from vitrine.plans import ml_queries as Q
    asked = []
    monkeypatch.setattr(Q, "prepared", lambda spark, d: (None, None, None, None))
    monkeypatch.setattr(ML, "search", lambda est, maps, data, **k: asked.append((k["folds"], k["id_col"], len(maps))) or (None, [0.5] * len(maps)))
    got = Q.q_search_compare(spark, "none").collect()
    assert {r["model"] for r in got} == {"random_forest", "logistic_regression", "svm", "gradient_boosting"}
    assert len(asked) == 4 and all(x[:2] == (5, "doc_id") for x in asked) and sorted(r["iterations"] for r in got) == sorted(x[2] for x in asked)


def test_compared_searches(spark):
    from vitrine.operators.ml import compare_searches
    rows = [("random_forest", 0.7, 30.0, "random"), ("random_forest", 0.9, 30.0, "random"), ("svm", 0.6, 5.0, "grid"), ("lr", 0.6, 3.0, "grid"),
            ("gradient_boosting", 0.0, 9.0, "grid")]
    got = compare_searches(spark.createDataFrame(rows, "model string, score double, seconds double, strategy string")).orderBy("rank").collect()
    assert [(r["rank"], r["model"], r["best_score"], r["seconds"], r["method"], r["iterations"]) for r in got] == [
        (1, "random_forest", 0.9, 60.0, "random", 2), (2, "lr", 0.6, 3.0, "grid", 1), (3, "svm", 0.6, 5.0, "grid", 1)]  # what scored 0 failed
    assert [r["efficiency"] for r in got] == pytest.approx([0.9, 12.0, 7.2])
    r = got[0]
    assert (r["best_model"], r["most_efficient"], r["fastest"], r["slowest"]) == ("random_forest", "lr", "lr", "random_forest")
    assert (r["score_min"], r["score_max"]) == (0.6, 0.9) and r["score_std"] == pytest.approx(0.3 / 3 ** 0.5) and r["avg_seconds"] == pytest.approx(68 / 3)
    assert r["recommendations"] == [
        "Best performing model: random_forest (score: 0.9000)", "Significant performance differences detected (std: 0.1732)",
        "Most efficient model: lr (best score/time ratio)", "Consider efficiency vs. performance trade-off for production deployment",
        "Mixed optimization methods used - automatic selection working well", "Random Forest in top 3 - good baseline with interpretability"]
