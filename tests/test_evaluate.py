"""Evaluation, recommendation and bootstrap against plain Python."""

import random

import numpy as np
import pytest

PRED = "model string, row_id long, fold long, y_true int, y_pred int, proba double"


@pytest.fixture(scope="module")
def data():
    r = random.Random(4)
    out = [("a", i, i % 3, int(r.random() < 0.4), int(r.random() < 0.5), round(r.random(), 1)) for i in range(400)]  # many ties
    out += [("b", 1000 + i, i % 3, int(r.random() < 0.5), int(r.random() < 0.5), r.random()) for i in range(150)]
    out += [("c", 2000 + i, 0, 1, 1, 0.5) for i in range(20)]  # one class, one score
    out += [("d", 3000, 0, 1, 0, 0.25), ("d", 3001, 0, 0, 0, 0.25), ("d", 3002, 0, 0, 1, 0.75)]
    return out


def auc(pos, neg):
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_metrics_with_auc_and_weighted_metrics(spark, data):
    from vitrine.operators import evaluate as EV
    p = spark.createDataFrame(data, PRED)
    got = {r.model: r for r in EV.metrics(p, ["model"]).collect()}
    even = {r.model: r for r in EV.weighted_metrics(p, ["model"]).collect()}
    assert set(got) == {"a", "b", "c", "d"} and got["c"].roc_auc is None
    for m in "abd":
        rows = [x for x in data if x[0] == m]
        assert abs(got[m].roc_auc - auc([x[5] for x in rows if x[3]], [x[5] for x in rows if not x[3]])) < 1e-12
        want = {"precision": 0, "recall": 0, "f1_score": 0}
        for c in (0, 1):
            tp = sum(x[3] == c and x[4] == c for x in rows)
            said, true = sum(x[4] == c for x in rows), sum(x[3] == c for x in rows)
            for k, v in (("precision", tp / said if said else 0), ("recall", tp / true if true else 0), ("f1_score", 2 * tp / (said + true) if said + true else 0)):
                want[k] += v * true / len(rows)
        assert all(abs(even[m][k] - v) < 1e-12 for k, v in want.items())


def test_drift_tells_which_metric_fell(spark):
    from vitrine.operators import evaluate as EV
    schema = "model string, accuracy double, precision double, recall double, f1_score double"
    now = spark.createDataFrame([("m", 0.8, 0.7, 0.6, 0.5), ("n", 0.9, 0.9, 0.9, 0.9)], schema)
    was = spark.createDataFrame([("m", 0.8, 0.76, 0.64, 0.4), ("n", 0.8, 0.8, 0.8, 0.8)], schema)
    got = {(r.model, r.metric): (r.degraded, r.model_degraded) for r in EV.drift(now, was).collect()}
    assert got == {("m", "accuracy"): (False, True), ("m", "precision"): (True, True), ("m", "recall"): (False, True),
                   ("m", "f1_score"): (False, True)} | {("n", k): (False, False) for k in EV.WEIGHTED}


def test_prediction_check_fails_what_it_must(spark):
    from vitrine.operators.evaluate import prediction_check
    df = spark.createDataFrame([("ok", 0, 0, [0.4, 0.6]), ("ok", 1, 0, [0.0, 1.0]), ("sum", 0, 0, [0.4, 0.61]), ("near", 0, 0, [0.4, 0.6009]),
                                ("range", 0, 0, [-0.1, 1.1]), ("null", 0, 0, None), ("class", 0, 2, [0.5, 0.5]), ("class", 1, 3, [0.5, 0.5])],
                               "model string, y_true int, y_pred int, probs array<double>")
    got = {r.model: (r.classes_ok, r.proba_range_ok, r.proba_sum_ok, r.unknown_classes) for r in prediction_check(df, ["model"], "probs").collect()}
    assert got == {"ok": (True, True, True, ""), "sum": (True, True, False, ""), "near": (True, True, True, ""), "range": (True, False, True, ""),
                   "null": (True, False, False, ""), "class": (False, True, True, "2,3")}


def test_traits_and_recommendation(spark):
    from vitrine import config as C
    from vitrine.operators.recommend import model_traits, recommend
    names = ["Logistic Regression", "linear_svm", "Decision Tree", "RandomForest", "SVM rbf", "support machine", "naive_bayes", "gradient boosting",
             "MLP", "deep net", "neural", "xgboost tree", "other"]
    cv = spark.createDataFrame([(m, k, f, 0.5 + 0.01 * i * f) for i, m in enumerate(names[:-1]) for k in ("x", "y") for f in range(3)],
                               "model string, metric string, fold int, score double")
    got = {r.model: r for r in model_traits(spark.createDataFrame([(n,) for n in names], "model string"), cv).collect()}
    assert set(got) == set(names) and got["other"].stability == C.DEFAULT_TRAIT
    for i, n in enumerate(names):
        for t, rules in C.MODEL_TRAITS.items():
            assert got[n][t] == next((v for words, v in rules if any(w in n.lower() for w in words)), C.DEFAULT_TRAIT), (n, t)
        if n != "other":
            assert abs(got[n].stability - max(0, 1 - 10 * float(np.std([0, 0.01 * i, 0.02 * i])))) < 1e-9
    m = spark.createDataFrame([("logistic", 0.9, 0.85), ("forest", 0.9, 0.7), ("svm", 0.5, 0.9)], "model string, f1_score double, accuracy double")
    std = spark.createDataFrame([("logistic", 0.2), ("forest", 0.01)], "model string, test_std double")
    plain = {r.model: r for r in recommend(m, std).collect()}
    assert {k: round(r.score, 9) for k, r in plain.items()} == {"logistic": 0.46, "forest": 0.21, "svm": 0.4}
    assert plain["logistic"].recommended and plain["logistic"].warnings == "Low overall recommendation score - consider model improvement"
    assert plain["forest"].warnings == "" and plain["forest"].reasons == \
        "f1_score: 0.900; Below accuracy requirement (0.700 < 0.8); High stability (CV std: 0.010)"
    more = {r.model: round(r.score, 9) for r in recommend(m, std, interpretability=True, speed=True).collect()}
    assert more == {"logistic": 0.66, "forest": 0.31, "svm": 0.4}
    with pytest.raises(ValueError):
        from vitrine.operators.evaluate import rank_models
        rank_models(m, {"f1_score": 0.5})


def test_bootstrap_equals_plain_weighted_auc(spark, data):
    from vitrine.operators import bootstrap as BS
    p = spark.createDataFrame(data + [("a", None, 0, 1, 1, 0.5), ("a", 9, 0, 1, 1, None)], PRED).repartition(5)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.model, r.rep): r.auc for r in BS.auc_by_replicate(p, "model", 20, 3).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    want = {}
    for m in "abcd":
        rows = [x for x in data if x[0] == m]
        w = BS.weights(np.array([x[1] for x in rows]), 20, 3)
        y, s = np.array([x[3] for x in rows]), np.array([x[5] for x in rows])
        wins = (s[:, None] > s[None, :]) + (s[:, None] == s[None, :]) / 2
        for b in range(20):
            pos, neg = w[:, b] * y, w[:, b] * (1 - y)
            if pos.sum() and neg.sum():
                want[m, b + 1] = float(pos @ wins @ neg) / (pos.sum() * neg.sum())
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-12 for k, v in want.items())
    assert BS.auc_by_replicate(p.limit(0), "model", 20, 3).count() == 0


def test_bootstrap_weights_are_poisson():
    from vitrine.operators import bootstrap as BS
    w = BS.weights(np.arange(20000), 40, 42)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.03
    assert abs(np.corrcoef(w[:-1, 5], w[1:, 5])[0, 1]) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01


def test_t_quantiles_beyond_the_table(spark):
    from vitrine.functions.stats import t_ppf, t_tail
    from vitrine.operators.evaluate import fold_stats
    for df in (201, 999, 100000):
        assert abs(sum(c / df**i for i, c in enumerate(t_tail())) - t_ppf(0.975, df)) < 1e-9
    cv = spark.createDataFrame([("m", "x", float(i % 7)) for i in range(300)], "model string, metric string, score double")
    r = fold_stats(cv, spark.createDataFrame([(1, 12.7)], "df long, t double")).first()
    half = t_ppf(0.975, 299) * float(np.std([i % 7 for i in range(300)], ddof=1)) / 300**0.5
    assert abs(r.ci_upper - r["mean"] - half) < 1e-9
