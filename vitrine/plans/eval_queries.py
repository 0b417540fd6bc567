"""Evaluation queries over the predictions / cv_scores fixtures (EVA*, WIN10, JOIN12)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitrine import config as C
from vitrine.functions import stats as ST
from vitrine.operators import bootstrap as BS
from vitrine.operators import evaluate as EV
from vitrine.operators import recommend as RC
from vitrine.operators.relational import distinct_values
from vitrine.plans.catalog import register
from vitrine.sources import fixtures as FX

#: Kinds of model under whose names recommendations see the fixture's models; others keep their own.
KINDS = {"click": "logistic_regression", "error": "svm_rbf", "purchase": "random_forest", "signup": "gradient_boosting", "view": "mlp_neural"}
KIND_SQL = "CASE model " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in KINDS.items()) + " ELSE model END"


def kind(c="model"):
    out = None
    for k, v in KINDS.items():
        hit = F.col(c) == k
        out = F.when(hit, F.lit(v)) if out is None else out.when(hit, F.lit(v))
    return out.otherwise(F.col(c))


def _r6(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


def _div(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / CAST(nullif({b}, 0) AS DOUBLE), 0e0)"


def counts_sql(keys, where="TRUE"):
    k = ", ".join(keys)
    return (f"SELECT {k}, count(*) AS n, count_if(y_true = 1 AND y_pred = 1) AS tp, count_if(y_true = 0 AND y_pred = 1) AS fp, "
            f"count_if(y_true = 1 AND y_pred = 0) AS fn, count_if(y_true = 0 AND y_pred = 0) AS tn FROM predictions WHERE {where} GROUP BY {k}")


METRIC_COLS = ["accuracy", "balanced_accuracy", "precision", "recall", "f1_score", "specificity", "sensitivity", "ppv", "npv", "mcc"]


def metrics_sql(keys, where="TRUE", digits=6):
    k = ", ".join(keys)
    prec, rec, spec = _div("tp", "tp + fp"), _div("tp", "tp + fn"), _div("tn", "tn + fp")
    expr = {"accuracy": _div("tp + tn", "n"), "balanced_accuracy": f"({rec} + {spec}) / 2", "precision": prec, "recall": rec,
            "f1_score": _div("2 * tp", "2 * tp + fp + fn"), "specificity": spec, "sensitivity": rec, "ppv": prec,
            "npv": _div("tn", "tn + fn"),
            "mcc": "coalesce((CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / nullif(sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0e0)"}
    cols = ", ".join((f"round({e}, {digits})" if digits else e) + f" AS {m}" for m, e in expr.items())
    return f"SELECT {k}, n, tp, fp, fn, tn, {cols} FROM ({counts_sql(keys, where)})"


AUC_SQL = """(SELECT model, sum(pos * (cum_neg - neg + neg / 2e0)) / nullif(sum(pos) * sum(neg), 0) AS roc_auc FROM
  (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM
  (SELECT model, proba AS score, count_if(y_true = 1) AS pos, count_if(y_true = 0) AS neg FROM predictions GROUP BY model, proba)) GROUP BY model)"""


def all_metrics_sql(digits=6):
    """Metrics by model with roc_auc."""
    auc = f"round(a.roc_auc, {digits})" if digits else "a.roc_auc"
    return f"SELECT m.*, {auc} AS roc_auc FROM ({metrics_sql(['model'], digits=digits)}) m LEFT JOIN {AUC_SQL} a ON m.model = a.model"


def _pred(spark, d):
    return FX.predictions(spark, d)


def _metrics(spark, d, keys, digits=6):
    m = EV.metrics_from_counts(EV.confusion_counts(_pred(spark, d), keys))
    return m.withColumns({c: F.round(c, digits) for c in METRIC_COLS})


def _all_metrics(spark, d, digits=6):
    m = EV.metrics(_pred(spark, d), ["model"])
    return m.withColumns({c: F.round(c, digits) for c in [*METRIC_COLS, "roc_auc"]}) if digits else m


@register("metrics", all_metrics_sql())
def q_metrics(spark, d):
    """Every metric of each model (EVA1)."""
    return _all_metrics(spark, d)


@register("metrics_by_model", all_metrics_sql(4) + " ORDER BY f1_score DESC")
def q_metrics_by_model(spark, d):
    return _all_metrics(spark, d, 4).orderBy(F.col("f1_score").desc())


@register("class_report", f"""WITH c AS ({counts_sql(["model"])}),
per AS (SELECT model, '1' AS class, {_div('tp', 'tp + fp')} AS precision, {_div('tp', 'tp + fn')} AS recall, {_div('2 * tp', '2 * tp + fp + fn')} AS f1_score, tp + fn AS support FROM c
  UNION ALL SELECT model, '0', {_div('tn', 'tn + fn')}, {_div('tn', 'tn + fp')}, {_div('2 * tn', '2 * tn + fn + fp')}, tn + fp FROM c),
allr AS (SELECT * FROM per UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM per GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1_score * support) / sum(support), sum(support) FROM per GROUP BY model)
SELECT model, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM allr""")
def q_class_report(spark, d):
    return _r6(EV.class_report(_pred(spark, d), ["model"]))


ROC_SQL = """WITH st AS (SELECT model, proba AS score, count_if(y_true = 1) AS pos, count_if(y_true = 0) AS neg FROM predictions GROUP BY model, proba),
tot AS (SELECT model, sum(pos) AS P, sum(neg) AS N FROM st GROUP BY model),
c AS (SELECT model, score, sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
  sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM st),
roc AS (SELECT c.model, c.score AS threshold, c.tp, c.fp, P, N FROM c JOIN tot ON c.model = tot.model
  UNION ALL SELECT model, 'inf'::DOUBLE, 0, 0, P, N FROM tot),
rc AS (SELECT *, """ + _div("tp", "P") + " AS tpr, " + _div("fp", "N") + " AS fpr FROM roc)"


@register("roc_curve", ROC_SQL + " SELECT model, threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM rc")
def q_roc_curve(spark, d):
    return _r6(EV.roc_curve(_pred(spark, d), ["model"]).select("model", "threshold", "tp", "fp", "tpr", "fpr"))


@register("roc_auc", """WITH st AS (SELECT model, proba AS score, count_if(y_true = 1) AS pos, count_if(y_true = 0) AS neg FROM predictions GROUP BY model, proba),
c AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM st)
SELECT model, round(sum(pos * (cum_neg - neg + neg / 2e0)) / (sum(pos) * sum(neg)), 6) AS auc FROM c GROUP BY model""")
def q_roc_auc(spark, d):
    return _r6(EV.roc_auc(_pred(spark, d), ["model"]))


@register("pr_curve", ROC_SQL + " SELECT model, threshold, round(" + _div("tp", "tp + fp") + ", 6) AS precision, round(tpr, 6) AS recall FROM rc WHERE threshold <> 'inf'::DOUBLE")
def q_pr_curve(spark, d):
    return _r6(EV.pr_curve(_pred(spark, d), ["model"]))


ROC_POINTS_SQL = ROC_SQL + """, pts AS (SELECT model, max(tpr - fpr) AS youden_j, arg_max(threshold, (tpr - fpr, threshold)) AS youden_threshold,
  max(CASE WHEN tpr >= 0.95 THEN threshold END) AS threshold_tpr_goal, min(CASE WHEN 1 - fpr >= 0.95 THEN threshold END) AS threshold_spec_goal FROM rc GROUP BY model)"""


@register("roc_points", ROC_POINTS_SQL + " SELECT model, round(youden_j, 6) AS youden_j, youden_threshold, threshold_tpr_goal, threshold_spec_goal FROM pts")
def q_roc_points(spark, d):
    return _r6(EV.roc_points(EV.roc_curve(_pred(spark, d), ["model"]), ["model"]))


@register("roc_compare", ROC_POINTS_SQL + """, auc AS (SELECT model, sum(pos * (cum_neg - neg + neg / 2e0)) / (sum(pos) * sum(neg)) AS auc FROM
  (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM st) GROUP BY model)
SELECT p.model, round(auc, 6) AS auc, round(youden_j, 6) AS youden_j, youden_threshold, CAST(row_number() OVER (ORDER BY auc DESC, p.model) AS INTEGER) AS auc_rank
FROM pts p JOIN auc a ON p.model = a.model""")
def q_roc_compare(spark, d):
    from pyspark.sql import Window
    p = _pred(spark, d)
    pts = EV.roc_points(EV.roc_curve(p, ["model"]), ["model"]).join(EV.roc_auc(p, ["model"]), "model")
    return _r6(pts.select("model", "auc", "youden_j", "youden_threshold",
                          F.row_number().over(Window.orderBy(F.col("auc").desc(), "model")).alias("auc_rank")))


@register("best_threshold", ROC_SQL + """ SELECT model, arg_max(threshold, (tpr - fpr, threshold)) AS youden_threshold,
  arg_min(threshold, (sqrt(pow(fpr, 2) + pow(1 - tpr, 2)), -threshold)) AS closest_threshold,
  arg_max(threshold, (""" + _div("2 * tp", "tp + fp + P") + """, threshold)) AS f1_threshold, round(max(""" + _div("2 * tp", "tp + fp + P") + """), 6) AS best_f1
FROM rc WHERE threshold <> 'inf'::DOUBLE GROUP BY model""")
def q_best_threshold(spark, d):
    return _r6(EV.best_threshold(EV.roc_curve(_pred(spark, d), ["model"]), ["model"]))


#: Class probabilities of the predictions, with the faults that the check looks for in some rows.
CHECKED_SQL = """SELECT model, y_true, CASE WHEN model = 'error' AND row_id % 101 = 0 THEN 2 ELSE y_pred END AS y_pred,
  [CASE WHEN model = 'click' AND row_id % 7 = 0 THEN 1.01e0 - proba WHEN model = 'purchase' AND row_id % 13 = 0 THEN 1.5e0 ELSE 1 - proba END,
   CASE WHEN model = 'purchase' AND row_id % 13 = 0 THEN -0.5e0 ELSE proba END] AS probs FROM predictions"""


def _checked(spark, d):
    p, i, out = F.col("proba"), F.col("row_id"), (F.col("model") == "purchase") & (F.col("row_id") % 13 == 0)
    first = F.when((F.col("model") == "click") & (i % 7 == 0), F.lit(1.01) - p).when(out, F.lit(1.5)).otherwise(1 - p)
    return _pred(spark, d).select("model", "y_true", F.when((F.col("model") == "error") & (i % 101 == 0), F.lit(2)).otherwise(F.col("y_pred")).alias("y_pred"),
                                  F.array(first, F.when(out, F.lit(-0.5)).otherwise(p)).alias("probs"))


@register("prediction_check", f"""WITH g AS (SELECT model, list_distinct(list(y_pred)) AS p, list_distinct(list(y_true)) AS t,
  count_if(NOT (probs[1] BETWEEN 0 AND 1 AND probs[2] BETWEEN 0 AND 1)) = 0 AS proba_range_ok,
  count_if(abs(probs[1] + probs[2] - 1) > {EV.SUM_TOLERANCE!r}) = 0 AS proba_sum_ok FROM ({CHECKED_SQL}) GROUP BY model),
u AS (SELECT *, list_sort(list_filter(p, lambda x: NOT list_contains(t, x))) AS unknown FROM g)
SELECT model, len(unknown) = 0 AS classes_ok, proba_range_ok, proba_sum_ok, array_to_string(unknown, ',') AS unknown_classes FROM u""")
def q_prediction_check(spark, d):
    return EV.prediction_check(_checked(spark, d), ["model"], "probs")


def _conf_sql(keys, normalize):
    k = ", ".join(keys)
    base = f"SELECT {k}, y_true, count_if(y_pred = 0) AS pred_0, count_if(y_pred = 1) AS pred_1 FROM predictions GROUP BY {k}, y_true"
    if not normalize:
        return base
    return f"SELECT {k}, y_true, round({_div('pred_0', 'pred_0 + pred_1')}, 6) AS pred_0, round({_div('pred_1', 'pred_0 + pred_1')}, 6) AS pred_1 FROM ({base})"


@register("confusion", _conf_sql(["model", "fold"], False))
def q_confusion(spark, d):
    """Confusion counts of every model on every fold (EVA22)."""
    return EV.confusion(_pred(spark, d), ["model", "fold"])


@register("confusion_normalized", _conf_sql(["model", "fold"], True))
def q_confusion_normalized(spark, d):
    return _r6(EV.confusion(_pred(spark, d), ["model", "fold"], normalize=True))


@register("confusion_by_model", _conf_sql(["model"], False))
def q_confusion_by_model(spark, d):
    return EV.confusion(_pred(spark, d), ["model"])


# ------------------------------------------------------------- fold stats --
T_ROWS = ST.t_table(200)
T_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"({a}, {b!r}::DOUBLE)" for a, b in T_ROWS) + ") tt(df, t))"

T_BEYOND = "CASE WHEN g.n > 1 THEN " + " + ".join(f"{c!r} / pow(g.n - 1, {i})" for i, c in enumerate(EV.T_TAIL)) + " END"


def _t_frame(spark):
    return spark.createDataFrame(T_ROWS, "df long, t double")


CV_STATS_SQL = f"""WITH g AS (SELECT model, metric, avg(score) AS mean, stddev_pop(score) AS std, stddev_samp(score) AS sds, min(score) AS min, max(score) AS max,
  quantile_cont(score, 0.25) AS q25, quantile_cont(score, 0.5) AS median, quantile_cont(score, 0.75) AS q75, count(*) AS n FROM cv_scores WHERE side = 'test' GROUP BY model, metric),
s AS (SELECT g.*, coalesce(tt.t, {T_BEYOND}) AS t FROM g LEFT JOIN {T_SQL} tt ON g.n - 1 = tt.df)
SELECT model, metric, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, round(max, 6) AS max, round(q25, 6) AS q25, round(median, 6) AS median,
  round(q75, 6) AS q75, round(q75 - q25, 6) AS iqr, round({_div('std', 'mean')}, 6) AS cv, round(mean - t * sds / sqrt(n), 6) AS ci_lower,
  round(mean + t * sds / sqrt(n), 6) AS ci_upper, n FROM s"""


def _cv_test(spark, d):
    return FX.cv_scores(spark, d).where(F.col("side") == "test")


@register("cv_stats", CV_STATS_SQL)
def q_cv_stats(spark, d):
    return _r6(EV.fold_stats(_cv_test(spark, d), _t_frame(spark)))


@register("cv_compare", f"SELECT model, mean, std, ci_lower, ci_upper FROM ({CV_STATS_SQL}) WHERE metric = 'f1_score' ORDER BY mean DESC")
def q_cv_compare(spark, d):
    s = EV.fold_stats(_cv_test(spark, d), _t_frame(spark)).where(F.col("metric") == "f1_score")
    return _r6(s.select("model", "mean", "std", "ci_lower", "ci_upper").orderBy(F.col("mean").desc()))


CV_DETAIL_SQL = """SELECT model, metric, round(avg(CASE WHEN side = 'train' THEN score END), 6) AS train_mean, round(avg(CASE WHEN side = 'test' THEN score END), 6) AS test_mean,
  round(stddev_pop(CASE WHEN side = 'test' THEN score END), 6) AS test_std, round(min(CASE WHEN side = 'test' THEN score END), 6) AS test_min,
  round(max(CASE WHEN side = 'test' THEN score END), 6) AS test_max,
  round(avg(CASE WHEN side = 'train' THEN score END) - avg(CASE WHEN side = 'test' THEN score END), 6) AS overfitting FROM cv_scores GROUP BY model, metric"""


def _cv_detail(spark, d):
    cv = FX.cv_scores(spark, d)
    tr, te = F.when(F.col("side") == "train", F.col("score")), F.when(F.col("side") == "test", F.col("score"))
    return cv.groupBy("model", "metric").agg(F.avg(tr).alias("train_mean"), F.avg(te).alias("test_mean"), F.stddev_pop(te).alias("test_std"),
                                             F.min(te).alias("test_min"), F.max(te).alias("test_max"),
                                             (F.avg(tr) - F.avg(te)).alias("overfitting"))


@register("cv_detail", CV_DETAIL_SQL)
def q_cv_detail(spark, d):
    """Train and test fold statistics and overfitting (aggregation part of EVA12)."""
    return _r6(_cv_detail(spark, d))


COMPARED = ("accuracy", "precision", "recall", "f1_score")


@register("comparison_table", "WITH c AS (" + CV_DETAIL_SQL.replace("round(", "(").replace(", 6)", ")") + "), w AS (SELECT model, " + ", ".join(
    f"max(CASE WHEN metric = '{m}' THEN {e} END) AS {n}" for m in COMPARED for e, n in (("test_mean", f"cv_{m}_mean"), ("test_std", f"cv_{m}_std"), ("overfitting", f"overfitting_{m}")))
    + " FROM c GROUP BY model) SELECT m.model, " + ", ".join(f"round(m.{m}, 4) AS test_{m}" for m in (*COMPARED, "roc_auc")) + ", "
    + ", ".join(f"round({n}, 4) AS {n}" for m in COMPARED for n in (f"cv_{m}_mean", f"cv_{m}_std", f"overfitting_{m}"))
    + f" FROM ({all_metrics_sql(None)}) m LEFT JOIN w ON m.model = w.model ORDER BY test_f1_score DESC")
def q_comparison_table(spark, d):
    """Test metrics and AUC beside each metric's CV mean, std and overfitting (EVA18)."""
    m = _all_metrics(spark, d, None).select("model", *[F.col(x).alias(f"test_{x}") for x in (*COMPARED, "roc_auc")])
    at = {n: F.max(F.when(F.col("metric") == x, F.col(e))).alias(n) for x in COMPARED
          for e, n in (("test_mean", f"cv_{x}_mean"), ("test_std", f"cv_{x}_std"), ("overfitting", f"overfitting_{x}"))}
    j = m.join(_cv_detail(spark, d).groupBy("model").agg(*at.values()), "model", "left")
    return j.withColumns({c: F.round(c, 4) for c in j.columns if c != "model"}).orderBy(F.col("test_f1_score").desc())


PAIRS_SQL = """x AS (SELECT a.model AS model_a, b.model AS model_b, a.metric, a.fold, a.score AS xa, b.score AS xb, a.score - b.score AS d
  FROM cv_scores a JOIN cv_scores b ON a.metric = b.metric AND a.fold = b.fold AND a.side = b.side AND a.model < b.model WHERE a.side = 'test')"""
T_TEST_SQL = "avg(d) / (nullif(stddev_samp(d), 0e0) / sqrt(count(*))) AS t_stat, avg(d) / nullif(stddev_samp(d), 0e0) AS cohens_d"


def _pairs(spark, d):
    """Paired statistics of all pairs of the models there are, on every metric."""
    cv = _cv_test(spark, d)
    return EV.paired_stats(cv, distinct_values(cv, "model"))


@register("pairwise_ttest", f"""WITH {PAIRS_SQL}, t AS (SELECT model_a, model_b, metric, count(*) AS n, avg(d) AS mean_diff, {T_TEST_SQL} FROM x GROUP BY ALL)
SELECT model_a, model_b, metric, n, round(mean_diff, 6) AS mean_diff, round(t_stat, 6) AS t_stat, round(cohens_d, 6) AS cohens_d FROM t""")
def q_pairwise_ttest(spark, d):
    """Paired t statistic for all model pairs on fold scores (JOIN12)."""
    return _r6(_pairs(spark, d).select("model_a", "model_b", "metric", "n", "mean_diff", "t_stat", "cohens_d"))


@register("significance_stats", f"""WITH {PAIRS_SQL},
nz AS (SELECT *, abs(d) AS ad FROM x WHERE d <> 0),
rk AS (SELECT *, rank() OVER (PARTITION BY model_a, model_b, metric ORDER BY ad) + (count(*) OVER (PARTITION BY model_a, model_b, metric, ad) - 1) / 2e0 AS r FROM nz),
wil AS (SELECT model_a, model_b, metric, least(sum(CASE WHEN d > 0 THEN r ELSE 0e0 END), sum(CASE WHEN d < 0 THEN r ELSE 0e0 END)) AS wilcoxon_w, count(*) AS n_nonzero FROM rk GROUP BY ALL),
pool AS (SELECT model_a, model_b, metric, xa AS v, 1 AS g FROM x UNION ALL SELECT model_a, model_b, metric, xb, 2 FROM x),
pr AS (SELECT *, rank() OVER (PARTITION BY model_a, model_b, metric ORDER BY v) + (count(*) OVER (PARTITION BY model_a, model_b, metric, v) - 1) / 2e0 AS r FROM pool),
mw AS (SELECT model_a, model_b, metric, sum(CASE WHEN g = 1 THEN r END) - count_if(g = 1) * (count_if(g = 1) + 1) / 2e0 AS u1, count_if(g = 1) AS n1, count_if(g = 2) AS n2 FROM pr GROUP BY ALL),
t AS (SELECT model_a, model_b, metric, count(*) AS n, avg(d) AS mean_diff, {T_TEST_SQL} FROM x GROUP BY ALL)
SELECT t.model_a, t.model_b, t.metric, t.n, round(mean_diff, 6) AS mean_diff, round(t_stat, 6) AS t_stat, round(cohens_d, 6) AS cohens_d,
  round(wilcoxon_w, 6) AS wilcoxon_w, coalesce(n_nonzero, 0) AS n_nonzero, round(least(u1, n1 * n2 - u1), 6) AS u_stat, n1, n2
FROM t LEFT JOIN wil USING (model_a, model_b, metric) LEFT JOIN mw USING (model_a, model_b, metric)""")
def q_significance_stats(spark, d):
    """Paired t, Wilcoxon and Mann-Whitney statistics for every model pair (EVA15)."""
    return _r6(_pairs(spark, d))


_P_SCHEMA = "model_a string, model_b string, metric string, t_stat double, t_p double, wilcoxon_w double, wilcoxon_p double, u_stat double, mann_whitney_p double"


def _p_values(pdf: pd.DataFrame) -> pd.DataFrame:
    out = pdf[["model_a", "model_b", "metric", "t_stat", "wilcoxon_w", "u_stat"]].copy()
    out["t_p"] = [ST.t_sf_two_sided(t, n - 1) if n and n > 1 else float("nan") for t, n in zip(pdf["t_stat"], pdf["n"])]
    out["wilcoxon_p"] = [ST.wilcoxon_p(w, int(k)) if w == w else float("nan") for w, k in zip(pdf["wilcoxon_w"], pdf["n_nonzero"])]
    out["mann_whitney_p"] = [ST.mann_whitney_p(u, int(a), int(b)) if u == u else float("nan")
                             for u, a, b in zip(pdf["u_stat"], pdf["n1"], pdf["n2"])]
    return out[["model_a", "model_b", "metric", "t_stat", "t_p", "wilcoxon_w", "wilcoxon_p", "u_stat", "mann_whitney_p"]]


@register("significance")
def q_significance(spark, d):
    """p-values of the three tests: one grouped pandas step over the small
    statistics frame (one row per model pair)."""
    s = _pairs(spark, d)
    return s.groupBy("model_a", "model_b", "metric").applyInPandas(_p_values, _P_SCHEMA)


ANOVA_SQL = """WITH per AS (SELECT metric, model, avg(score) AS m, count(*) AS n, sum(score * score) AS ss FROM cv_scores WHERE side = 'test' GROUP BY metric, model),
g AS (SELECT metric, count(*) AS k, sum(n) AS N, sum(m * n) / sum(n) AS gm, sum(ss - n * m * m) AS ssw, sum(n * m * m) AS snm2 FROM per GROUP BY metric)
SELECT metric, k, CAST(N AS BIGINT) AS N, round(snm2 - N * gm * gm, 6) AS ss_between, round(ssw, 6) AS ss_within,
  round(((snm2 - N * gm * gm) / (k - 1)) / (ssw / (N - k)), 4) AS f_stat FROM g"""


@register("anova", ANOVA_SQL)
def q_anova(spark, d):
    a = EV.anova_f(_cv_test(spark, d))
    return _r6(a).withColumn("f_stat", F.round("f_stat", 4))


@register("anova_p")
def q_anova_p(spark, d):
    """ANOVA p-value by the F tail over the small per-metric frame (EVA19)."""
    a = EV.anova_f(_cv_test(spark, d))

    def p(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.copy()
        pdf["p_value"] = [ST.f_sf(f, k - 1, n - k) for f, k, n in zip(pdf["f_stat"], pdf["k"], pdf["N"])]
        return pdf[["metric", "f_stat", "p_value"]]
    return a.groupBy("metric").applyInPandas(p, "metric string, f_stat double, p_value double")


# ------------------------------------------------------- recommendations --
def _three_sql(x):
    return f"CAST(CAST(round({x}, 3) AS DECIMAL(8, 3)) AS VARCHAR)"


def _any_sql(words):
    return "(" + " OR ".join(f"contains(lower(model), '{w}')" for w in words) + ")"


@register("recommend_score", f"""WITH m AS (SELECT {KIND_SQL} AS model, f1_score AS f1, accuracy AS acc, test_std AS sd FROM ({metrics_sql(["model"], digits=None)}) m LEFT JOIN
  (SELECT model AS cm, stddev_pop(score) AS test_std FROM cv_scores WHERE side = 'test' AND metric = 'f1_score' GROUP BY model) c ON m.model = c.cm),
s AS (SELECT model, acc, f1 * 0.4e0 + CASE WHEN acc >= 0.8 THEN 0.2e0 ELSE -0.3e0 END + CASE WHEN sd < 0.05 THEN 0.15e0 WHEN sd > 0.1 THEN -0.1e0 ELSE 0e0 END
  + CASE WHEN {_any_sql(C.INTERPRETABLE_MODELS)} THEN 0.1e0 ELSE 0e0 END + CASE WHEN {_any_sql(C.FAST_MODELS)} THEN 0.1e0 ELSE 0e0 END AS score,
  concat_ws('; ', 'f1_score: ' || {_three_sql('f1')},
   CASE WHEN acc >= 0.8 THEN 'Meets accuracy requirement (\u22650.8)' ELSE 'Below accuracy requirement (' || {_three_sql('acc')} || ' < 0.8)' END,
   CASE WHEN sd < 0.05 THEN 'High stability (CV std: ' || {_three_sql('sd')} || ')' WHEN sd > 0.1 THEN 'Lower stability (CV std: ' || {_three_sql('sd')} || ')' END,
   CASE WHEN {_any_sql(C.INTERPRETABLE_MODELS)} THEN 'Interpretable model type' END, CASE WHEN {_any_sql(C.FAST_MODELS)} THEN 'Fast model type' END) AS reasons FROM m),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, model) AS INTEGER) AS rank FROM s)
SELECT model, round(score, 6) AS score, rank, rank = 1 AS recommended, reasons,
  concat_ws('; ', CASE WHEN rank = 1 AND score < 0.7 THEN 'Low overall recommendation score - consider model improvement' END,
   CASE WHEN rank = 1 AND acc < 0.8 THEN 'Recommended model does not meet minimum accuracy requirement' END) AS warnings FROM r""")
def q_recommend_score(spark, d):
    """Recommendation score, reasons and warnings, interpretability and speed counted (EVA20)."""
    m = EV.metrics_from_counts(EV.confusion_counts(_pred(spark, d), ["model"])).withColumn("model", kind())
    std = _cv_test(spark, d).where(F.col("metric") == "f1_score").groupBy(kind().alias("model")).agg(F.stddev_pop("score").alias("test_std"))
    return _r6(RC.recommend(m, std, interpretability=True, speed=True))


def _trait_sql(rules):
    return "CASE " + " ".join(f"WHEN {_any_sql(w)} THEN {v}e0" for w, v in rules) + f" ELSE {C.DEFAULT_TRAIT}e0 END"


@register("model_traits", f"""WITH s AS (SELECT model, metric, stddev_pop(score) AS sd FROM cv_scores WHERE side = 'test' GROUP BY model, metric),
k AS (SELECT {KIND_SQL} AS model, avg(sd) AS sd FROM s GROUP BY ALL)
SELECT model, """ + ", ".join(f"{_trait_sql(rules)} AS {t}" for t, rules in C.MODEL_TRAITS.items()) + ", round(greatest(0e0, 1 - sd * 10), 6) AS stability FROM k")
def q_model_traits(spark, d):
    """Traits of each kind of model by name and its stability over folds (EVA24)."""
    cv = _cv_test(spark, d).withColumn("model", kind())
    return _r6(RC.model_traits(cv, cv))


W5 = {m: 1 / len(C.RANKING_METRICS) for m in C.RANKING_METRICS}


@register("model_rank", f"""WITH m AS ({all_metrics_sql(None)}),
s AS (SELECT *, {' + '.join(f'coalesce({k}, 0e0) * {v}e0' for k, v in W5.items())} AS w FROM m)
SELECT model, round(w, 4) AS weighted_score, {', '.join(f'round({k}, 4) AS {k}' for k in W5)}, CAST(row_number() OVER (ORDER BY w DESC, model) AS INTEGER) AS rank FROM s""")
def q_model_rank(spark, d):
    """Score over five equally weighted metrics, AUC among them, and rank (WIN10)."""
    r = EV.rank_models(_all_metrics(spark, d, None), W5)
    return r.withColumns({c: F.round(c, 4) for c in ("weighted_score", *W5)})


@register("readiness", f"""WITH m AS ({metrics_sql(["model"])})
SELECT model, CAST(accuracy >= 0.7 AS INTEGER) + CAST(precision >= 0.6 AS INTEGER) + CAST(recall >= 0.6 AS INTEGER) + CAST(f1_score >= 0.6 AS INTEGER) AS passed,
  round((CAST(accuracy >= 0.7 AS INTEGER) + CAST(precision >= 0.6 AS INTEGER) + CAST(recall >= 0.6 AS INTEGER) + CAST(f1_score >= 0.6 AS INTEGER)) / 4e0, 6) AS readiness_score,
  (CAST(accuracy >= 0.7 AS INTEGER) + CAST(precision >= 0.6 AS INTEGER) + CAST(recall >= 0.6 AS INTEGER) + CAST(f1_score >= 0.6 AS INTEGER)) / 4e0 >= 0.8
   AND 4 - (CAST(accuracy >= 0.7 AS INTEGER) + CAST(precision >= 0.6 AS INTEGER) + CAST(recall >= 0.6 AS INTEGER) + CAST(f1_score >= 0.6 AS INTEGER)) <= 1 AS ready,
  concat_ws(',', CASE WHEN accuracy < 0.7 THEN 'accuracy' END, CASE WHEN precision < 0.6 THEN 'precision' END, CASE WHEN recall < 0.6 THEN 'recall' END,
   CASE WHEN f1_score < 0.6 THEN 'f1_score' END) AS failed_checks FROM m""")
def q_readiness(spark, d):
    """Four minimum checks, share passed, ready if >= .8 and at most one failed (EVA25)."""
    m = _metrics(spark, d, ["model"])
    checks = [("accuracy", 0.7), ("precision", 0.6), ("recall", 0.6), ("f1_score", 0.6)]
    passed = sum(((F.col(c) >= t).cast("int") for c, t in checks), F.lit(0))
    return m.select("model", passed.alias("passed"), F.round(passed / 4.0, 6).alias("readiness_score"),
                    ((passed / 4.0 >= 0.8) & (F.lit(4) - passed <= 1)).alias("ready"),
                    F.array_join(F.array_compact(F.array(*[F.when(F.col(c) < t, F.lit(c)) for c, t in checks])), ",").alias("failed_checks"))


_W = {"precision": ("tp", "tp + fp", "tn", "tn + fn"), "recall": ("tp", "tp + fn", "tn", "tn + fp"), "f1_score": ("2 * tp", "2 * tp + fp + fn", "2 * tn", "2 * tn + fn + fp")}


def _weighted_sql(keys):
    cols = ", ".join(f"({_div(a, b)} * (tp + fn) + {_div(c, e)} * (tn + fp)) / n AS {m}" for m, (a, b, c, e) in _W.items())
    return f"SELECT {', '.join(keys)}, {_div('tp + tn', 'n')} AS accuracy, {cols} FROM ({counts_sql(keys)})"


def _long_sql(name, value):
    return " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS {value} FROM {name}" for m in EV.WEIGHTED)


@register("drift_check", f"""WITH c AS ({_weighted_sql(["model"])}), v AS ({_weighted_sql(["model", "fold"])}),
st AS (SELECT * FROM v QUALIFY fold = max(fold) OVER (PARTITION BY model)),
j AS (SELECT a.model, a.metric, a.now, b.stored, a.now - b.stored AS change FROM ({_long_sql('c', 'now')}) a JOIN ({_long_sql('st', 'stored')}) b ON a.model = b.model AND a.metric = b.metric)
SELECT model, metric, round(now, 6) AS current, round(stored, 6) AS stored, round(change, 6) AS change, change < -0.05 AS degraded,
  bool_or(change < -0.05) OVER (PARTITION BY model) AS model_degraded FROM j""")
def q_drift_check(spark, d):
    """Weighted metrics of each model now against those stored with its newest version, the last fold's (EVA27)."""
    p = _pred(spark, d)
    last = F.col("fold") == F.max("fold").over(Window.partitionBy("model"))  # a row per model and fold
    stored = EV.weighted_metrics(p, ["model", "fold"]).withColumn("_last", last).where("_last").drop("_last", "fold")
    return _r6(EV.drift(EV.weighted_metrics(p, ["model"]), stored))


# ------------------------------------------------------------- bootstrap --
REPLICATES, SEED = 1000, 42
BOOTSTRAP_SQL = f"""w AS (SELECT model, proba, y_true, rep, {BS.weight_sql('row_id', 'rep', SEED)} AS w FROM predictions, (SELECT unnest(range(1, {REPLICATES + 1})) AS rep)),
ws AS (SELECT model, rep, proba, sum(CASE WHEN y_true = 1 THEN w ELSE 0 END)::DOUBLE AS pos, sum(CASE WHEN y_true = 0 THEN w ELSE 0 END)::DOUBLE AS neg FROM w GROUP BY ALL),
wc AS (SELECT *, sum(neg) OVER (PARTITION BY model, rep ORDER BY proba ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM ws),
wa AS (SELECT model, rep, sum(pos * (2 * (cum - neg) + neg)) / nullif(2 * sum(pos) * sum(neg), 0) AS auc FROM wc GROUP BY ALL),
b AS (SELECT model, avg(auc) AS auc_mean, stddev_samp(auc) AS auc_std, quantile_cont(auc, 0.025) AS ci_lower, quantile_cont(auc, 0.975) AS ci_upper, count(auc) AS replicates
  FROM wa GROUP BY model)"""
_B6 = ", ".join(f"round({c}, 6) AS {c}" for c in ("auc_mean", "auc_std", "ci_lower", "ci_upper"))


@register("auc_bootstrap", f"WITH {BOOTSTRAP_SQL} SELECT model, {_B6}, replicates FROM b")
def q_auc_bootstrap(spark, d):
    """Poisson bootstrap of the AUC with 1000 replicates (EVA10)."""
    return _r6(BS.auc_interval(BS.auc_by_replicate(_pred(spark, d), "model", REPLICATES, SEED)))


@register("roc_summary", ROC_POINTS_SQL + f""", {BOOTSTRAP_SQL}
SELECT p.model, round(a.roc_auc, 6) AS auc, round(youden_j, 6) AS youden_j, youden_threshold, threshold_tpr_goal, threshold_spec_goal, {_B6}, replicates
FROM pts p JOIN {AUC_SQL} a ON p.model = a.model JOIN b ON p.model = b.model""")
def q_roc_summary(spark, d):
    """AUC, bootstrap interval and thresholds by model (EVA11)."""
    p = _pred(spark, d)
    pts = EV.roc_points(EV.roc_curve(p, ["model"]), ["model"])
    boot = BS.auc_interval(BS.auc_by_replicate(p, "model", REPLICATES, SEED))
    return _r6(EV.roc_auc(p, ["model"]).join(pts, "model").join(boot, "model"))
