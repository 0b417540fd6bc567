"""Evaluation over the long ``predictions(model, row_id, fold, y_true, y_pred,
proba)`` frame (EVA*).

Metrics are conditional counts in one aggregate per key. Curves first collapse
rows to one row per (key, distinct score) -- a map-side combined aggregate --
and then take cumulative sums with ``prefix_sums`` (range partitioned), so a
model with billions of distinct scores still spreads over all tasks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.prefix import prefix_sums
from vitrine.functions.stats import t_tail

T_TAIL = t_tail()


#: Absolute plus relative tolerance of a sum of probabilities against 1.
SUM_TOLERANCE = 1e-3 + 1e-5


def _div(a: Column, b: Column) -> Column:
    """a / b with zero division = 0."""
    return F.coalesce(a.cast("double") / F.nullif(b, F.lit(0)).cast("double"), F.lit(0.0))


def confusion_counts(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    yt, yp = F.col("y_true"), F.col("y_pred")
    return pred.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if((yt == 1) & (yp == 1)).alias("tp"),
        F.count_if((yt == 0) & (yp == 1)).alias("fp"), F.count_if((yt == 1) & (yp == 0)).alias("fn"),
        F.count_if((yt == 0) & (yp == 0)).alias("tn"))


def metrics_from_counts(c: DataFrame) -> DataFrame:
    """accuracy ... mcc from tp/fp/fn/tn columns (EVA1)."""
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    prec, rec, spec = _div(tp, tp + fp), _div(tp, tp + fn), _div(tn, tn + fp)
    mcc_den = F.sqrt((tp + fp).cast("double") * (tp + fn) * (tn + fp) * (tn + fn))
    return c.withColumns({
        "accuracy": _div(tp + tn, n), "balanced_accuracy": (rec + spec) / 2, "precision": prec, "recall": rec,
        "f1_score": _div(2 * tp, 2 * tp + fp + fn), "specificity": spec, "sensitivity": rec, "ppv": prec,
        "npv": _div(tn, tn + fn),
        "mcc": F.coalesce((tp.cast("double") * tn - fp.cast("double") * fn) / F.nullif(mcc_den, F.lit(0.0)), F.lit(0.0))})


def score_table(pred: DataFrame, keys: Sequence[str], score: str = "proba") -> DataFrame:
    """One row per (keys, distinct score): positives and negatives."""
    return pred.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count_if(F.col("y_true") == 1).alias("pos"), F.count_if(F.col("y_true") == 0).alias("neg"))


def roc_curve(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, threshold, fpr, tpr, tp, fp) at every distinct score, highest
    first, plus the (inf, 0, 0) start point; all points kept (EVA5)."""
    st = score_table(pred, keys)
    cum = prefix_sums(st, keys, "score", ["pos", "neg"], descending=True)
    totals = st.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = cum.join(totals, list(keys))  # one row per key on the right
    pts = j.select(*keys, F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                   "P", "N")
    start = totals.select(*keys, F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("tp"),
                          F.lit(0).cast("long").alias("fp"), "P", "N")
    allp = pts.unionByName(start)
    return allp.withColumns({"tpr": _div(F.col("tp"), F.col("P")), "fpr": _div(F.col("fp"), F.col("N"))})


def roc_auc(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Trapezoid AUC with ties = rank AUC: sum_s pos_s (neg_below_s + neg_s / 2) / (P N)."""
    st = score_table(pred, keys)
    cum = prefix_sums(st, keys, "score", ["neg"], descending=False)
    part = cum.groupBy(*keys).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)).alias("s"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return part.select(*keys, _div(F.col("s"), F.col("P") * F.col("N")).alias("auc"))


def metrics(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All metrics with ``roc_auc`` (EVA1, EVA2); roc_auc is null where one class is missing or no score is known."""
    m = metrics_from_counts(confusion_counts(pred, keys))
    auc = roc_auc(pred.where(F.col("proba").isNotNull()), keys).withColumnRenamed("auc", "roc_auc")
    both = (F.col("tp") + F.col("fn") > 0) & (F.col("tn") + F.col("fp") > 0)
    return m.join(auc, list(keys), "left").withColumn("roc_auc", F.when(both, F.col("roc_auc")))


def weighted_metrics(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """accuracy, and precision, recall and f1_score averaged over the classes by support; one aggregate."""
    c = confusion_counts(pred, keys)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    pos, neg = tp + fn, tn + fp

    def both(one: Column, zero: Column) -> Column:
        return _div(one * pos + zero * neg, n)
    return c.select(*keys, _div(tp + tn, n).alias("accuracy"), both(_div(tp, tp + fp), _div(tn, tn + fn)).alias("precision"),
                    both(_div(tp, pos), _div(tn, neg)).alias("recall"),
                    both(_div(2 * tp, 2 * tp + fp + fn), _div(2 * tn, 2 * tn + fn + fp)).alias("f1_score"))


WEIGHTED = ("accuracy", "precision", "recall", "f1_score")


def drift(current: DataFrame, stored: DataFrame, key: str = "model", fall: float = 0.05) -> DataFrame:
    """Metrics now against stored ones, a row per metric; degraded where a metric fell by more than ``fall``, and
    model_degraded where any of the model's did (EVA27)."""

    def long(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.stack(F.lit(len(WEIGHTED)), *[x for m in WEIGHTED for x in (F.lit(m), F.col(m))]).alias("metric", name))
    j = long(current, "current").join(long(stored, "stored"), [key, "metric"])
    j = j.withColumn("change", F.col("current") - F.col("stored")).withColumn("degraded", F.col("change") < -fall)
    return j.withColumn("model_degraded", F.max("degraded").over(Window.partitionBy(key)))  # a row per metric in each window


def rank_models(m: DataFrame, weights: dict) -> DataFrame:
    """Weighted score over metrics, a null metric counting 0, and the rank (WIN10). The weights sum to 1."""
    if abs(sum(weights.values()) - 1) > 1e-6:
        raise ValueError("weights must sum to 1")
    score = sum((F.coalesce(F.col(k), F.lit(0.0)) * w for k, w in weights.items()), F.lit(0.0))
    scored = m.select("model", score.alias("weighted_score"), *weights)
    # a row per model
    return scored.withColumn("rank", F.row_number().over(Window.orderBy(F.col("weighted_score").desc(), "model")))


def pr_curve(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Precision and recall when predicting positive at score >= threshold (EVA4)."""
    r = roc_curve(pred, keys).where(~F.isnan("threshold") & (F.col("threshold") != float("inf")))
    return r.select(*keys, "threshold", _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    F.col("tpr").alias("recall"))


def roc_points(roc: DataFrame, keys: Sequence[str], tpr_goal: float = 0.95, spec_goal: float = 0.95) -> DataFrame:
    """Youden J and its threshold; first threshold reaching tpr >= goal; last
    threshold keeping specificity >= goal (EVA7)."""
    j = F.col("tpr") - F.col("fpr")
    return roc.groupBy(*keys).agg(
        F.max(j).alias("youden_j"),
        F.max_by("threshold", F.struct(j, F.col("threshold"))).alias("youden_threshold"),
        F.max(F.when(F.col("tpr") >= tpr_goal, F.col("threshold"))).alias("threshold_tpr_goal"),
        F.min(F.when(1 - F.col("fpr") >= spec_goal, F.col("threshold"))).alias("threshold_spec_goal"))


def best_threshold(roc: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Youden, closest to (0, 1), and best f1 from the same cumulative frame (EVA9)."""
    r = roc.where(F.col("threshold") != float("inf"))
    j = F.col("tpr") - F.col("fpr")
    dist = F.sqrt(F.pow("fpr", 2) + F.pow(1 - F.col("tpr"), 2))
    f1 = _div(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("P"))
    return r.groupBy(*keys).agg(
        F.max_by("threshold", F.struct(j, F.col("threshold"))).alias("youden_threshold"),
        F.min_by("threshold", F.struct(dist, -F.col("threshold"))).alias("closest_threshold"),
        F.max_by("threshold", F.struct(f1, F.col("threshold"))).alias("f1_threshold"),
        F.max(f1).alias("best_f1"))


def class_report(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Precision, recall, f1, support per class, macro and weighted averages (EVA3)."""
    m = metrics_from_counts(confusion_counts(pred, keys))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    c1 = m.select(*keys, F.lit("1").alias("class"), _div(tp, tp + fp).alias("precision"), _div(tp, tp + fn).alias("recall"),
                  _div(2 * tp, 2 * tp + fp + fn).alias("f1_score"), (tp + fn).alias("support"))
    c0 = m.select(*keys, F.lit("0").alias("class"), _div(tn, tn + fn).alias("precision"), _div(tn, tn + fp).alias("recall"),
                  _div(2 * tn, 2 * tn + fn + fp).alias("f1_score"), (tn + fp).alias("support"))
    per = c0.unionByName(c1)
    avg = per.groupBy(*keys).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("wf"), F.sum("support").alias("s"))
    macro = avg.select(*keys, F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                       F.col("mf").alias("f1_score"), F.col("s").alias("support"))
    weighted = avg.select(*keys, F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                          F.col("wr").alias("recall"), F.col("wf").alias("f1_score"), F.col("s").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def prediction_check(pred: DataFrame, keys: Sequence[str], probs: str | None = None) -> DataFrame:
    """Predicted classes within true classes, probabilities in [0, 1] and, where ``probs`` names a column with an array of
    class probabilities, sums of 1 within a tolerance (EVA6). A null probability fails. A single ``proba`` has no sum to test."""
    ok = F.lit(True)
    if probs:
        inside = F.forall(probs, lambda x: (x >= 0) & (x <= 1))
        ok = F.abs(F.aggregate(probs, F.lit(0.0), lambda a, x: a + x) - 1) <= SUM_TOLERANCE
    else:
        inside = (F.col("proba") >= 0) & (F.col("proba") <= 1)

    def bad(c: Column) -> Column:
        return F.count_if(~F.coalesce(c, F.lit(False)))
    g = pred.groupBy(*keys).agg(F.collect_set("y_true").alias("t"), F.collect_set("y_pred").alias("p"),
                                bad(inside).alias("bad_proba"), bad(ok).alias("bad_sum"))
    unknown = F.array_except("p", "t")
    return g.select(*keys, (F.size(unknown) == 0).alias("classes_ok"),
                    (F.col("bad_proba") == 0).alias("proba_range_ok"), (F.col("bad_sum") == 0).alias("proba_sum_ok"),
                    F.array_join(F.array_sort(unknown).cast("array<string>"), ",").alias("unknown_classes"))


def confusion(pred: DataFrame, keys: Sequence[str], normalize: bool = False) -> DataFrame:
    """Confusion counts (or row-normalised shares) with one column per predicted class (EVA22, EVA23)."""
    g = pred.groupBy(*keys, "y_true").pivot("y_pred", [0, 1]).agg(F.count(F.lit(1)))
    g = g.select(*keys, "y_true", F.coalesce(F.col("0"), F.lit(0)).alias("pred_0"), F.coalesce(F.col("1"), F.lit(0)).alias("pred_1"))
    if normalize:
        tot = F.col("pred_0") + F.col("pred_1")
        g = g.select(*keys, "y_true", _div(F.col("pred_0"), tot).alias("pred_0"), _div(F.col("pred_1"), tot).alias("pred_1"))
    return g


def fold_stats(cv: DataFrame, t_table: DataFrame, keys: Sequence[str] = ("model", "metric")) -> DataFrame:
    """Mean, std (n), quartiles, IQR, coefficient of variation, 95 % t
    interval of fold scores (EVA13). ``t_table`` (df, t) is a fixed small frame; beyond it Student's quantile is expanded around the
    normal one (within 1e-10 from 200 degrees on)."""
    s = F.col("score")
    g = cv.groupBy(*keys).agg(F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.stddev_samp(s).alias("std_sample"),
                              F.min(s).alias("min"), F.max(s).alias("max"), F.percentile(s, 0.25).alias("q25"),
                              F.percentile(s, 0.5).alias("median"), F.percentile(s, 0.75).alias("q75"),
                              F.count(F.lit(1)).alias("n"))
    g = g.join(F.broadcast(t_table), g["n"] - 1 == t_table["df"], "left")
    df = (F.col("n") - 1).cast("double")
    half = F.coalesce(F.col("t"), F.when(df > 0, sum((F.lit(c) / F.pow(df, F.lit(float(i))) for i, c in enumerate(T_TAIL)), F.lit(0.0)))) * F.col("std_sample") / F.sqrt("n")
    return g.select(*keys, "mean", "std", "min", "max", "q25", "median", "q75", (F.col("q75") - F.col("q25")).alias("iqr"),
                    _div(F.col("std"), F.col("mean")).alias("cv"), (F.col("mean") - half).alias("ci_lower"),
                    (F.col("mean") + half).alias("ci_upper"), "n")


def pivot_models(cv: DataFrame, row_keys: Sequence[str], models: Sequence[str]) -> DataFrame:
    return cv.groupBy(*row_keys).pivot("model", list(models)).agg(F.first("score"))


PAIR_SCHEMA = ("model_a string, model_b string, metric string, n long, mean_diff double, t_stat double, cohens_d double, "
               "wilcoxon_w double, n_nonzero long, u_stat double, n1 long, n2 long")


def paired_stats(cv: DataFrame, models: Sequence[str], keys: Sequence[str] = ("metric",)) -> DataFrame:
    """For each model pair: paired t statistic, Wilcoxon W (min of signed-rank
    sums, zero differences dropped, average ranks for ties), Mann-Whitney U
    and Cohen's d of fold differences (EVA15, JOIN12). Fold scores are pivoted
    to one row per fold and the model-pair columns exploded once, so every
    pair is computed in one plan keyed by (pair, metric); rows are folds x pairs."""
    if len(models) < 2:
        return cv.sparkSession.createDataFrame([], PAIR_SCHEMA)
    wide = pivot_models(cv, [*keys, "fold"], models)
    pairs = [(a, b) for i, a in enumerate(models) for b in models[i + 1:]]
    arr = F.array(*[F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), F.col(f"`{a}`").alias("xa"),
                             F.col(f"`{b}`").alias("xb")) for a, b in pairs])
    x = wide.select(*keys, "fold", F.explode(arr).alias("p")).select(*keys, "fold", "p.*")
    x = x.where(F.col("xa").isNotNull() & F.col("xb").isNotNull()).withColumn("d", F.col("xa") - F.col("xb"))
    k = ["model_a", "model_b", *keys]
    w = Window.partitionBy(*k)
    nz = x.where(F.col("d") != 0).withColumn("ad", F.abs("d"))
    rk = nz.withColumn("r", F.rank().over(w.orderBy("ad")) + (F.count(F.lit(1)).over(Window.partitionBy(*k, "ad")) - 1) / 2.0)
    wil = rk.groupBy(*k).agg(F.sum(F.when(F.col("d") > 0, F.col("r")).otherwise(0.0)).alias("w_plus"),
                             F.sum(F.when(F.col("d") < 0, F.col("r")).otherwise(0.0)).alias("w_minus"),
                             F.count(F.lit(1)).alias("n_nonzero"))
    pooled = x.select(*k, F.col("xa").alias("v"), F.lit(1).alias("g")).unionByName(
        x.select(*k, F.col("xb").alias("v"), F.lit(2).alias("g")))
    pr = pooled.withColumn("r", F.rank().over(w.orderBy("v")) + (F.count(F.lit(1)).over(Window.partitionBy(*k, "v")) - 1) / 2.0)
    mw = pr.groupBy(*k).agg(F.sum(F.when(F.col("g") == 1, F.col("r"))).alias("r1"), F.count_if(F.col("g") == 1).alias("n1"),
                            F.count_if(F.col("g") == 2).alias("n2"))
    u1 = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2.0
    mw = mw.select(*k, F.least(u1, F.col("n1") * F.col("n2") - u1).alias("u_stat"), "n1", "n2")
    t = x.groupBy(*k).agg(F.avg("d").alias("mean_diff"), F.stddev_samp("d").alias("sd_diff"), F.count(F.lit(1)).alias("n"))
    t = t.select(*k, "mean_diff", "n", (F.col("mean_diff") / (F.nullif(F.col("sd_diff"), F.lit(0.0)) / F.sqrt("n"))).alias("t_stat"),
                 (F.col("mean_diff") / F.nullif(F.col("sd_diff"), F.lit(0.0))).alias("cohens_d"))
    return (t.join(wil, k, "left").join(mw, k, "left")
            .select(*k, "n", "mean_diff", "t_stat", "cohens_d", F.least("w_plus", "w_minus").alias("wilcoxon_w"),
                    F.coalesce("n_nonzero", F.lit(0)).alias("n_nonzero"), "u_stat", "n1", "n2"))


def anova_f(cv: DataFrame, keys: Sequence[str] = ("metric",)) -> DataFrame:
    """One-way ANOVA F of fold scores across models (EVA19): between and
    within sums of squares from per-model moments."""
    per = cv.groupBy(*keys, "model").agg(F.avg("score").alias("m"), F.count(F.lit(1)).alias("n"),
                                         F.sum(F.pow("score", 2)).alias("ss"))
    g = per.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"), (F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias("gm"),
        F.sum(F.col("ss") - F.col("n") * F.pow("m", 2)).alias("ssw"),
        F.sum(F.col("n") * F.pow("m", 2)).alias("snm2"))
    ssb = F.col("snm2") - F.col("N") * F.pow("gm", 2)
    return g.select(*keys, "k", "N", ssb.alias("ss_between"), F.col("ssw").alias("ss_within"),
                    ((ssb / (F.col("k") - 1)) / (F.col("ssw") / (F.col("N") - F.col("k")))).alias("f_stat"))
