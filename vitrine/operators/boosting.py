"""Boosted trees stopped early by the AUC on validation rows (TRN14).

A fit with n trees begins with the trees of any shorter fit of the same seed, so one fit gives the model after each of its
trees: the margins after 1, 2, ... trees are running sums of the trees' weighted predictions, made in one pass over the rows,
and the AUC of all rounds comes from one set of distributed prefix sums. Fits are lengthened by doubling until the rule stops,
so at most about twice the trees needed are grown.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.evaluate import roc_auc


def _nodes(node) -> tuple:
    """A fitted tree as nested tuples: (value,) of a leaf, else (feature, threshold or None, categories on the left, whether an
    unknown category goes left, left, right)."""
    if node.getClass().getSimpleName() == "LeafNode":
        return (float(node.prediction()),)
    split, left, right = node.split(), _nodes(node.leftChild()), _nodes(node.rightChild())
    if split.getClass().getSimpleName() == "ContinuousSplit":
        return int(split.featureIndex()), float(split.threshold()), (), False, left, right
    some, rest = list(split.leftCategories()), list(split.rightCategories())
    if len(some) <= (len(some) + len(rest)) / 2:
        return int(split.featureIndex()), None, some, False, left, right
    return int(split.featureIndex()), None, rest, True, left, right


def _predict(node: tuple, x: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
    """Predictions of the rows ``at`` of ``x`` by one tree."""
    if len(node) == 1:
        out[at] = node[0]
        return
    feature, threshold, cats, other, left, right = node
    v = x[at, feature]
    go = v <= threshold if threshold is not None else np.isin(v, cats) != other
    _predict(left, x, at[go], out)
    _predict(right, x, at[~go], out)


def staged_margins(model, df: DataFrame, after: int = 0) -> DataFrame:
    """``df`` with ``margins``: the margin after each of the model's trees beyond the first ``after``. All trees are walked in
    one pass over blocks of rows; a plan with a column per tree would grow with the trees."""
    trees = [(_nodes(t._java_obj.rootNode()), float(w)) for t, w in zip(model.trees, model.treeWeights, strict=True)]
    shared = df.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("array<double>")
    def running(features: pd.Series) -> pd.Series:
        if not len(features):
            return pd.Series([], dtype=object)
        x = np.stack(features)
        rows, total, one, out = np.arange(len(x)), np.zeros(len(x)), np.empty(len(x)), np.empty((len(x), len(shared.value) - after))
        for i, (tree, w) in enumerate(shared.value):
            _predict(tree, x, rows, one)
            total = total + one * w
            if i >= after:
                out[:, i - after] = total
        return pd.Series(list(out))

    return df.withColumn("margins", running(vector_to_array("features")))


def staged_auc(model, sides: dict[str, DataFrame], after: int = 0) -> dict[str, list[float]]:
    """AUC after each tree beyond the first ``after`` for each named set of (label, features) rows."""
    out = {}
    for name, df in sides.items():
        m = staged_margins(model, df.select("label", "features"), after).select("label", F.posexplode("margins").alias("round", "proba"))
        auc = roc_auc(m.withColumn("y_true", F.col("label").cast("int")), ["round"]).collect()
        out[name] = [r["auc"] for r in sorted(auc, key=lambda r: r["round"])]
    return out


def stop_at(scores: list[float], patience: int = 10, tol: float = 1e-4) -> tuple[int, int | None]:
    """(best round, round at which to stop or None): a round is better when it gains more than ``tol``; the search ends after
    ``patience`` rounds without a better one."""
    best, at = -np.inf, 0
    for i, s in enumerate(scores, 1):
        if s > best + tol:
            best, at = s, i
        elif i - at >= patience:
            return at, i
    return at, None


def early_stopped(train: DataFrame, validation: DataFrame, n_trees: int = 1000, step: float = 0.1, depth: int = 3,
                  subsample: float = 0.8, patience: int = 10, tol: float = 1e-4, seed: int = 42, first: int = 16):
    """(model refitted on all rows with the best number of trees, [(round, train AUC, validation AUC)] up to the stop, best
    round). Rows: label, features."""

    def fit(rows: DataFrame, n: int):
        return GBTClassifier(maxIter=n, stepSize=step, maxDepth=depth, subsamplingRate=subsample, seed=seed).fit(rows)

    train, validation = (x.select("label", "features") for x in (train, validation))
    n = min(first, n_trees)
    auc = {"train": [], "validation": []}
    while True:
        # a longer fit begins with the same trees, whose rounds are known
        for side, more in staged_auc(fit(train, n), {"train": train, "validation": validation}, len(auc["train"])).items():
            auc[side] += more
        best, stop = stop_at(auc["validation"], patience, tol)
        if stop or n == n_trees:
            break
        n = min(2 * n, n_trees)
    rounds = stop or n
    history = [(i + 1, float(auc["train"][i]), float(auc["validation"][i])) for i in range(rounds)]
    return fit(train.unionByName(validation), best), history, best
