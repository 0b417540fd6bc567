"""Random forests for model search (TRN3, HPO9): MLlib's, with the two settings of the reference that MLlib's lack, and with
one growth for all configurations that differ in what only cuts a forest short.

A tree is grown from its root, and whether a node is split hangs on that node alone. So a tree that stops at a smaller depth, or
at nodes of few samples (``minSamplesSplit``), is the fully grown tree cut off there, and a smaller forest is the first
trees of a larger one. Leaves of one prediction under a node are merged, as MLlib does. Samples are counted as MLlib does:
a row drawn twice for a tree counts twice.
"""

from __future__ import annotations

import threading
import uuid
from typing import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(lists).to_numpy()


#: Parameters by which a forest is only cut short.
CUTS = ("numTrees", "maxDepth", "minSamplesSplit")


class Grown:
    """The nodes of all trees as arrays, each tree's in preorder."""

    def __init__(self, nodes: pa.Table):
        nodes = nodes.sort_by([("tree", "ascending"), ("id", "ascending")]).combine_chunks()
        col = lambda c: nodes[c].to_numpy()
        self.start = np.flatnonzero(col("id") == 0)
        base = np.repeat(self.start, np.diff(np.append(self.start, len(nodes))))
        inner = col("left") >= 0
        self.left, self.right = (np.where(inner, col(c) + base, -1).astype(np.int32) for c in ("left", "right"))
        self.count, self.feature = col("count"), np.where(inner, col("feature"), 0).astype(np.int32)
        stats = _flat(nodes["stats"]).reshape(len(nodes), -1)
        self.share = stats / np.maximum(stats.sum(axis=1, keepdims=True), 1e-300)
        self.said = col("prediction")
        cats = inner & (col("categories") >= 0)
        size = np.where(inner, pc.list_value_length(nodes["values"]).to_numpy(), 0)
        values = _flat(nodes["values"].filter(pa.array(inner)))
        first = np.cumsum(size) - size
        self.threshold = np.zeros(len(nodes))
        self.threshold[inner & ~cats] = values[first[inner & ~cats]]
        self.row = np.where(cats, np.cumsum(cats) - 1, -1).astype(np.int32)  # of a categorical split in ``among``
        self.among = np.zeros((int(cats.sum()), int(max(col("categories").max(), 1))), dtype=bool)
        for r, i in enumerate(np.flatnonzero(cats)):
            self.among[r, values[first[i]:first[i] + size[i]].astype(int)] = True
        self.depth = np.zeros(len(nodes), dtype=np.int32)
        self.levels, at = [], self.start
        while at.size:
            self.levels.append(at)
            at = at[self.left[at] >= 0]
            at = np.concatenate((self.left[at], self.right[at]))
            self.depth[at] = len(self.levels)

    def ends(self, depth: int, split: int) -> np.ndarray:
        """Whether a row stops at a node, of trees of ``depth`` whose nodes of under ``split`` samples are not split."""
        end = (self.left < 0) | (self.depth >= depth) | (self.count < split)
        for at in reversed(self.levels):
            at = at[~end[at]]
            a, b = self.left[at], self.right[at]
            end[at] = end[a] & end[b] & (self.said[a] == self.said[b])
        return end

    def votes(self, x: np.ndarray, end: np.ndarray, n_trees: int) -> np.ndarray:
        """Rows of ``x`` x classes: the sum of the trees' class shares."""
        total = np.zeros((len(x), self.share.shape[1]))
        for root in self.start[:n_trees]:
            node, live = np.full(len(x), root), np.arange(len(x))
            while True:
                live = live[~end[node[live]]]
                if not live.size:
                    break
                here = node[live]
                v = x[live, self.feature[here]]
                go, row = v <= self.threshold[here], self.row[here]
                if (c := row >= 0).any():
                    go[c] = self.among[row[c], v[c].astype(int)]
                node[live] = np.where(go, self.left[here], self.right[here])
            total += self.share[node]
        return total


def grown(model: RandomForestClassificationModel, df: DataFrame) -> Grown:
    """The nodes of a fitted forest: written and read in one go, as asking the JVM for each takes long."""
    from vitrine.session import checkpoint_dir, dropped
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/forests/{uuid.uuid4().hex}"
    model.write().save(path)
    n = "nodeData."
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n + "id", n + "prediction", F.col(n + "impurityStats").alias("stats"), F.col(n + "rawCount").alias("count"),
        F.col(n + "leftChild").alias("left"), F.col(n + "rightChild").alias("right"), F.col(n + "split.featureIndex").alias("feature"),
        F.col(n + "split.leftCategoriesOrThreshold").alias("values"), F.col(n + "split.numCategories").alias("categories"))
    out = Grown(nodes.toArrow())
    dropped(spark, path)
    return out


class ForestModel(Model):
    """A forest cut to so many trees, depth and least samples of a split; adds ``rawPrediction`` (array) and ``prediction``."""

    def __init__(self, nodes: Grown, n_trees: int, depth: int, split: int):
        super().__init__()
        self.nodes, self.n_trees, self.end = nodes, n_trees, nodes.ends(depth, split)

    def _transform(self, df: DataFrame) -> DataFrame:
        shared, n_trees = df.sparkSession.sparkContext.broadcast((self.nodes, self.end)), self.n_trees

        @F.pandas_udf("array<double>")
        def votes(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype=object)
            nodes, end = shared.value
            return pd.Series(list(nodes.votes(np.stack(features), end, n_trees)))

        raw = F.col("rawPrediction")
        return df.withColumn("rawPrediction", votes(vector_to_array("features"))) \
            .withColumn("prediction", (F.array_position(raw, F.array_max(raw)) - 1).cast("double"))


class Forest(Estimator):
    """``RandomForestClassifier`` with ``minSamplesSplit`` and ``classWeight`` (none; balanced: n / (classes * rows of the class),
    by the rows given to the fit; balanced_subsample: the same, as MLlib weighs a row alike in all trees, where the reference
    counts each tree's own draws). Its other parameters are those of ``trees``."""

    minSamplesSplit = Param(Params._dummy(), "minSamplesSplit", "a node of fewer samples is not split", TypeConverters.toInt)
    classWeight = Param(Params._dummy(), "classWeight", "none, balanced or balanced_subsample", TypeConverters.toString)

    def __init__(self, trees: RandomForestClassifier):
        super().__init__()
        self.trees = trees
        self._setDefault(minSamplesSplit=2, classWeight="none")

    def getParam(self, name: str) -> Param:
        return super().getParam(name) if name in ("minSamplesSplit", "classWeight") else self.trees.getParam(name)

    def copy(self, extra=None):
        that = super().copy(extra)
        that.trees = self.trees.copy(extra)
        return that

    def _value(self, name: str):
        return (self if name in ("minSamplesSplit", "classWeight") else self.trees).getOrDefault(name)

    def _group(self) -> tuple:
        """Forests alike in this are one growth, cut short in several ways."""
        settings = {p.name: v for p, v in self.trees.extractParamMap().items() if p.name not in CUTS}
        return (*sorted((k, str(v)) for k, v in settings.items()), self._value("classWeight"))

    def _grow(self, df: DataFrame, n_trees: int, depth: int) -> Grown:
        trees = self.trees.copy({self.trees.numTrees: n_trees, self.trees.maxDepth: depth})
        rows, label = df, trees.getLabelCol()
        if self._value("classWeight") != "none":
            n = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
            weight = F.lit(1.0)
            for v, k in n.items():
                weight = F.when(F.col(label) == v, sum(n.values()) / (len(n) * k)).otherwise(weight)
            rows, trees = df.withColumn("_weight", weight), trees.setWeightCol("_weight")
        return grown(trees.fit(rows), df)

    def _cut(self, nodes: Grown) -> ForestModel:
        return ForestModel(nodes, *(self._value(c) for c in CUTS))

    def _fit(self, df: DataFrame) -> ForestModel:
        return self._cut(self._grow(df, self._value("numTrees"), self._value("maxDepth")))

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]):
        alike: dict[tuple, list] = {}
        ests = [self.copy(m) for m in paramMaps]
        for i, e in enumerate(ests):
            alike.setdefault(e._group(), []).append(i)
        groups = list(alike.values())
        locks, kept, left = [threading.Lock() for _ in groups], {}, [len(g) for g in groups]
        of = {i: g for g, members in enumerate(groups) for i in members}

        def fit(i: int) -> ForestModel:
            g = of[i]
            with locks[g]:
                if g not in kept:
                    some = [ests[j] for j in groups[g]]
                    kept[g] = ests[i]._grow(dataset, *(max(e._value(c) for e in some) for c in ("numTrees", "maxDepth")))
                left[g] -= 1
                return ests[i]._cut(kept[g] if left[g] else kept.pop(g))

        # group by group in turn, so that those who fit at the same time do not wait for one growth
        return _Each(fit, sorted(of, key=lambda i: (groups[of[i]].index(i), of[i])))


class _Each:
    """(index, model) in the given order, for several threads."""

    def __init__(self, fit: Callable[[int], Model], order: list):
        self.fit, self.order, self.lock = fit, iter(order), threading.Lock()

    def __iter__(self):
        return self

    def __next__(self):
        with self.lock:
            i = next(self.order)
        return i, self.fit(i)


class PositiveF1(Evaluator):
    """F1 of class 1, 0 where undefined: the reference's scoring='f1'."""

    def _evaluate(self, df: DataFrame) -> float:
        said, true = F.col("prediction") == 1, F.col("label") == 1
        n = df.agg(F.count_if(said & true).alias("tp"), (F.count_if(said) + F.count_if(true)).alias("both")).first()
        return 2.0 * n["tp"] / n["both"] if n["both"] else 0.0
