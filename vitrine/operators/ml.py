"""Feature pipeline, splits, class balance, training and model search on
MLlib (PIPE*, BAL*, TRN*, HPO*).

Everything trains on a distributed DataFrame; fitted state is an MLlib
``PipelineModel``. Searches are ``CrossValidator`` / ``TrainValidationSplit``
with ``parallelism`` (concurrent Spark jobs), never a driver loop over rows.
"""

from __future__ import annotations

import itertools
import random
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (CountVectorizer, IDF, Imputer, Normalizer, OneHotEncoder, RegexTokenizer,
                                SQLTransformer, StandardScaler, StopWordsRemover, StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import config as C
from vitrine.functions.prefix import prefix_sums

NUMERIC_SQL = ("SELECT *, coalesce(description, '') AS _desc_text, CAST(length(coalesce(title, '')) AS DOUBLE) AS title_char_count, "
               "CAST(size(filter(split(coalesce(title, ''), '\\\\s+'), w -> w <> '')) AS DOUBLE) AS title_word_count, "
               "CAST(length(coalesce(description, '')) AS DOUBLE) AS description_char_count, "
               "CAST(size(filter(split(coalesce(description, ''), '\\\\s+'), w -> w <> '')) AS DOUBLE) AS description_word_count, "
               "CAST(reviews_count AS DOUBLE) AS reviews_num, "
               + ", ".join(f"CAST(({' OR '.join(f'lower(coalesce(description, {chr(39)}{chr(39)})) LIKE {chr(39)}%{w}%{chr(39)}' for w in ws)}) AS DOUBLE) AS kw_{n}"
                           for n, ws in C.KEYWORD_GROUPS)
               + " FROM __THIS__")
NUMERIC_COLS = ["title_char_count", "title_word_count", "description_char_count", "description_word_count", "reviews_num"] + \
    [f"kw_{n}" for n, _ in C.KEYWORD_GROUPS]


def feature_pipeline(vocab_size: int = 200, label: str = "target", rows: int | None = None) -> Pipeline:
    """Text + numeric + categorical features in one MLlib Pipeline (PIPE1).

    ``rows``: number of training rows where it is known; ``maxDF`` is then given as a count, which spares the counter a
    pass over the tokens and keeping them all."""
    max_df = 0.95 * rows if rows and 0.95 * rows >= 1 else 0.95
    return Pipeline(stages=[
        SQLTransformer(statement=NUMERIC_SQL),
        RegexTokenizer(inputCol="_desc_text", outputCol="_tok", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False, toLowercase=True),
        StopWordsRemover(inputCol="_tok", outputCol="_tok_clean", stopWords=StopWordsRemover.loadDefaultStopWords("english")),
        CountVectorizer(inputCol="_tok_clean", outputCol="_tf", vocabSize=vocab_size, minDF=2.0, maxDF=max_df),
        IDF(inputCol="_tf", outputCol="_tfidf_raw"),
        Normalizer(inputCol="_tfidf_raw", outputCol="tfidf", p=2.0),
        StringIndexer(inputCol="platform", outputCol="_platform_idx", stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=["_platform_idx"], outputCols=["platform_onehot"], dropLast=True),
        Imputer(inputCols=NUMERIC_COLS, outputCols=[f"{c}_imp" for c in NUMERIC_COLS], strategy="median"),
        VectorAssembler(inputCols=[f"{c}_imp" for c in NUMERIC_COLS], outputCol="_num"),
        StandardScaler(inputCol="_num", outputCol="numeric_scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["numeric_scaled", "platform_onehot", "tfidf"], outputCol="features"),
        SQLTransformer(statement=f"SELECT *, CAST({label} AS DOUBLE) AS label FROM __THIS__"),
    ])


def feature_names(model: PipelineModel) -> list:
    """Names of the assembled feature slots, in vector order."""
    cv = [s for s in model.stages if s.__class__.__name__ == "CountVectorizerModel"][0]
    idx = [s for s in model.stages if s.__class__.__name__ == "StringIndexerModel"][0]
    return ([f"{c}_scaled" for c in NUMERIC_COLS] + [f"platform_encoded_{v}" for v in idx.labels]
            + [f"description_tfidf_{t}" for t in cv.vocabulary])


# ------------------------------------------------------------------ split --
def stratified_split(df: DataFrame, label: str, id_col: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``side`` (train / test): per class the ceil(share * n_class) rows
    with the smallest hash(id, seed) are test (BAL1). Exact sizes, independent
    of partitioning. Only labels and ids are ranked, by range-partitioned prefix
    sums; each class' last test id is then compared with every row, so the rows
    themselves are neither shuffled nor sorted. Of copies of a class' last id some
    may be test and some train. Rows without a label are left out."""
    from pyspark.sql import Window
    from vitrine.session import cut_lineage
    order = F.struct(F.xxhash64(F.col(id_col), F.lit(seed)).alias("h"), F.col(id_col).alias("i"))
    df = df.where(F.col(label).isNotNull())
    ids = df.groupBy(label, id_col).agg(F.count(F.lit(1)).alias("_c")).select(label, order.alias("_h"), "_c")
    n = ids.groupBy(label).agg(F.ceil(F.sum("_c") * test_share).alias("_k"))
    before = F.col("cum__c") - F.col("_c")
    last = prefix_sums(ids, [label], "_h", ["_c"]).join(n, label).where((before < F.col("_k")) & (F.col("cum__c") >= F.col("_k")))
    last = cut_lineage(last.select(label, F.col("_h").alias("_last"), (F.col("_k") - before).alias("_take"), "_c"))
    j = df.join(F.broadcast(last), label, "left").withColumn("_h", order)  # one row per class
    cols, test, train = df.columns, F.lit("test"), F.lit("train")
    side = F.when(F.col("_h") <= F.col("_last"), test).otherwise(train)
    some = F.coalesce((F.col("_h") == F.col("_last")) & (F.col("_take") < F.col("_c")), F.lit(False))
    if last.where(F.col("_take") < F.col("_c")).isEmpty():
        return j.select(*cols, side.alias("side"))
    nth = F.row_number().over(Window.partitionBy(label).orderBy(F.xxhash64(*cols)))  # copies of one id per class
    return j.where(~some).select(*cols, side.alias("side")).unionByName(
        j.where(some).withColumn("_nth", nth).select(*cols, F.when(F.col("_nth") <= F.col("_take"), test).otherwise(train).alias("side")))


def hash_ordered_split(df: DataFrame, label: str, id_col: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """``stratified_split`` with the rows of each class in order of their hash, for learners that draw samples by position:
    what they draw then does not hang on the order in which ``df`` comes. The rows are shuffled whole."""
    h = df.withColumn("_h", F.struct(F.xxhash64(F.col(id_col), F.lit(seed)).alias("h"), F.col(id_col).alias("i"))) \
        .withColumn("_one", F.lit(1))
    ranked = prefix_sums(h, [label], "_h", ["_one"])
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    j = ranked.join(n, label)  # one row per class
    return j.withColumn("side", F.when(F.col("cum__one") <= F.ceil(F.col("_n") * test_share), F.lit("test"))
                        .otherwise(F.lit("train"))).drop("_h", "_one", "cum__one", "_n")


def fold_column(df: DataFrame, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Deterministic fold id from a hash; stable under repartitioning."""
    return df.withColumn("fold", (F.abs(F.xxhash64(F.col(id_col), F.lit(seed + 1))) % k).cast("int"))


def split_check(split: DataFrame, label: str, max_gap: float = 0.05) -> DataFrame:
    """Max class-share gap of each side against the whole (BAL2)."""
    from pyspark.sql import Window
    # windows over per-class / per-(side, class) counts: a handful of rows
    whole = split.groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "share_all", F.col("n") / F.sum("n").over(Window.partitionBy()))
    side = split.groupBy("side", label).agg(F.count(F.lit(1)).alias("ns"))
    side = side.withColumn("share", F.col("ns") / F.sum("ns").over(Window.partitionBy("side")))
    j = side.join(whole.select(label, "share_all"), label)
    return j.groupBy("side").agg(F.max(F.abs(F.col("share") - F.col("share_all"))).alias("max_gap"),
                                 F.sum("ns").alias("rows")).withColumn("ok", F.col("max_gap") <= max_gap)


def class_weights(df: DataFrame, label: str, mode: str = "balanced") -> DataFrame:
    """balanced = N / (k n_c); custom = N / n_c normalised to sum k (BAL4)."""
    from pyspark.sql import Window
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()
    N, k = F.sum("n_c").over(w), F.count(F.lit(1)).over(w)
    if mode == "balanced":
        return c.withColumn("weight", N / (k * F.col("n_c")))
    raw = N / F.col("n_c")
    return c.withColumn("weight", raw / F.sum(raw).over(w) * k)


def with_weights(df: DataFrame, weights: DataFrame, label: str) -> DataFrame:
    return df.join(F.broadcast(weights.select(label, "weight")), label)  # one row per class


def balance_check(before: DataFrame, after: DataFrame, label: str, tol: float = 0.1) -> DataFrame:
    """Max-min share gap before and after, improvement, balanced flag (BAL5)."""
    def gap(d, name):
        s = d.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
        return s.agg(((F.max("n") - F.min("n")) / F.sum("n")).alias(name))
    from vitrine.functions.partitioning import with_scalars
    j = with_scalars(gap(before, "gap_before"), gap(after, "gap_after"))
    return j.select("gap_before", "gap_after", (F.col("gap_before") - F.col("gap_after")).alias("improvement"),
                    (F.col("gap_after") <= tol).alias("balanced"))


def smote(df: DataFrame, label: str, id_col: str, features: str = "features", k: int = 5, seed: int = 42) -> DataFrame:
    """Minority rows interpolated towards one of their k nearest minority neighbours (all others, if they are fewer) until the
    classes match (BAL3). Neighbours are exact (``neighbours.knn_join``), every minority row has some, and rows
    are used equally often but for one. Synthetic ids lie below all ids there are. One minority row alone has no
    neighbour: an error. The least frequent class is the minority, of equally frequent ones the smallest label."""
    from pyspark.ml.functions import array_to_vector
    from vitrine.operators.neighbours import knn_join
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("least"))
    mm = counts.agg(F.min(F.struct("n", label)).alias("few"), F.max("n").alias("n_max"), F.min("least").alias("least")).first()
    need = int(mm["n_max"] - mm["few"]["n"]) if mm["few"] else 0
    if need <= 0:
        return df.select(id_col, label, features, F.lit(False).alias("synthetic"))
    n_min, minority, least = int(mm["few"]["n"]), mm["few"][label], min(0, int(mm["least"]))
    if n_min < 2:
        raise ValueError("a minority class of one row has no neighbours to interpolate to")
    mino = df.where(F.col(label) == minority).select(id_col, vector_to_array(features).alias("x"))
    nn = knn_join(mino, id_col, "x", k)
    reps = (need + n_min - 1) // n_min
    # rank the points by a seeded hash (distributed prefix sum), then keep
    # the first ``need`` of the (rep, point) grid: exactly the class deficit
    ranked = prefix_sums(mino.select(F.col(id_col).alias("a"), F.col("x").alias("xa"),
                                     F.struct(F.xxhash64(F.col(id_col), F.lit(seed)).alias("h"), F.col(id_col).alias("i")).alias("_h"),
                                     F.lit(1).alias("_one")), [], "_h", ["_one"])
    base = ranked.select("a", "xa", F.col("cum__one").alias("pos"),
                         F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"))
    base = base.withColumn("nth", F.col("rep").cast("long") * n_min + F.col("pos")).where(F.col("nth") <= need)
    pick = (F.pmod(F.xxhash64("a", "rep", F.lit(seed)), F.lit(min(k, n_min - 1))) + 1).cast("int")
    j = base.withColumn("r", pick).join(nn.select("a", "r", "b"), ["a", "r"])
    j = j.join(mino.select(F.col(id_col).alias("b"), F.col("x").alias("xb")), "b")
    u = F.pmod(F.xxhash64("a", "rep", F.lit(seed + 7)), F.lit(1000000)) / 1000000.0
    synth = j.select((F.lit(least) - F.col("nth")).cast("long").alias(id_col),
                     array_to_vector(F.zip_with("xa", "xb", lambda p, q: p + u * (q - p))).alias(features))
    synth = synth.select(id_col, F.lit(minority).alias(label), features, F.lit(True).alias("synthetic"))
    return df.select(id_col, label, features, F.lit(False).alias("synthetic")).unionByName(synth)


# --------------------------------------------------------------- training --
def sized(df: DataFrame, rows: int | None = None, rows_per_partition: int = 10_000) -> DataFrame:
    """Training input partitioned by its size: iterative solvers launch one job
    per iteration, so tiny inputs should not be spread over many tiny tasks,
    while large ones keep ~``rows_per_partition`` rows (some 15 MB of features) per task.
    ``rows``: their number where it is known."""
    n = df.count() if rows is None else rows
    parts = max(1, -(-n // rows_per_partition))
    return df.repartition(parts)


def classifiers(seed: int = 42) -> dict:
    """The four model families with MLlib defaults mapped from the reference."""
    return {
        "random_forest": RandomForestClassifier(numTrees=100, maxDepth=10, minInstancesPerNode=1, seed=seed,
                                                featureSubsetStrategy="sqrt"),
        "logistic_regression": LogisticRegression(maxIter=50, regParam=0.01, elasticNetParam=0.0, standardization=False),
        "gradient_boosting": GBTClassifier(maxIter=50, stepSize=0.1, maxDepth=3, subsamplingRate=1.0, seed=seed),
        "svm": LinearSVC(maxIter=50, regParam=0.01),
    }


def evaluate_model(pred: DataFrame) -> dict:
    """accuracy, precision, recall, f1 (weighted) and AUC of one prediction frame."""
    out = {}
    for m, name in [("accuracy", "accuracy"), ("weightedPrecision", "precision"), ("weightedRecall", "recall"), ("f1", "f1_score")]:
        out[name] = MulticlassClassificationEvaluator(metricName=m).evaluate(pred)
    raw = "rawPrediction"
    out["auc"] = BinaryClassificationEvaluator(rawPredictionCol=raw, metricName="areaUnderROC").evaluate(pred)
    return out


def train_eval(name: str, est, train: DataFrame, test: DataFrame) -> tuple:
    model = est.fit(train)
    return model, {f"train_{k}": v for k, v in evaluate_model(model.transform(train)).items()} | \
        {f"test_{k}": v for k, v in evaluate_model(model.transform(test)).items()}


def importance_frame(spark, model_name: str, names: Sequence[str], values) -> DataFrame:
    rows = [(model_name, n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def tree_importance_std(model) -> list:
    """Per-feature population std of importances over the forest's trees (TRN2)."""
    import numpy as np
    arr = np.array([t.featureImportances.toArray() for t in model.trees])
    return arr.std(axis=0).tolist()


def grid(est, params: dict) -> list:
    b = ParamGridBuilder()
    for p, vals in params.items():
        b = b.addGrid(est.getParam(p), list(vals))
    return b.build()


def random_grid(est, space: dict, n_iter: int, seed: int = 42) -> list:
    """Seeded random draws from a discrete space (HPO9)."""
    rng = random.Random(seed)
    full = [dict(zip(space, combo)) for combo in itertools.product(*space.values())]
    picks = rng.sample(full, min(n_iter, len(full)))
    return [{est.getParam(k): v for k, v in p.items()} for p in picks]


def random_maps(est, space: dict, n_iter: int, seed: int = 42) -> list:
    """Seeded random draws from distributions, each a sequence to choose from (HPO9): every draw by itself, so one may come again."""
    rng = random.Random(seed)
    return [{est.getParam(k): rng.choice(v) for k, v in space.items()} for _ in range(n_iter)]


def search(est, maps: list, data: DataFrame, folds: int = 3, parallelism: int = 4, seed: int = 42,
           metric: str = "f1", validation_split: bool = False, id_col: str | None = None):
    """Grid / random search with k-fold CV (or one validation split) (HPO5/HPO9).

    With ``id_col`` as the reference does it: stratified folds (each class is dealt to them in the order of a hash of the id, so
    that they do not hang on how rows are spread), scored by F1 of class 1. The best map is fitted to all rows."""
    if id_col:
        from vitrine.operators.forest import PositiveF1
        from vitrine.operators.kernel import stratified_folds
        rows = sized(stratified_folds(data, "label", id_col, folds, seed)).sortWithinPartitions(F.xxhash64(id_col), id_col).cache()
        try:
            m = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=PositiveF1(), numFolds=folds, parallelism=parallelism,
                               foldCol="fold", collectSubModels=False).fit(rows)
        finally:
            rows.unpersist()
        return m, list(m.avgMetrics)
    ev = MulticlassClassificationEvaluator(metricName=metric)
    if validation_split:
        tv = TrainValidationSplit(estimator=est, estimatorParamMaps=maps, evaluator=ev, trainRatio=0.8,
                                  parallelism=parallelism, seed=seed)
        m = tv.fit(data)
        return m, list(m.validationMetrics)
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=ev, numFolds=folds, parallelism=parallelism,
                        seed=seed, collectSubModels=False)
    m = cv.fit(data)
    return m, list(m.avgMetrics)


def results_frame(spark, model_name: str, maps: list, scores: list, seconds: float) -> DataFrame:
    rows = [(model_name, str({p.name: v for p, v in pm.items()}), float(s), seconds / max(1, len(maps)))
            for pm, s in zip(maps, scores)]
    return spark.createDataFrame(rows, "model string, params string, score double, seconds double")


def compare_searches(results: DataFrame) -> DataFrame:
    """A row per searched model of ``results`` (model, score, seconds, strategy), ranked by best score (HPO13): efficiency is score
    per minute; on every row stand the range of the best scores, the best, most efficient, fastest and slowest model, the mean
    time and the recommendations. A model whose best score is 0 failed and is left out. Of equals the first by name."""
    from pyspark.sql import Window
    by = results.groupBy("model").agg(F.max("score").alias("best_score"), F.sum("seconds").alias("seconds"), F.stddev_samp("score").alias("score_spread"),
                                      F.min("strategy").alias("method"), F.count(F.lit(1)).alias("iterations"))
    by = by.where(F.col("best_score") > 0).withColumn("efficiency", F.col("best_score") / (F.col("seconds") / 60.0))
    by = by.withColumn("rank", F.row_number().over(Window.orderBy(F.col("best_score").desc(), "model")))  # a row per model
    w = Window.partitionBy()
    least = lambda c: F.min_by("model", F.struct(c, F.col("model"))).over(w)
    by = by.withColumns({
        "score_min": F.min("best_score").over(w), "score_max": F.max("best_score").over(w), "score_std": F.stddev_samp("best_score").over(w),
        "best_model": least(F.col("rank")), "most_efficient": least(-F.col("efficiency")), "fastest": least(F.col("seconds")),
        "slowest": least(-F.col("seconds")), "avg_seconds": F.avg("seconds").over(w),
        "_methods": F.collect_set("method").over(w), "_top": F.collect_set(F.when(F.col("rank") <= 3, F.col("model"))).over(w)})
    best, std, other = F.col("score_max"), F.col("score_std"), F.col("most_efficient") != F.col("best_model")
    said = [
        F.format_string("Best performing model: %s (score: %.4f)", "best_model", best),
        F.when(std < 0.05, F.lit("Models show similar performance - consider efficiency and interpretability"))
         .otherwise(F.format_string("Significant performance differences detected (std: %.4f)", std)),
        F.when(other, F.format_string("Most efficient model: %s (best score/time ratio)", "most_efficient")),
        F.when(other, F.lit("Consider efficiency vs. performance trade-off for production deployment")),
        F.when(F.array_contains("_methods", "grid") & F.array_contains("_methods", "random"),
               F.lit("Mixed optimization methods used - automatic selection working well")),
        F.when(best < 0.8, F.lit("Best score below 80% - consider feature engineering or data quality improvements"))
         .when(best > 0.95, F.lit("Excellent performance achieved - validate against overfitting")),
        F.when(F.array_contains("_top", "random_forest"), F.lit("Random Forest in top 3 - good baseline with interpretability")),
        F.when(F.array_contains("_top", "gradient_boosting"), F.lit("Gradient Boosting in top 3 - consider ensemble methods"))]
    return by.withColumn("recommendations", F.array_compact(F.array(*said))).drop("_methods", "_top")
