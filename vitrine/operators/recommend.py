"""Choosing a model: traits by name and stability, and a recommendation score with its reasons (EVA20, EVA24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine import config as C
from vitrine.functions.text import contains_any


def trait(name: Column, rules) -> Column:
    """Score of the first rule one of whose words is part of the lowered name."""
    out = None
    for words, score in rules:
        hit = contains_any(name, words)
        out = F.when(hit, F.lit(score)) if out is None else out.when(hit, F.lit(score))
    return out.otherwise(F.lit(C.DEFAULT_TRAIT))


def model_traits(models: DataFrame, cv: DataFrame) -> DataFrame:
    """Interpretability, speed, complexity and memory by name; stability = max(0, 1 - 10 x mean over the metrics of the test
    scores' std over folds), the default without any (EVA24). ``cv``: model, metric, fold, score of test folds."""
    std = cv.groupBy("model", "metric").agg(F.stddev_pop("score").alias("s")).groupBy("model").agg(F.avg("s").alias("s"))
    name = F.lower(F.coalesce("model", F.lit("")))
    j = models.select("model").distinct().join(std, "model", "left")
    return j.select("model", *[trait(name, rules).alias(t) for t, rules in C.MODEL_TRAITS.items()],
                    F.when(F.col("s").isNotNull(), F.greatest(F.lit(0.0), 1 - F.col("s") * 10)).otherwise(F.lit(C.DEFAULT_TRAIT)).alias("stability"))


def _three(x: Column) -> Column:
    return F.round(x, 3).cast("decimal(8,3)").cast("string")


def recommend(m: DataFrame, cv_std: DataFrame, primary: str = "f1_score", min_accuracy: float = 0.8, stability: bool = True,
              interpretability: bool = False, speed: bool = False) -> DataFrame:
    """model, score, rank, recommended, reasons and, for the recommended model, warnings (EVA20): 0.4 x the primary metric, +0.2
    or -0.3 by the least accuracy, +0.15 or -0.1 by the std over folds, +0.1 for an interpretable and for a fast kind of model
    where that matters. ``cv_std``: model, test_std of the primary metric; models without one get no such term."""
    name, acc, std = F.lower(F.coalesce("model", F.lit(""))), F.col("accuracy"), F.col("test_std")
    least = F.lit(str(min_accuracy))
    terms = [(F.col(primary) * 0.4, F.concat(F.lit(f"{primary}: "), _three(F.col(primary)))),
             (F.when(acc >= min_accuracy, 0.2).otherwise(-0.3),
              F.when(acc >= min_accuracy, F.concat(F.lit("Meets accuracy requirement (\u2265"), least, F.lit(")")))
              .otherwise(F.concat(F.lit("Below accuracy requirement ("), _three(acc), F.lit(" < "), least, F.lit(")"))))]
    if stability:
        terms.append((F.when(std < 0.05, 0.15).when(std > 0.1, -0.1).otherwise(0.0),
                      F.when(std < 0.05, F.concat(F.lit("High stability (CV std: "), _three(std), F.lit(")")))
                      .when(std > 0.1, F.concat(F.lit("Lower stability (CV std: "), _three(std), F.lit(")")))))
    for wanted, words, says in ((interpretability, C.INTERPRETABLE_MODELS, "Interpretable model type"), (speed, C.FAST_MODELS, "Fast model type")):
        if wanted:
            hit = contains_any(name, words)
            terms.append((F.when(hit, 0.1).otherwise(0.0), F.when(hit, F.lit(says))))
    j = m.join(cv_std, "model", "left")
    s = j.select("model", sum((t for t, _ in terms[1:]), terms[0][0]).alias("score"), "accuracy",
                 F.array_join(F.array_compact(F.array(*[r for _, r in terms])), "; ").alias("reasons"))
    s = s.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), "model")))  # a row per model
    first = F.col("rank") == 1
    warn = F.array(F.when(first & (F.col("score") < 0.7), F.lit("Low overall recommendation score - consider model improvement")),
                   F.when(first & (F.col("accuracy") < min_accuracy), F.lit("Recommended model does not meet minimum accuracy requirement")))
    return s.select("model", "score", "rank", first.alias("recommended"), "reasons", F.array_join(F.array_compact(warn), "; ").alias("warnings"))
