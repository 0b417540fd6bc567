"""Interpretation and scoring (INT*, SCO*, WIN8, AGG17).

Contributions are long frames (row, feature, contribution): a vector column is
``posexplode``d and joined to the model's coefficient / importance table,
which has one row per feature slot (bounded by the model, so broadcast).
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine import config as C


def contributions(df: DataFrame, id_col: str, weights: DataFrame, features: str = "features") -> DataFrame:
    """value x weight per feature slot (INT3 with coefficients, INT4 with importances).
    ``weights`` = (idx, feature, weight), one row per slot."""
    ex = df.select(id_col, F.posexplode(vector_to_array(features)).alias("idx", "value"))
    j = ex.join(F.broadcast(weights), "idx")
    return j.select(id_col, "feature", "value", (F.col("value") * F.col("weight")).alias("contribution"))


def contribution_topk(contrib: DataFrame, id_col: str, n: int = 5, absolute: bool = True) -> DataFrame:
    """Top n per row by absolute (or by signed) contribution with rank and direction (WIN8).
    ``row_number() <= n`` is planned with a partial window-group limit."""
    by = F.abs("contribution") if absolute else F.col("contribution")
    w = Window.partitionBy(id_col).orderBy(by.desc(), F.col("feature"))
    r = contrib.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return r.withColumn("direction", F.when(F.col("contribution") > 0, F.lit("positive"))
                        .when(F.col("contribution") < 0, F.lit("negative")).otherwise(F.lit("neutral")))


def top_features_struct(topk: DataFrame, id_col: str) -> DataFrame:
    """The top-n rows of a row as one sorted array<struct> (explanation record).
    Each array holds at most n entries, so the collect is bounded."""
    return topk.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(
        "rank", "feature", "contribution", F.abs("contribution").alias("abs_contribution"), "direction"))).alias("top_features"))


def confidence_columns(probs: Column) -> dict:
    """max probability; 1 - entropy / ln k (1e-10 guard); top-1 minus top-2 (INT6)."""
    k = F.size(probs)
    ent = -F.aggregate(probs, F.lit(0.0), lambda acc, p: acc + p * F.log(p + F.lit(1e-10)))
    srt = F.sort_array(probs, asc=False)
    return {"max_probability": F.array_max(probs),
            "entropy_confidence": F.lit(1.0) - ent / F.log(k.cast("double")),
            "margin": F.get(srt, 0) - F.get(srt, 1)}


def confidence_band(c: Column, bands=tuple(C.CONFIDENCE_BANDS), other: str = C.CONFIDENCE_BAND_ELSE) -> Column:
    """>= .9 Very High, .8 High, .7 Moderate, .6 Low, else Very Low (INT11)."""
    out = None
    for t, name in bands:
        out = F.when(c >= t, F.lit(name)) if out is None else out.when(c >= t, F.lit(name))
    return out.otherwise(F.lit(other))


def confidence_factors(top: Column) -> dict:
    """Positive / negative counts and strengths and their balance over the top-feature array (INT12)."""
    pos = F.filter(top, lambda s: s["contribution"] > 0)
    neg = F.filter(top, lambda s: s["contribution"] < 0)
    ps = F.aggregate(pos, F.lit(0.0), lambda a, s: a + s["contribution"])
    ns = F.aggregate(neg, F.lit(0.0), lambda a, s: a + F.abs(s["contribution"]))
    return {"positive_factors": F.size(pos), "negative_factors": F.size(neg), "positive_strength": ps,
            "negative_strength": ns, "factor_balance": ps - ns}


def uncertainty_flags(confidence: Column, top: Column, low: float = 0.6, weak: float = 0.1) -> Column:
    """Low confidence; mixed signs; no strong feature (INT13)."""
    mixed = F.exists(top, lambda s: s["contribution"] > 0) & F.exists(top, lambda s: s["contribution"] < 0)
    max_abs = F.array_max(F.transform(top, lambda s: s["abs_contribution"]))
    return F.array_compact(F.array(
        F.when(confidence < low, F.lit("Low prediction confidence")),
        F.when(mixed, F.lit("Mixed feature signals")),
        F.when(F.coalesce(max_abs, F.lit(0.0)) < weak, F.lit("No strong individual features"))))


def explanation_text(prediction: Column, confidence: Column, top: Column, review_below: float = 0.7) -> Column:
    """Sentence with band, up to 5 factors, and a review note below ``review_below`` (INT14)."""
    factors = F.array_join(F.transform(F.slice(top, 1, 5), lambda s: F.format_string(
        "%s (%s, %.3f)", s["feature"], s["direction"], F.round(s["contribution"] * 1000) / 1000.0)), "; ")
    base = F.format_string("Predicted %s with %s confidence (%.1f%%). Key factors: %s.", prediction,
                           confidence_band(confidence), F.round(confidence * 1000) / 10.0, factors)
    return F.when(confidence < review_below, F.concat(base, F.lit(" Manual review recommended."))).otherwise(base)


def permuted_scores(model, data: DataFrame, id_col: str, slots: Sequence[int], repeats: int = 2, seed: int = 42,
                    features: str = "features") -> DataFrame:
    """Permutation importance in ONE scoring job (INT2): every (slot, repeat)
    copy of the data takes slot ``j`` from a hash-permuted donor row, the model
    scores all copies at once, and accuracy drops come from one aggregate."""
    from vitrine.functions.prefix import prefix_sums
    base = data.select(id_col, "label", features)
    out = None
    for r in range(repeats):
        a = prefix_sums(base.select(id_col, F.struct(F.xxhash64(id_col, F.lit(seed + r)).alias("h"), F.col(id_col).alias("i"))
                                    .alias("_o"), F.lit(1).alias("_one")), [], "_o", ["_one"]).select(id_col, F.col("cum__one").alias("k"))
        b = prefix_sums(base.select(F.col(id_col).alias("_donor"), F.col(id_col).alias("_o2"), F.lit(1).alias("_one")), [],
                        "_o2", ["_one"]).select("_donor", F.col("cum__one").alias("k"))
        pairs = a.join(b, "k").select(id_col, "_donor", F.lit(r).alias("repeat"))
        out = pairs if out is None else out.unionByName(pairs)
    donors = base.select(F.col(id_col).alias("_donor"), vector_to_array(features).alias("_dv"))
    x = base.join(out, id_col).join(donors, "_donor")
    x = x.select(id_col, "label", "repeat", vector_to_array(features).alias("_v"), "_dv",
                 F.explode(F.array(*[F.lit(j) for j in slots])).alias("slot"))
    x = x.select(id_col, "label", "repeat", "slot", array_to_vector(F.transform(
        "_v", lambda v, i: F.when(i == F.col("slot"), F.get(F.col("_dv"), i)).otherwise(v))).alias(features))
    scored = model.transform(x)
    return scored.groupBy("slot", "repeat").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def permutations(df: DataFrame, id_col: str, repeats: int, seed: int = 42) -> DataFrame:
    """(repeat, id, donor): ``repeats`` permutations of the ids, each by rank of a hash; no order is made in one task."""
    from vitrine.functions.prefix import prefix_sums
    ids = df.select(F.col(id_col).alias("i")).withColumn("one", F.lit(1))
    donors = prefix_sums(ids, [], "i", ["one"]).select(F.col("i").alias("donor"), F.col("cum_one").alias("k"))
    drawn = ids.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    drawn = drawn.withColumn("o", F.struct(F.xxhash64("i", "repeat", F.lit(seed)).alias("h"), "i"))
    ranked = prefix_sums(drawn, ["repeat"], "o", ["one"]).select("repeat", F.col("i").alias(id_col), F.col("cum_one").alias("k"))
    return ranked.join(donors, "k").select("repeat", id_col, "donor")


def linear_permutation_importance(model, data: DataFrame, id_col: str, names: Sequence[str], repeats: int = 10, seed: int = 42,
                                  features: str = "features") -> DataFrame:
    """feature, importance_mean, importance_std: accuracy lost when a slot is permuted, for every slot of a linear model (INT2).

    The score of a row whose slot j comes from a donor changes by coefficient_j x (donor's value - own value), so rows are
    scored once, and only slots in which row and donor differ give a term; the others count 0. Ids are unique."""
    coef = F.array(*[F.lit(float(c)) for c in model.coefficients.toArray()])
    scored = model.transform(data).select(id_col, F.col("label").cast("double").alias("y"), vector_to_array(features).alias("v"),
                                          vector_to_array("rawPrediction")[1].alias("m"))
    pairs = permutations(data, id_col, repeats, seed)
    donors = data.select(F.col(id_col).alias("donor"), vector_to_array(features).alias("dv"))
    j = scored.join(pairs, id_col).join(donors, "donor").withColumn("coef", coef)
    moved = F.filter(F.transform(F.arrays_zip("v", "dv", "coef"), lambda x, i: F.struct(i.alias("slot"), (x["coef"] * (x["dv"] - x["v"])).alias("by"))),
                     lambda x: x["by"] != 0)
    x = j.select("repeat", "y", "m", F.explode(moved).alias("x")).select("repeat", "y", "m", "x.*")

    def right(m: Column) -> Column:
        return ((m > 0).cast("double") == F.col("y")).cast("int")
    lost = x.groupBy("slot", "repeat").agg(F.sum(right(F.col("m")) - right(F.col("m") + F.col("by"))).alias("lost"))
    n = F.nullif(scored.agg(F.count("*")).scalar(), F.lit(0))
    per = lost.select("slot", (F.col("lost") / n).alias("d")).groupBy("slot").agg(F.sum("d").alias("s"), F.sum(F.col("d") ** 2).alias("q"))
    slots = data.sparkSession.createDataFrame([(i, nm) for i, nm in enumerate(names)], "slot int, feature string")
    mean = F.coalesce(F.col("s"), F.lit(0.0)) / repeats
    var = F.coalesce(F.col("q"), F.lit(0.0)) / repeats - mean * mean
    return slots.join(per, "slot", "left").select("feature", mean.alias("importance_mean"), F.sqrt(F.greatest(F.lit(0.0), var)).alias("importance_std"))


def explanation_records(topk: DataFrame, id_col: str, confidence: DataFrame) -> DataFrame:
    """Explanation record per row: prediction, confidence and top-feature array."""
    return top_features_struct(topk, id_col).join(confidence, id_col)
