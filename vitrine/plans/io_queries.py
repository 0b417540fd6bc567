"""Sources and sinks (SRC1-3, SRC9, SRC10, SRC13) and remaining model reports
(EVA24, EVA26, INT9, SEL4, TRN4)."""

from __future__ import annotations

import os
import time

import pandas as pd
from pyspark.sql import functions as F

from vitrine.operators import ml as ML
from vitrine.plans.catalog import register
from vitrine.session import checkpoint_dir
from vitrine.sources import files as FS
from vitrine.sources import fixtures as FX
from pyspark.sql import types as T


def _out(spark, tag):
    return os.path.join(checkpoint_dir(spark), f"{tag}-{int(time.time() * 1e6)}")


TEXT_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("title", T.StringType()),
                            T.StructField("description", T.StringType()), T.StructField("_corrupt_record", T.StringType())])


@register("src_csv_roundtrip", "SELECT doc_id, title, description FROM texts")
def q_src_csv_roundtrip(spark, d):
    """Whole documents (with line breaks and quotes) through the CSV sink and
    the multi-line CSV source with an explicit schema (SRC1, SRC3)."""
    path = _out(spark, "csv")
    FS.write_csv(FX.texts(spark, d).select("doc_id", "title", "description"), path)
    back = FS.read_csv(spark, path, TEXT_SCHEMA)
    return back.drop("_corrupt_record")


@register("src_latest_batch", "SELECT listing_id, title, price FROM listings WHERE platform = 'americanas'")
def q_src_latest_batch(spark, d):
    """Two batches written one after the other; the source keeps the newest batch's rows (SRC2)."""
    base = _out(spark, "batches")
    lst = FX.listings(spark, d).select("listing_id", "title", "price", "platform")
    lst.where(F.col("platform") == "mercadolivre").drop("platform").write.parquet(base + "/b1")
    time.sleep(1.1)
    lst.where(F.col("platform") == "americanas").drop("platform").write.parquet(base + "/b2")
    schema = "listing_id long, title string, price string"
    return FS.latest_batch(spark, base + "/*/*.parquet", T._parse_datatype_string(schema), fmt="parquet")


@register("score_and_append")
def q_score_and_append(spark, d):
    """Score a batch, append one classification row each; rows that fail
    validation go to a quarantine frame instead of failing the batch (SRC9)."""
    from vitrine.plans.ml_queries import q_score_new
    scored = q_score_new(spark, d)
    err = F.when(F.col("confidence_score").isNull(), F.lit("no score")).when(F.col("product_id").isNull(), F.lit("no id"))
    s = scored.withColumn("error", err)
    path = _out(spark, "classifications")
    FS.append(s.where(F.col("error").isNull()).drop("error"), path)
    FS.append(s.where(F.col("error").isNotNull()), path + "_quarantine")
    return spark.read.parquet(path)


@register("metrics_unpivot", """WITH s AS (SELECT 'classifications_total' AS name, CAST(count(*) AS DOUBLE) AS value FROM classifications
  UNION ALL SELECT 'classification_avg_confidence', avg(confidence_score) FROM classifications
  UNION ALL SELECT 'classification_avg_time_ms', avg(processing_time_ms) FROM classifications
  UNION ALL SELECT 'products_total', CAST(count(*) AS DOUBLE) FROM products
  UNION ALL SELECT 'jobs_total', CAST(count(*) AS DOUBLE) FROM jobs)
SELECT name, round(value, 6) AS value, printf('%s %.6f', name, round(value, 6)) AS line FROM s""")
def q_metrics_unpivot(spark, d):
    """Scoring and table counts flattened to ``name value`` lines (SRC10)."""
    c = FX.classifications(spark, d).agg(F.count(F.lit(1)).cast("double").alias("classifications_total"),
                                         F.avg("confidence_score").alias("classification_avg_confidence"),
                                         F.avg("processing_time_ms").alias("classification_avg_time_ms"))
    p = FX.products(spark, d).agg(F.count(F.lit(1)).cast("double").alias("products_total"))
    j = FX.jobs(spark, d).agg(F.count(F.lit(1)).cast("double").alias("jobs_total"))
    from vitrine.functions.partitioning import with_scalars
    one = with_scalars(with_scalars(c, p), j)
    names = one.columns
    long = one.select(F.stack(F.lit(len(names)), *[x for n in names for x in (F.lit(n), F.col(n))]).alias("name", "value"))
    long = long.withColumn("value", F.round("value", 6))
    return long.withColumn("line", F.format_string("%s %.6f", "name", "value"))


@register("gen_listings")
def q_gen_listings(spark, d, seed: int = 42):
    """Deterministic synthetic listings (SRC13): one row per order key, every
    field chosen by a seeded hash, so any size regenerates identically."""
    from vitrine import config as C
    k = F.col("o_orderkey")
    o = spark.read.parquet(os.path.join(d, "orders.parquet")).select(k)

    def pick(options, salt):
        arr = F.array(*[F.lit(x) for x in options])
        return F.get(arr, (F.abs(F.xxhash64(k, F.lit(seed), F.lit(salt))) % len(options)).cast("int"))
    u = (F.abs(F.xxhash64(k, F.lit(seed), F.lit(99))) % 10000) / 10000.0
    return o.select(k.alias("listing_id"),
                    F.concat_ws(" ", pick(["Cartucho", "Toner", "Tinta"], 1), F.lit("HP"), pick(["664", "122", "85A", "GT52"], 2),
                                pick(["Original", "compatível", "lacrado", ""], 3)).alias("title"),
                    pick(C.OFFICIAL_STORES + C.GENERIC_SELLERS + ["Loja Central"], 4).alias("seller_name"),
                    F.round(F.lit(20.0) + u * 300, 2).alias("price_numeric"),
                    F.round(F.lit(1.0) + u * 4, 1).alias("rating_numeric"),
                    (F.abs(F.xxhash64(k, F.lit(seed), F.lit(5))) % 2000).cast("int").alias("reviews_count"),
                    pick(["mercadolivre", "americanas"], 6).alias("platform"))


# ----------------------------------------------------------- model reports --
@register("recommend_system", """WITH m AS (SELECT model, count_if(y_true = 1 AND y_pred = 1) AS tp, count_if(y_true = 0 AND y_pred = 1) AS fp,
  count_if(y_true = 1 AND y_pred = 0) AS fn, count(*) AS n, count_if(y_true = y_pred) AS ok FROM predictions GROUP BY model),
x AS (SELECT model, coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0e0) AS f1, CAST(ok AS DOUBLE) / n AS acc,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0e0) AS prec, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0e0) AS rec FROM m),
r AS (SELECT model, f1, (CAST(acc >= 0.7 AS INTEGER) + CAST(prec >= 0.6 AS INTEGER) + CAST(rec >= 0.6 AS INTEGER) + CAST(f1 >= 0.6 AS INTEGER)) / 4e0 AS readiness FROM x)
SELECT model, round(f1, 6) AS score, readiness AS readiness_score, readiness >= 0.8 AS ready,
  CAST(row_number() OVER (ORDER BY f1 DESC, model) AS INTEGER) AS rank, row_number() OVER (ORDER BY f1 DESC, model) = 1 AS best FROM r""")
def q_recommend_system(spark, d):
    """Primary-metric score with readiness attached, ranked, best flagged (EVA26)."""
    from pyspark.sql import Window
    from vitrine.operators import evaluate as EV
    m = EV.metrics_from_counts(EV.confusion_counts(FX.predictions(spark, d), ["model"]))
    checks = [("accuracy", 0.7), ("precision", 0.6), ("recall", 0.6), ("f1_score", 0.6)]
    ready = sum(((F.col(c) >= t).cast("int") for c, t in checks), F.lit(0)) / 4.0
    w = Window.orderBy(F.col("f1_score").desc(), "model")
    return m.select("model", F.round("f1_score", 6).alias("score"), ready.alias("readiness_score"), (ready >= 0.8).alias("ready"),
                    F.row_number().over(w).alias("rank"), (F.row_number().over(w) == 1).alias("best"))


@register("importance_models")
def q_importance_models(spark, d):
    """Impurity and permutation importances of the fitted models, ranked per model and method (INT9)."""
    from vitrine.operators.relational import importance_rank
    from vitrine.plans.ml_queries import q_permutation_importance, q_tree_importance
    t = q_tree_importance(spark, d).withColumn("method", F.lit("impurity"))
    p = q_permutation_importance(spark, d).select(F.lit("logistic_regression").alias("model"), "feature",
                                                  F.col("importance_mean").alias("importance"), F.lit("permutation").alias("method"))
    return importance_rank(t.unionByName(p))


@register("corr_drop")
def q_corr_drop(spark, d):
    """Drop correlated slots from the assembled vector with ``VectorSlicer`` (SEL4)."""
    from pyspark.ml.feature import VectorSlicer
    from pyspark.ml.functions import vector_to_array
    from vitrine.operators import select as SL
    from vitrine.plans.ml_queries import prepared
    pm, tr, _, _ = prepared(spark, d)
    names = [f"{c}_scaled" for c in ML.NUMERIC_COLS]
    num = tr.select(vector_to_array("features").alias("a")).select(*[F.get("a", i).alias(n) for i, n in enumerate(names)])
    pairs = SL.corr_pairs(num, names)
    drop = [r.feature for r in SL.corr_pick(SL.corr_high_pairs(pairs, 0.8)).collect()]
    n_all = len(ML.feature_names(pm))
    keep = [i for i in range(n_all) if i >= len(names) or names[i] not in set(drop)]
    sl = VectorSlicer(inputCol="features", outputCol="features_kept", indices=keep)
    return sl.transform(tr).select("doc_id", F.size(vector_to_array("features_kept")).alias("n_kept"),
                                   F.lit(",".join(drop)).alias("dropped"))


@register("train_svm_rbf")
def q_train_svm_rbf(spark, d, n_components: int = 64, gamma: float = 0.1, seed: int = 42):
    """RBF-kernel SVM approximated by random Fourier features + LinearSVC (TRN4).
    The map z(x) = sqrt(2/D) cos(W x + b) runs as an Arrow pandas UDF; W is
    D x F (model-sized), shipped once per task."""
    import numpy as np
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from vitrine.plans.ml_queries import prepared
    pm, tr, te, _ = prepared(spark, d)
    n_feat = len(ML.feature_names(pm))
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, np.sqrt(2 * gamma), size=(n_feat, n_components))
    b = rng.uniform(0, 2 * np.pi, size=n_components)

    @F.pandas_udf("array<double>")
    def rff(col: pd.Series) -> pd.Series:
        X = np.vstack(col.to_numpy())
        Z = np.sqrt(2.0 / n_components) * np.cos(X @ W + b)
        return pd.Series(list(Z))

    def mapped(df):
        return df.withColumn("features", array_to_vector(rff(vector_to_array("features"))))
    model, metrics = ML.train_eval("svm_rbf", ML.LinearSVC(maxIter=50, regParam=0.01), mapped(tr), mapped(te))
    cols = sorted(metrics)
    return spark.createDataFrame([("svm_rbf", *[float(metrics[c]) for c in cols])],
                                 "model string, " + ", ".join(f"{c} double" for c in cols))
