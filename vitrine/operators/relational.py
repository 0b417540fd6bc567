"""Joins, set operations, ranking windows and dedup (JOIN*, SET*, WIN*).

Scale notes
* Equi joins are left to the planner: AQE turns a side into a broadcast only
  when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``,
  and splits skewed partitions of a sort-merge join. We hint ``broadcast``
  only for sides whose size is fixed by construction (1-row scalars, config).
* "Latest row per key" and "first row per key" are aggregations of a struct
  (``max_by``/``min``), so they combine map-side: a key holding a third of all
  rows costs one partial aggregate per task, not one giant task.
* Pairs of models are never materialised by a self join; the per-model values
  are pivoted into columns of one row per feature/fold and compared there.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# ----------------------------------------------------------------- joins --

def listing_join(products: DataFrame, classifications: DataFrame) -> DataFrame:
    """products x classifications on id = product_id (JOIN1)."""
    c = classifications.withColumnRenamed("id", "classification_id")
    return products.join(c, products["id"] == c["product_id"], "inner").drop("product_id")


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` per key, deterministic on ties
    (the order columns should end with a unique id). Partial aggregation
    before the shuffle keeps hot keys cheap."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c).alias("__" + c) for c in rest])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_latest"))
    return agg.select(*keys, *[F.col("_latest.__" + c).alias(c) for c in rest])


def first_per_key(df: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """First row per key by ``seq`` (WIN2): min of a struct led by seq."""
    rest = [c for c in df.columns if c not in key and c != seq]
    packed = F.struct(F.col(seq), *[F.col(c).alias("__" + c) for c in rest])
    agg = df.groupBy(*key).agg(F.min(packed).alias("_first"))
    return agg.select(*key, F.col("_first." + seq).alias(seq), *[F.col("_first.__" + c).alias(c) for c in rest])


def detail_latest(products: DataFrame, classifications: DataFrame) -> DataFrame:
    """Each product with its newest classification (JOIN2), ties by id."""
    latest = latest_per_key(classifications.withColumnRenamed("id", "classification_id"),
                            "product_id", ["classified_at", "classification_id"])
    return products.join(latest, products["id"] == latest["product_id"], "inner").drop("product_id")


def unscored(products: DataFrame, classifications: DataFrame, since: Column | None = None) -> DataFrame:
    """Products with no classification, optionally scraped at or after ``since`` (JOIN3)."""
    p = products if since is None else products.where(F.col("scraped_at") >= since)
    return p.join(classifications.select(F.col("product_id").alias("id")).distinct(), "id", "left_anti")


def integrity_counts(products: DataFrame, classifications: DataFrame) -> DataFrame:
    """Orphans both ways and totals (JOIN4) with ONE full outer join of the key
    sets: classifications are pre-counted per product_id first."""
    per = classifications.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_cls"))
    ids = products.select(F.col("id").alias("product_id"), F.lit(1).alias("has_product"))
    j = ids.join(per, "product_id", "full_outer")
    return j.agg(
        F.coalesce(F.sum(F.when(F.col("has_product").isNull(), F.col("n_cls"))), F.lit(0)).alias("orphan_classifications"),
        F.count_if(F.col("n_cls").isNull()).alias("products_without_classification"),
        F.count_if(F.col("has_product").isNotNull()).alias("total_products"),
        F.coalesce(F.sum("n_cls"), F.lit(0)).alias("total_classifications"))


def new_not_duplicate(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``batch`` matching no stored row by url, nor by (title, seller) (JOIN5).
    Two equi anti joins instead of an OR join (which would be a nested loop)."""
    by_url = batch.join(stored.select("url").where(F.col("url") != "").distinct(), "url", "left_anti")
    return by_url.join(stored.select("title", "seller_name").distinct(), ["title", "seller_name"], "left_anti")


def semi_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """``key IN (ids)`` as a left semi join (JOIN6)."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(key)).distinct(), key, "left_semi")


def pivot_by(df: DataFrame, row_keys: Sequence[str], pivot_col: str, value_col: str,
             values: Sequence[str]) -> DataFrame:
    return df.groupBy(*row_keys).pivot(pivot_col, list(values)).agg(F.first(value_col))


def distinct_values(df: DataFrame, col: str) -> list:
    """Small metadata list (model names); bounded by the experiment, not the data."""
    return sorted(r[0] for r in df.select(col).distinct().collect())


def model_similarity(importance: DataFrame, models: Sequence[str] | None = None) -> DataFrame:
    """Pearson r of importances for every model pair over shared features (JOIN7)."""
    models = list(models or distinct_values(importance, "model"))
    wide = pivot_by(importance, ["feature"], "model", "importance", models)
    pairs = [(a, b) for i, a in enumerate(models) for b in models[i + 1:]]
    if not pairs:
        return importance.sparkSession.createDataFrame([], "model_a string, model_b string, correlation double, n_features long")
    aggs = []
    for a, b in pairs:
        both = F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNotNull()
        aggs += [F.corr(F.when(both, F.col(f"`{a}`")), F.when(both, F.col(f"`{b}`"))).alias(f"r|{a}|{b}"),
                 F.count_if(both).alias(f"n|{a}|{b}")]
    one = wide.agg(*aggs)
    stack = F.stack(F.lit(len(pairs)), *[x for a, b in pairs for x in
                                        (F.lit(a), F.lit(b), F.col(f"`r|{a}|{b}`"), F.col(f"`n|{a}|{b}`"))])
    return one.select(stack.alias("model_a", "model_b", "correlation", "n_features"))


def rank_within(df: DataFrame, part: Sequence[str], value: str, tie: str) -> Column:
    return F.row_number().over(Window.partitionBy(*part).orderBy(F.col(value).desc(), F.col(tie)))


def importance_compare(importance: DataFrame, top_n: int = 20) -> DataFrame:
    """Average importance and rank over models; a model lacking a feature
    counts importance 0 and rank n_model + 1 (JOIN8). No features x models
    cross join: absent terms are added from per-model totals."""
    ranked = importance.withColumn("rank", rank_within(importance, ["model"], "importance", "feature"))
    per_model = importance.groupBy("model").agg(F.count(F.lit(1)).alias("n_model"))
    totals = per_model.agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("n_model") + 1).alias("all_absent_rank"))
    j = ranked.join(F.broadcast(per_model), "model")  # one row per model: fixed small size
    g = j.groupBy("feature").agg(F.sum("importance").alias("s_imp"), F.sum("rank").alias("s_rank"),
                                 F.sum(F.col("n_model") + 1).alias("present_absent_rank"))
    from vitrine.functions.partitioning import with_scalars
    g = with_scalars(g, totals)
    out = g.select("feature", (F.col("s_imp") / F.col("m")).alias("avg_importance"),
                   ((F.col("s_rank") + F.col("all_absent_rank") - F.col("present_absent_rank")) / F.col("m"))
                   .alias("avg_rank"))
    return out.orderBy(F.col("avg_importance").desc(), F.col("feature")).limit(top_n)


def version_diff(versions: DataFrame, model: str, v1: str, v2: str) -> DataFrame:
    """Common metrics of two versions of a model (JOIN9)."""
    a = versions.where((F.col("model") == model) & (F.col("version") == v1)).select(
        "model", "metric", F.col("value").alias("value_1"), F.col("created_at").alias("created_1"))
    b = versions.where((F.col("model") == model) & (F.col("version") == v2)).select(
        "model", "metric", F.col("value").alias("value_2"), F.col("created_at").alias("created_2"))
    j = a.join(b, ["model", "metric"])
    from vitrine.functions.partitioning import seconds_between_ntz
    return j.select("model", "metric", "value_1", "value_2",
                    (F.col("value_2") - F.col("value_1")).alias("difference"),
                    (F.col("value_2") > F.col("value_1")).alias("improved"),
                    seconds_between_ntz(F.col("created_1"), F.col("created_2")).alias("seconds_between"))


def apply_code_map(df: DataFrame, col: str, code_map: DataFrame, code_col: str, default) -> DataFrame:
    """Map a value to its fitted code; unseen -> default (JOIN11). The map is
    joined normally: AQE broadcasts it when it is measured small."""
    m = code_map.select(F.col(col).alias("__k"), F.col(code_col).alias("__v"))
    j = df.join(m, df[col] == m["__k"], "left")
    return j.withColumn(code_col, F.coalesce(F.col("__v"), F.lit(default))).drop("__k", "__v")


# ----------------------------------------------------------- set ops / dedup --

def union_sources(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project both sources to the shared columns (absent = null) and append (SET1)."""
    def proj(d):
        return d.select(*[(F.col(c) if c in d.columns else F.lit(None).cast("string")).alias(c) for c in columns])
    return proj(a).unionByName(proj(b))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (WIN1)."""
    return df.dropDuplicates()


def schema_check(actual: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected-minus-actual = issues, actual-minus-expected = warnings, columns
    with nulls = warnings (SET2); one aggregate pass for the null counts."""
    exp = F.array(*[F.lit(c) for c in expected])
    act = F.array(*[F.lit(c) for c in actual.columns])
    nulls = actual.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in actual.columns])
    null_cols = F.array_compact(F.array(*[F.when(F.col(f"`{c}`") > 0, F.lit(c)) for c in actual.columns]))
    return nulls.select(
        F.array_sort(F.array_except(exp, act)).alias("missing_features"),
        F.array_sort(F.array_except(act, exp)).alias("extra_features"),
        null_cols.alias("columns_with_nulls"),
        (F.lit(len(set(expected))) != F.lit(len(actual.columns))).alias("count_mismatch"))


# --------------------------------------------------------------- windows --

def paginate(df: DataFrame, order: Sequence[Column], page: int, per_page: int, max_per_page: int = 100):
    """(rows, meta) of one page; meta holds total, pages, has_next, has_prev (WIN3)."""
    page = max(1, int(page))
    per_page = max(1, min(int(per_page), max_per_page))
    rows = df.orderBy(*order).offset((page - 1) * per_page).limit(per_page)
    meta = df.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.lit(page).alias("page"), F.lit(per_page).alias("per_page"),
        F.ceil(F.col("total") / per_page).cast("long").alias("pages"),
        (F.lit(page) < F.ceil(F.col("total") / per_page)).alias("has_next"),
        F.lit(page > 1).alias("has_prev"))
    return rows, meta


def importance_rank(importance: DataFrame, part: Sequence[str] = ("model", "method")) -> DataFrame:
    """Rank, percent of total and running cumulative percent per model (WIN5).
    Partitions hold one model's features: bounded by the feature count."""
    w = Window.partitionBy(*part)
    wo = w.orderBy(F.col("importance").desc(), F.col("feature"))
    total = F.sum("importance").over(w)
    pct = F.col("importance") / F.nullif(total, F.lit(0.0)) * 100
    return importance.select(
        *importance.columns, F.row_number().over(wo).alias("rank"), pct.alias("importance_pct"),
        (F.sum("importance").over(wo.rowsBetween(Window.unboundedPreceding, 0)) /
         F.nullif(total, F.lit(0.0)) * 100).alias("cumulative_pct"))


def importance_select(ranked: DataFrame, threshold: float | None = None, top_n: int | None = None,
                      cumulative_pct: float | None = 95.0) -> DataFrame:
    """Keep features by threshold, top N, or cumulative percent (WIN6)."""
    if threshold is not None:
        return ranked.where(F.col("importance") >= threshold)
    if top_n is not None:
        return ranked.where(F.col("rank") <= top_n)
    return ranked.where(F.col("cumulative_pct") <= cumulative_pct)


def importance_summary(ranked: DataFrame, threshold: float = 0.01,
                       part: Sequence[str] = ("model", "method")) -> DataFrame:
    """Counts over threshold, spread, top feature, features within 80 % (WIN7)."""
    return ranked.groupBy(*part).agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if(F.col("importance") >= threshold).alias("n_above_threshold"),
        F.max("importance").alias("max_importance"), F.min("importance").alias("min_importance"),
        F.avg("importance").alias("mean_importance"), F.stddev_samp("importance").alias("std_importance"),
        F.min_by("feature", "rank").alias("top_feature"),
        F.count_if(F.col("cumulative_pct") <= 80).alias("n_features_80pct"))


def semver_key(version: Column) -> Column:
    parts = F.split(F.regexp_replace(version, r"^v", ""), r"\.")
    return F.struct(*[F.coalesce(F.get(parts, i).try_cast("int"), F.lit(0)).alias(f"p{i}") for i in range(3)])


def version_order(versions: DataFrame) -> DataFrame:
    """Versions of each model in semantic-version order, latest flagged (WIN16)."""
    v = versions.select("model", "version", "created_at").distinct()
    w = Window.partitionBy("model").orderBy(semver_key(F.col("version")))
    wd = Window.partitionBy("model").orderBy(semver_key(F.col("version")).desc())
    return v.select("model", "version", "created_at", F.row_number().over(w).alias("position"),
                    (F.row_number().over(wd) == 1).alias("is_latest"))


def version_history(versions: DataFrame) -> DataFrame:
    """Per (model, metric): best, worst, latest, first, trend and rate (WIN11)."""
    g = versions.groupBy("model", "metric").agg(
        F.max("value").alias("best"), F.min("value").alias("worst"),
        F.max_by("value", F.struct("created_at", "version")).alias("latest"),
        F.min_by("value", F.struct("created_at", "version")).alias("first"),
        F.count(F.lit(1)).alias("n_versions"))
    return g.withColumns({"improving": F.col("latest") > F.col("first"),
                          "rate": (F.col("latest") - F.col("first")) / F.col("n_versions")})


def last_n(df: DataFrame, part: Sequence[str], ts: str, n: int, tie: str) -> DataFrame:
    """The newest n rows per key (WIN12); planned with a partial window-group
    limit before the shuffle, so each task ships at most n rows per key."""
    w = Window.partitionBy(*part).orderBy(F.col(ts).desc(), F.col(tie).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
