"""Aggregations, profiles and monitoring (AGG*, MON*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.stopwords import stop_words
from vitrine.operators import monitor as M
from vitrine.operators import profile as P
from vitrine.plans.catalog import register
from vitrine.plans.sqlbits import q
from vitrine.sources import fixtures as FX


def _r6(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


NUM3 = ["price_numeric", "rating_numeric", "reviews_count"]


@register("agg_by_prediction", """SELECT prediction, count(*) AS n, round(avg(confidence_score), 6) AS avg_confidence
FROM classifications GROUP BY prediction""")
def q_agg_by_prediction(spark, d):
    return FX.classifications(spark, d).groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence_score"), 6).alias("avg_confidence"))


@register("table_counts", """
SELECT 'products' AS table_name, count(*) AS total, count_if(scraped_at >= (SELECT max(scraped_at) FROM products) - INTERVAL 24 HOUR) AS last_24h FROM products
UNION ALL SELECT 'classifications', count(*), count_if(classified_at >= (SELECT max(classified_at) FROM classifications) - INTERVAL 24 HOUR) FROM classifications
UNION ALL SELECT 'jobs', count(*), count_if(started_at >= (SELECT max(started_at) FROM jobs) - INTERVAL 24 HOUR) FROM jobs""")
def q_table_counts(spark, d):
    return M.table_counts({"products": FX.products(spark, d), "classifications": FX.classifications(spark, d),
                           "jobs": FX.jobs(spark, d)},
                          {"products": "scraped_at", "classifications": "classified_at", "jobs": "started_at"})


def _describe_sql(table, cols):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column, CAST(count({c}) AS DOUBLE) AS count, round(avg({x}), 6) AS mean, "
                     f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, round(quantile_cont({x}, 0.25), 6) AS q25, "
                     f"round(quantile_cont({x}, 0.5), 6) AS q50, round(quantile_cont({x}, 0.75), 6) AS q75, round(max({x}), 6) AS max FROM {table}")
    return " UNION ALL ".join(parts)


@register("describe_numeric", _describe_sql("products", NUM3))
def q_describe_numeric(spark, d):
    return _r6(P.describe(FX.products(spark, d, heavy=True), NUM3))


@register("class_balance", """
WITH c AS (SELECT target, count(*) AS n FROM labelled GROUP BY target)
SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS n_classes, arg_min(target, (n, target)) AS minority_class, arg_max(target, (n, target)) AS majority_class,
  min(n) AS minority_count, max(n) AS majority_count, round(min(n) / sum(n), 6) AS minority_ratio, round(max(n) / sum(n), 6) AS majority_ratio,
  round(max(n) / min(n), 6) AS imbalance_ratio, min(n) / sum(n) < 0.2 AS is_imbalanced FROM c""")
def q_class_balance(spark, d):
    return _r6(P.class_balance(FX.labelled(spark, d), "target", threshold=0.2))


def _hist_sql(table, col, bins):
    return f"""WITH x AS (SELECT CAST({col} AS DOUBLE) AS x FROM {table} WHERE {col} IS NOT NULL),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
h AS (SELECT CASE WHEN hi = lo THEN 0 ELSE CAST(least(floor((x - lo) / (hi - lo) * {bins}e0), {bins - 1}) AS INTEGER) END AS bin, lo, hi FROM x, b)
SELECT bin, count(*) AS count, round(min(lo) + bin * ((min(hi) - min(lo)) / {bins}e0), 6) AS bin_start,
  round(min(lo) + (bin + 1) * ((min(hi) - min(lo)) / {bins}e0), 6) AS bin_end FROM h GROUP BY bin"""


@register("price_histogram", _hist_sql("products", "price_numeric", 10))
def q_price_histogram(spark, d):
    return _r6(P.histogram(FX.products(spark, d), "price_numeric", 10))


@register("rating_counts", "SELECT rating_numeric, count(*) AS count FROM products GROUP BY rating_numeric")
def q_rating_counts(spark, d):
    """Data of the rating bar chart (AGG6)."""
    return FX.products(spark, d).groupBy("rating_numeric").agg(F.count(F.lit(1)).alias("count"))


@register("confidence_histogram", _hist_sql("classifications", "confidence_score", 20))
def q_confidence_histogram(spark, d):
    return _r6(P.histogram(FX.classifications(spark, d), "confidence_score", 20))


@register("confidence_summary", """SELECT round(avg(confidence_score), 6) AS mean, round(quantile_cont(confidence_score, 0.5), 6) AS median,
  round(stddev_pop(confidence_score), 6) AS std, round(min(confidence_score), 6) AS min, round(max(confidence_score), 6) AS max FROM classifications""")
def q_confidence_summary(spark, d):
    c = F.col("confidence_score")
    return _r6(FX.classifications(spark, d).agg(F.avg(c).alias("mean"), F.percentile(c, 0.5).alias("median"),
                                                F.stddev_pop(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max")))


@register("word_counts", """SELECT word, count(*) AS count FROM
  (SELECT unnest(regexp_extract_all(lower(description), '[\\p{L}\\p{N}_]+')) AS word FROM texts)
GROUP BY word ORDER BY count DESC, word LIMIT 20""")
def q_word_counts(spark, d):
    return P.word_counts(FX.texts(spark, d), "description", 20)


_SW = stop_words("portuguese")
_SW_SQL = "[" + ", ".join(q(w) for w in _SW) + "]"


#: Words that a cloud of words shows.
CLOUD_WORDS = 200


@register("word_frequencies", f"""WITH w AS (SELECT 'title' AS field, unnest(regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}_]+')) AS word FROM listings
  UNION ALL SELECT 'description', unnest(regexp_extract_all(lower(description), '[\\p{{L}}\\p{{N}}_]+')) FROM listings),
c AS (SELECT field, word, count(*) AS count FROM w WHERE NOT list_contains({_SW_SQL}, word) AND NOT regexp_full_match(word, '[0-9]+') GROUP BY ALL)
SELECT field, word, count FROM c QUALIFY row_number() OVER (PARTITION BY field ORDER BY count DESC, word) <= {CLOUD_WORDS}""")
def q_word_frequencies(spark, d):
    """The commonest words of titles and of descriptions without stop words (AGG9)."""
    x = FX.listings(spark, d, heavy=True)
    one = [P.word_counts(x, c, CLOUD_WORDS, _SW).select(F.lit(c).alias("field"), "word", "count") for c in ("title", "description")]
    return one[0].unionByName(one[1])


@register("bigram_counts", f"""WITH t AS (SELECT list_filter(string_split_regex(lower(coalesce(title, '')), '[\\s.,;:!?()\\[\\]"]+'),
    lambda w: regexp_full_match(w, '\\p{{L}}+') AND NOT list_contains({_SW_SQL}, w)) AS t FROM listings)
SELECT bigram, count(*) AS count FROM (SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS bigram
  FROM t WHERE len(t) >= 2) GROUP BY bigram ORDER BY count DESC, bigram LIMIT 10""")
def q_bigram_counts(spark, d):
    return P.bigram_counts(FX.listings(spark, d), "title", _SW, 10)


_PT_COLS = ["listing_id", "title", "description", "seller_name", "platform", "price", "rating_numeric", "reviews_count",
            "url", "scraped_at"]


@register("profile_table", "SELECT count(*) AS rows, " + str(len(_PT_COLS)) + " AS n_columns, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM listings)) AS duplicate_rows, "
          + " + ".join(f"count_if({c} IS NULL)" for c in _PT_COLS) + " AS total_nulls, 'shipping_info' AS errors, '' AS high_null_columns, "
          "count(*) > (SELECT count(*) FROM (SELECT DISTINCT * FROM listings)) AS has_duplicates FROM listings")
def q_profile_table(spark, d):
    return P.profile_table(FX.listings(spark, d), required=["title", "price", "url", "shipping_info"])


def _pf_sql(table, cols):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS feature, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
                     f"round(max({x}), 6) AS max, CAST(count_if({c} IS NULL OR isnan({x})) AS DOUBLE) AS nulls, "
                     f"CAST(count_if(abs({x}) = 'inf'::DOUBLE) AS DOUBLE) AS infinities, coalesce(stddev_samp({x}) = 0, false) AS zero_variance FROM {table}")
    return " UNION ALL ".join(parts)


@register("profile_features", _pf_sql("products", NUM3))
def q_profile_features(spark, d):
    return _r6(P.profile_features(FX.products(spark, d), NUM3))


@register("scoring_stats", """SELECT round(avg(processing_time_ms), 6) AS avg_time_ms, max(processing_time_ms) AS max_time_ms,
  min(processing_time_ms) AS min_time_ms, round(avg(confidence_score), 6) AS avg_confidence,
  round(avg(CAST(confidence_score < 0.7 AS DOUBLE)), 6) AS low_confidence_share, count(*) AS total,
  (SELECT string_agg(prediction || '=' || CAST(n AS VARCHAR), ',' ORDER BY prediction) FROM (SELECT prediction, count(*) AS n FROM classifications GROUP BY prediction)) AS by_prediction
FROM classifications""")
def q_scoring_stats(spark, d):
    s = M.scoring_stats(FX.classifications(spark, d))
    m = F.col("by_prediction")
    return _r6(s.withColumn("by_prediction", F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string"))), ",")))


@register("endpoint_stats", """SELECT endpoint, round(avg(latency_ms), 6) AS avg_latency_ms, max(latency_ms) AS max_latency_ms, count(*) AS requests,
  count_if(status_code >= 400) AS errors, round(count_if(status_code >= 400) / count(*), 6) AS error_rate FROM metrics_events GROUP BY endpoint""")
def q_endpoint_stats(spark, d):
    return _r6(M.endpoint_stats(FX.metrics_events(spark, d)))


_SUCC = "coalesce(CAST(products_processed AS DOUBLE) / CAST(nullif(products_found, 0) AS DOUBLE), 0e0)"
_DUR = "(epoch_us(completed_at) - epoch_us(started_at)) / 1e6"


@register("job_stats", f"""SELECT round(avg({_DUR}), 6) AS avg_duration_s, round(max({_DUR}), 6) AS max_duration_s,
  round(avg({_SUCC}), 6) AS avg_success_rate, count(*) AS jobs FROM jobs""")
def q_job_stats(spark, d):
    return _r6(M.job_stats(FX.jobs(spark, d)))


@register("job_success_rate", f"""SELECT id, round({_SUCC}, 6) AS success_rate, {_SUCC} < 0.8 AS alert FROM jobs""")
def q_job_success_rate(spark, d):
    j = FX.jobs(spark, d)
    r = M.job_success_rate(j)
    return j.select("id", F.round(r, 6).alias("success_rate"), (r < 0.8).alias("alert"))


@register("confidence_stats", """SELECT round(avg(confidence_score), 6) AS mean_confidence, round(stddev_pop(confidence_score), 6) AS std_confidence,
  round(min(confidence_score), 6) AS min_confidence, round(max(confidence_score), 6) AS max_confidence,
  round(avg(CAST(prediction IS NOT NULL AS DOUBLE)), 6) AS success_rate, count(*) AS n FROM classifications""")
def q_confidence_stats(spark, d):
    return _r6(M.confidence_stats(FX.classifications(spark, d)))


@register("feature_patterns", """SELECT feature, round(avg(importance), 6) AS mean, round(stddev_pop(importance), 6) AS std,
  round(1 - stddev_pop(importance) / avg(importance), 6) AS consistency, count(*) AS mentions,
  CAST(row_number() OVER (ORDER BY avg(importance) DESC, feature) AS INTEGER) AS rank_by_mean,
  CAST(row_number() OVER (ORDER BY 1 - stddev_pop(importance) / avg(importance) DESC, feature) AS INTEGER) AS rank_by_consistency
FROM importance WHERE method = 'impurity' GROUP BY feature""")
def q_feature_patterns(spark, d):
    """By feature over models: mean, std (n), consistency, mentions, ranks (AGG18).
    The rank windows run over one row per feature (bounded by the feature count)."""
    from pyspark.sql import Window
    g = FX.importance(spark, d).where(F.col("method") == "impurity").groupBy("feature").agg(
        F.avg("importance").alias("mean"), F.stddev_pop("importance").alias("std"), F.count(F.lit(1)).alias("mentions"))
    g = g.withColumn("consistency", 1 - F.col("std") / F.col("mean"))
    g = g.withColumns({"rank_by_mean": F.row_number().over(Window.orderBy(F.col("mean").desc(), "feature")),
                       "rank_by_consistency": F.row_number().over(Window.orderBy(F.col("consistency").desc(), "feature"))})
    return _r6(g)


@register("corr_numeric", """WITH x AS (SELECT CAST(price_numeric AS DOUBLE) AS price_numeric, CAST(rating_numeric AS DOUBLE) AS rating_numeric,
  CAST(reviews_count AS DOUBLE) AS reviews_count FROM products WHERE price_numeric IS NOT NULL AND rating_numeric IS NOT NULL AND reviews_count IS NOT NULL)
""" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round({'max(1e0)' if a == b else f'corr({a}, {b})'}, 6) AS correlation FROM x"
    for a in NUM3 for b in NUM3))
def q_corr_numeric(spark, d):
    return _r6(P.corr_matrix_long(FX.products(spark, d), NUM3))


FOLD_ACC = "(SELECT model, fold, score FROM cv_scores WHERE side = 'test' AND metric = 'accuracy')"


def _fold_acc(spark, d):
    return FX.cv_scores(spark, d).where((F.col("side") == "test") & (F.col("metric") == "accuracy"))


@register("fold_summary", f"""SELECT model, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, round(min(score), 6) AS min,
  round(max(score), 6) AS max, count(*) AS n FROM {FOLD_ACC} GROUP BY model""")
def q_fold_summary(spark, d):
    return _r6(P.group_moments(_fold_acc(spark, d), ["model"], "score"))


@register("perf_variance", f"SELECT round(avg(v), 6) AS mean_fold_variance FROM (SELECT model, var_pop(score) AS v FROM {FOLD_ACC} GROUP BY model)")
def q_perf_variance(spark, d):
    return _r6(_fold_acc(spark, d).groupBy("model").agg(F.var_pop("score").alias("v")).agg(F.avg("v").alias("mean_fold_variance")))


@register("accuracy_interval", f"""SELECT arg_max(model, (m, model)) AS best_model, round(max(m), 6) AS accuracy,
  round(arg_max(m - 1.96 * s, (m, model)), 6) AS lower, round(arg_max(m + 1.96 * s, (m, model)), 6) AS upper
FROM (SELECT model, avg(score) AS m, stddev_pop(score) AS s FROM {FOLD_ACC} GROUP BY model)""")
def q_accuracy_interval(spark, d):
    g = P.group_moments(_fold_acc(spark, d), ["model"], "score")
    key = F.struct("mean", "model")
    return _r6(g.agg(F.max_by("model", key).alias("best_model"), F.max("mean").alias("accuracy"),
                     F.max_by(F.col("mean") - 1.96 * F.col("std"), key).alias("lower"),
                     F.max_by(F.col("mean") + 1.96 * F.col("std"), key).alias("upper")))


@register("key_metrics", """WITH m AS (SELECT model, metric, avg(score) AS v FROM cv_scores WHERE side = 'test' GROUP BY model, metric),
w AS (SELECT model, max(CASE WHEN metric = 'accuracy' THEN v END) AS accuracy, max(CASE WHEN metric = 'precision' THEN v END) AS precision,
  max(CASE WHEN metric = 'recall' THEN v END) AS recall, max(CASE WHEN metric = 'f1_score' THEN v END) AS f1_score FROM m GROUP BY model)
SELECT arg_max(model, (f1_score, model)) AS best_model, round(arg_max(accuracy, (f1_score, model)) * 100, 1) AS accuracy_pct,
  round(arg_max(precision, (f1_score, model)) * 100, 1) AS precision_pct, round(arg_max(recall, (f1_score, model)) * 100, 1) AS recall_pct,
  round(max(f1_score) * 100, 1) AS f1_pct FROM w""")
def q_key_metrics(spark, d):
    """Best model's metrics as rounded percentages (AGG24)."""
    cv = FX.cv_scores(spark, d).where(F.col("side") == "test")
    w = cv.groupBy("model").pivot("metric", ["accuracy", "precision", "recall", "f1_score"]).agg(F.avg("score"))
    key = F.struct("f1_score", "model")
    return w.agg(F.max_by("model", key).alias("best_model"),
                 *[F.round(F.max_by(m, key) * 100, 1).alias(f"{m}_pct") for m in ("accuracy", "precision", "recall")],
                 F.round(F.max("f1_score") * 100, 1).alias("f1_pct"))


# -------------------------------------------------------------- monitoring --
_CLS_RECENT = "classified_at >= (SELECT max(classified_at) FROM classifications) - INTERVAL 24 HOUR"


@register("scoring_health", f"""WITH s AS (SELECT count(*) AS n_recent, avg(nullif(processing_time_ms, 0)) AS a, max(processing_time_ms) AS mx,
  avg(nullif(confidence_score, 0)) AS c, avg(CASE WHEN confidence_score <> 0 THEN CAST(confidence_score < 0.7 AS DOUBLE) END) AS low
  FROM classifications WHERE {_CLS_RECENT})
SELECT n_recent, round(a, 6) AS avg_processing_time_ms, mx AS max_processing_time_ms, round(c, 6) AS avg_confidence_score,
  round(low, 6) AS low_confidence_rate,
  concat_ws('; ', CASE WHEN n_recent = 0 THEN 'No recent classifications' END, CASE WHEN a > 5000 THEN 'ML processing is slow' END,
    CASE WHEN low > 0.5 THEN 'High rate of low confidence predictions' END) AS alerts,
  CASE WHEN n_recent = 0 OR a > 5000 OR low > 0.5 THEN 'degraded' ELSE 'healthy' END AS status FROM s""")
def q_scoring_health(spark, d):
    return _r6(M.scoring_health(FX.classifications(spark, d)))


@register("job_health", f"""WITH r AS (SELECT * FROM jobs ORDER BY started_at DESC, id DESC LIMIT 5),
s AS (SELECT count(*) AS recent_jobs, avg(CAST(status = 'completed' AS DOUBLE)) AS success_rate, avg({_SUCC}) AS avg_processing_rate,
  avg({_DUR}) AS avg_duration_s FROM r),
t AS (SELECT count_if(status = 'running' AND started_at < (SELECT max(started_at) FROM jobs) - INTERVAL 2 HOUR) AS stuck_jobs,
  (epoch_us((SELECT max(started_at) FROM jobs)) - epoch_us(max(CASE WHEN status = 'completed' THEN completed_at END))) / 1e6 / 3600e0 AS hours_since_success FROM jobs)
SELECT recent_jobs, round(success_rate, 6) AS success_rate, round(avg_processing_rate, 6) AS avg_processing_rate,
  round(avg_duration_s, 6) AS avg_duration_s, stuck_jobs, round(hours_since_success, 6) AS hours_since_success,
  concat_ws('; ', CASE WHEN success_rate < 0.8 THEN 'Low scraper success rate' END, CASE WHEN stuck_jobs > 0 THEN 'Jobs running too long' END,
    CASE WHEN hours_since_success > 24 THEN 'No successful job recently' END) AS alerts FROM s, t""")
def q_job_health(spark, d):
    return _r6(M.job_health(FX.jobs(spark, d)))


@register("throughput", f"""SELECT count(*) AS total_classifications,
  round((epoch_us((SELECT max(classified_at) FROM classifications)) - epoch_us(min(classified_at))) / 1e6 / 3600e0, 6) AS uptime_hours,
  round(count_if({_CLS_RECENT}) / 24e0, 6) AS per_hour_24h,
  round(avg(CASE WHEN {_CLS_RECENT} THEN CAST(confidence_score > 0.8 AS DOUBLE) END), 6) AS high_confidence_share FROM classifications""")
def q_throughput(spark, d):
    return _r6(M.throughput(FX.classifications(spark, d)))


@register("history_jobs", f"""SELECT id, started_at, round({_DUR}, 6) AS duration_s, round({_SUCC}, 6) AS success_rate FROM jobs
WHERE started_at >= (SELECT max(started_at) FROM jobs) - INTERVAL 720 HOUR""")
def q_history_jobs(spark, d):
    """Job rows of the last N hours with duration and success rate (MON5)."""
    j = FX.jobs(spark, d)
    return _r6(j.where(M.since("started_at", M.max_ts(j, "started_at"), 720)).select(
        "id", "started_at", M.seconds_between(F.col("started_at"), F.col("completed_at")).alias("duration_s"),
        M.job_success_rate(j).alias("success_rate")))


@register("history_scoring", f"""SELECT id, classified_at, processing_time_ms, round(confidence_score, 6) AS confidence_score FROM classifications
WHERE {_CLS_RECENT}""")
def q_history_scoring(spark, d):
    c = FX.classifications(spark, d)
    return _r6(c.where(M.since("classified_at", M.max_ts(c, "classified_at"), 24)).select(
        "id", "classified_at", "processing_time_ms", "confidence_score"))


_THRESH = [("avg_latency_ms", 50.0, "above"), ("error_rate", 0.12, "above"), ("requests", 1990.0, "below")]


@register("threshold_alerts", """WITH s AS (SELECT endpoint, avg(latency_ms) AS avg_latency_ms, CAST(count_if(status_code >= 400) AS DOUBLE) / count(*) AS error_rate,
  CAST(count(*) AS DOUBLE) AS requests FROM metrics_events GROUP BY endpoint),
l AS (SELECT endpoint, 'avg_latency_ms' AS metric, avg_latency_ms AS value FROM s UNION ALL SELECT endpoint, 'error_rate', error_rate FROM s
  UNION ALL SELECT endpoint, 'requests', requests FROM s),
t AS (SELECT * FROM (VALUES ('avg_latency_ms', 50e0, 'above'), ('error_rate', 0.12e0, 'above'), ('requests', 1990e0, 'below')) t(metric, threshold, direction))
SELECT l.endpoint, l.metric, round(l.value, 6) AS value, t.threshold, t.direction FROM l JOIN t ON l.metric = t.metric
WHERE CASE WHEN t.direction = 'above' THEN l.value > t.threshold ELSE l.value < t.threshold END""")
def q_threshold_alerts(spark, d):
    s = M.endpoint_stats(FX.metrics_events(spark, d))
    long = s.select("endpoint", F.stack(F.lit(3), F.lit("avg_latency_ms"), F.col("avg_latency_ms"),
                                        F.lit("error_rate"), F.col("error_rate"),
                                        F.lit("requests"), F.col("requests").cast("double")).alias("metric", "value"))
    th = spark.createDataFrame(_THRESH, "metric string, threshold double, direction string")
    j = long.join(F.broadcast(th), "metric")
    fire = F.when(F.col("direction") == "above", F.col("value") > F.col("threshold")).otherwise(F.col("value") < F.col("threshold"))
    return j.where(fire).select("endpoint", "metric", F.round("value", 6).alias("value"), "threshold", "direction")


@register("overall_status", """WITH c AS (SELECT CAST(ts AS DATE) AS day, endpoint AS component,
  CASE WHEN avg(CAST(status_code >= 400 AS DOUBLE)) > 0.16 THEN 'unhealthy' WHEN avg(CAST(status_code >= 400 AS DOUBLE)) > 0.12 THEN 'degraded'
  ELSE 'healthy' END AS status FROM metrics_events GROUP BY 1, 2)
SELECT day, CASE WHEN bool_and(status = 'healthy') THEN 'healthy' WHEN bool_or(status = 'healthy') THEN 'degraded' ELSE 'unhealthy' END AS overall_status,
  coalesce(array_to_string(list_sort(list_distinct(list(CASE WHEN status <> 'healthy' THEN component || ': ' || status END))), '; '), '') AS alerts
FROM c GROUP BY day""")
def q_overall_status(spark, d):
    ev = FX.metrics_events(spark, d)
    err = F.avg((F.col("status_code") >= 400).cast("double"))
    comp = ev.groupBy(F.to_date("ts").alias("day"), F.col("endpoint").alias("component")).agg(
        F.when(err > 0.16, F.lit("unhealthy")).when(err > 0.12, F.lit("degraded")).otherwise(F.lit("healthy")).alias("status"))
    return M.overall_status(comp, ["day"])
