"""Joins, set operations, windows, filters over the service tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine import config as C
from vitrine.operators import clean as CL
from vitrine.operators import relational as R
from vitrine.plans.catalog import register
from vitrine.sources import fixtures as FX


def _p(spark, d):
    return FX.products(spark, d)


def _c(spark, d):
    return FX.classifications(spark, d)


JOIN1_SQL = """SELECT p.id, p.title, p.price_numeric, p.scraped_at, c.id AS classification_id, c.prediction,
  c.confidence_score, c.classified_at FROM products p JOIN classifications c ON p.id = c.product_id"""


@register("join_listing", JOIN1_SQL)
def q_join_listing(spark, d):
    j = R.listing_join(_p(spark, d), _c(spark, d))
    return j.select("id", "title", "price_numeric", "scraped_at", "classification_id", "prediction",
                    "confidence_score", "classified_at")


@register("listing_filter", "SELECT * FROM (" + JOIN1_SQL + """) j
WHERE prediction = 'original' AND confidence_score >= 0.5e0
  AND scraped_at >= TIMESTAMP '1995-01-01 00:00:00' AND scraped_at <= TIMESTAMP '1997-12-31 00:00:00'""")
def q_listing_filter(spark, d):
    return CL.listing_filter(q_join_listing(spark, d), prediction="original", min_confidence=0.5,
                             date_from="1995-01-01 00:00:00", date_to="1997-12-31 00:00:00")


@register("join_latest_detail", """
WITH r AS (SELECT c.*, row_number() OVER (PARTITION BY product_id ORDER BY classified_at DESC, id DESC) AS rn
           FROM classifications c)
SELECT p.id, p.title, p.seller_name, r.id AS classification_id, r.prediction, r.confidence_score, r.classified_at
FROM products p JOIN r ON p.id = r.product_id WHERE r.rn = 1""")
def q_join_latest_detail(spark, d):
    j = R.detail_latest(_p(spark, d), _c(spark, d))
    return j.select("id", "title", "seller_name", "classification_id", "prediction", "confidence_score", "classified_at")


@register("anti_unscored", """
SELECT p.id, p.title, p.scraped_at FROM products p
WHERE NOT EXISTS (SELECT 1 FROM classifications c WHERE c.product_id = p.id)
  AND p.scraped_at >= (SELECT max(started_at) FROM jobs WHERE status = 'failed') - INTERVAL 1000 DAY""")
def q_anti_unscored(spark, d):
    jobs = FX.jobs(spark, d)
    since = F.timestamp_add("DAY", F.lit(-1000), jobs.where(F.col("status") == "failed").agg(F.max("started_at")).scalar())
    return R.unscored(_p(spark, d), _c(spark, d), since).select("id", "title", "scraped_at")


@register("integrity_counts", """
SELECT (SELECT count(*) FROM classifications c WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.id = c.product_id)) AS orphan_classifications,
  (SELECT count(*) FROM products p WHERE NOT EXISTS (SELECT 1 FROM classifications c WHERE c.product_id = p.id)) AS products_without_classification,
  (SELECT count(*) FROM products) AS total_products, (SELECT count(*) FROM classifications) AS total_classifications""")
def q_integrity_counts(spark, d):
    return R.integrity_counts(_p(spark, d), _c(spark, d))


@register("integrity_status", """
WITH x AS (SELECT (SELECT count(*) FROM classifications c WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.id = c.product_id)) AS o,
  (SELECT count(*) FROM products) AS tp)
SELECT CASE WHEN o > 0 THEN 'degraded' ELSE 'healthy' END AS status,
  CASE WHEN o > 0 THEN 'Found ' || CAST(o AS VARCHAR) || ' orphaned classifications' ELSE '' END AS alerts, tp AS total_products FROM x""")
def q_integrity_status(spark, d):
    """Status and alert text from the integrity counts (MON1)."""
    ic = R.integrity_counts(_p(spark, d), _c(spark, d))
    o = F.col("orphan_classifications")
    return ic.select(F.when(o > 0, F.lit("degraded")).otherwise(F.lit("healthy")).alias("status"),
                     F.when(o > 0, F.concat(F.lit("Found "), o.cast("string"), F.lit(" orphaned classifications")))
                     .otherwise(F.lit("")).alias("alerts"), "total_products")


@register("anti_duplicates", """
WITH u AS (SELECT listing_id, title, seller_name, url FROM crawl b WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.url <> '' AND p.url = b.url))
SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.title = u.title AND p.seller_name = u.seller_name)""")
def q_anti_duplicates(spark, d):
    """A second crawl of all listings without what the stored table has by url or by title and seller (JOIN5)."""
    return R.new_not_duplicate(FX.crawl(spark, d).select("listing_id", "title", "seller_name", "url"), _p(spark, d))


@register("semi_ids", """
SELECT p.id, p.title FROM products p WHERE p.id IN (SELECT product_id FROM classifications WHERE confidence_score >= 0.99e0)""")
def q_semi_ids(spark, d):
    ids = _c(spark, d).where(F.col("confidence_score") >= 0.99).select("product_id")
    return R.semi_ids(_p(spark, d), ids).select("id", "title")


@register("model_similarity", """
SELECT a.model AS model_a, b.model AS model_b, corr(a.importance, b.importance) AS correlation, count(*) AS n_features
FROM importance a JOIN importance b ON a.feature = b.feature AND a.method = b.method AND a.model < b.model
WHERE a.method = 'impurity' GROUP BY a.model, b.model""")
def q_model_similarity(spark, d):
    imp = FX.importance(spark, d).where(F.col("method") == "impurity")
    r = R.model_similarity(imp)
    return r.withColumn("correlation", F.round("correlation", 6))


@register("importance_compare", """
WITH r AS (SELECT model, feature, importance, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS rk,
             count(*) OVER (PARTITION BY model) AS n_model FROM importance WHERE method = 'permutation'),
m AS (SELECT DISTINCT model, n_model FROM r), f AS (SELECT DISTINCT feature FROM r),
g AS (SELECT f.feature, m.model, coalesce(r.importance, 0e0) AS imp, coalesce(r.rk, m.n_model + 1) AS rk
      FROM f CROSS JOIN m LEFT JOIN r ON r.feature = f.feature AND r.model = m.model)
SELECT feature, avg(imp) AS avg_importance, avg(rk) AS avg_rank FROM g GROUP BY feature
ORDER BY avg_importance DESC, feature LIMIT 20""")
def q_importance_compare(spark, d):
    imp = FX.importance(spark, d).where(F.col("method") == "permutation").drop("method")
    return R.importance_compare(imp, top_n=20)


@register("version_diff", """
WITH a AS (SELECT * FROM versions WHERE model = 'click' AND version = '1.3.0'),
b AS (SELECT * FROM versions WHERE model = 'click' AND version = '1.12.0')
SELECT a.model, a.metric, a.value AS value_1, b.value AS value_2, b.value - a.value AS difference,
  b.value > a.value AS improved, (epoch_us(b.created_at) - epoch_us(a.created_at)) / 1e6 AS seconds_between
FROM a JOIN b ON a.model = b.model AND a.metric = b.metric""")
def q_version_diff(spark, d):
    return R.version_diff(FX.versions(spark, d), "click", "1.3.0", "1.12.0")


@register("unseen_categories", """
WITH tr AS (SELECT * FROM labelled WHERE doc_id % 4 <> 0), te AS (SELECT * FROM labelled WHERE doc_id % 4 = 0),
codes AS (SELECT seller_name, CAST(dense_rank() OVER (ORDER BY seller_name) - 1 AS INTEGER) AS label_code
          FROM (SELECT DISTINCT seller_name FROM tr WHERE seller_name <> 'src3'))
SELECT te.doc_id, te.seller_name, coalesce(codes.label_code, -1) AS label_code FROM te LEFT JOIN codes ON te.seller_name = codes.seller_name""")
def q_unseen_categories(spark, d):
    from vitrine.operators import category as CT
    lab = FX.labelled(spark, d)
    train = lab.where((F.col("doc_id") % 4 != 0) & (F.col("seller_name") != "src3"))
    test = lab.where(F.col("doc_id") % 4 == 0)
    codes = CT.fit_label_codes(train, "seller_name")
    return R.apply_code_map(test.select("doc_id", "seller_name"), "seller_name", codes, "label_code", -1)


# --------------------------------------------------------- set ops / dedup --
def _sources(spark, d):
    lst = FX.listings(spark, d)
    a = lst.where(F.col("platform") == "mercadolivre").select(
        "listing_id", "title", "price", "seller_name", F.lit("MercadoLíder").alias("seller_reputation"),
        "reviews_count", F.col("rating_numeric").alias("rating"), "url", "platform", "description", "scraped_at")
    b = lst.where(F.col("platform") == "americanas").select(
        "listing_id", "title", "price", "seller_name", "reviews_count", F.col("rating_numeric").alias("rating"),
        "url", "platform", "description",
        F.concat(F.lit("spec "), (F.col("listing_id") % 9).cast("string")).alias("specifications"))
    return a, b


UNION_SQL = """SELECT listing_id, 0 AS src, title, price, seller_name, reviews_count, rating_numeric AS rating, description,
  CAST(NULL AS VARCHAR) AS specifications, CAST(NULL AS VARCHAR) AS images, CAST(NULL AS VARCHAR) AS availability,
  CAST(NULL AS VARCHAR) AS shipping_info, url, platform FROM listings WHERE platform = 'mercadolivre'
UNION ALL SELECT listing_id, 1 AS src, title, price, seller_name, reviews_count, rating_numeric, description,
  'spec ' || CAST(listing_id % 9 AS VARCHAR), NULL, NULL, NULL, url, platform FROM listings WHERE platform = 'americanas'"""

_UNION_COLS = ["listing_id", "src"] + C.SHARED_COLUMNS


def _union(spark, d):
    a, b = _sources(spark, d)
    return R.union_sources(a.withColumn("src", F.lit(0)), b.withColumn("src", F.lit(1)), _UNION_COLS)


@register("union_sources", UNION_SQL)
def q_union_sources(spark, d):
    return _union(spark, d).withColumn("listing_id", F.col("listing_id").cast("long")).withColumn("src", F.col("src").cast("int"))


@register("dedup_subset", f"""
WITH u AS ({UNION_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY title, price ORDER BY src, listing_id) AS rn FROM u)
SELECT listing_id, src, title, price, seller_name, url FROM r WHERE rn = 1""")
def q_dedup_subset(spark, d):
    u = _union(spark, d).withColumn("seq", F.struct(F.col("src").cast("int").alias("src"),
                                                    F.col("listing_id").cast("long").alias("listing_id")))
    first = R.first_per_key(u.select("title", "price", "seq", "seller_name", "url"), ["title", "price"], "seq")
    return first.select(F.col("seq.listing_id").alias("listing_id"), F.col("seq.src").alias("src"),
                        "title", "price", "seller_name", "url")


@register("dedup_rows", "SELECT DISTINCT title, description, platform, seller_name FROM texts")
def q_dedup_rows(spark, d):
    return R.dedup_rows(FX.texts(spark, d).select("title", "description", "platform", "seller_name"))


@register("src_ordered_columns", """SELECT title, price, seller_name, CAST(NULL AS VARCHAR) AS seller_reputation, reviews_count,
  rating_numeric AS rating, url, platform, description, CAST(NULL AS VARCHAR) AS specifications, CAST(NULL AS VARCHAR) AS images,
  CAST(NULL AS VARCHAR) AS availability, CAST(NULL AS VARCHAR) AS shipping_info, scraped_at, listing_id FROM listings""")
def q_src_ordered_columns(spark, d):
    from vitrine.sources.files import order_columns
    lst = FX.listings(spark, d).withColumnRenamed("rating_numeric", "rating")
    return order_columns(lst, C.RAW_COLUMN_ORDER, fill_missing=True)


@register("src_table_scan", """SELECT id, title, price_numeric, scraped_at FROM products
WHERE platform = 'americanas' AND price_numeric > 100""")
def q_src_table_scan(spark, d):
    return (_p(spark, d).where((F.col("platform") == "americanas") & (F.col("price_numeric") > 100))
            .select("id", "title", "price_numeric", "scraped_at"))


@register("schema_check", """SELECT 'product_type,shipping_info' AS missing_features, 'listing_id,price,rating_numeric,scraped_at,url' AS extra_features,
  'description,rating_numeric' AS columns_with_nulls, true AS count_mismatch""")
def q_schema_check(spark, d):
    exp = ["title", "description", "seller_name", "platform", "reviews_count", "product_type", "shipping_info"]
    r = R.schema_check(FX.listings(spark, d), exp)
    return r.select(*[F.array_join(c, ",").alias(c) for c in ("missing_features", "extra_features", "columns_with_nulls")],
                    "count_mismatch")


# ----------------------------------------------------------------- windows --
@register("paginate", "SELECT * FROM (" + JOIN1_SQL + ") j ORDER BY classified_at DESC, classification_id LIMIT 25 OFFSET 50")
def q_paginate(spark, d):
    rows, _meta = R.paginate(q_join_listing(spark, d), [F.col("classified_at").desc(), F.col("classification_id")], 3, 25)
    return rows


@register("paginate_meta", """SELECT count(*) AS total, 3 AS page, 25 AS per_page, CAST(ceil(count(*) / 25e0) AS BIGINT) AS pages,
  3 < ceil(count(*) / 25e0) AS has_next, true AS has_prev FROM (""" + JOIN1_SQL + ") j")
def q_paginate_meta(spark, d):
    _rows, meta = R.paginate(q_join_listing(spark, d), [F.col("classified_at").desc(), F.col("classification_id")], 3, 25)
    return meta


@register("recent_topk", "SELECT id, status, started_at FROM jobs ORDER BY started_at DESC, id DESC LIMIT 10")
def q_recent_topk(spark, d):
    return FX.jobs(spark, d).orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(10).select("id", "status", "started_at")


IMP_RANK_SQL = """SELECT model, method, feature, importance,
  CAST(row_number() OVER (PARTITION BY model, method ORDER BY importance DESC, feature) AS INTEGER) AS rank,
  importance / nullif(sum(importance) OVER (PARTITION BY model, method), 0) * 100 AS importance_pct,
  sum(importance) OVER (PARTITION BY model, method ORDER BY importance DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
   / nullif(sum(importance) OVER (PARTITION BY model, method), 0) * 100 AS cumulative_pct
FROM importance WHERE method = 'impurity'"""


def _ranked(spark, d):
    return R.importance_rank(FX.importance(spark, d).where(F.col("method") == "impurity"))


def _r6(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


@register("importance_rank", "SELECT model, method, feature, round(importance, 6) AS importance, rank, "
          "round(importance_pct, 6) AS importance_pct, round(cumulative_pct, 6) AS cumulative_pct FROM (" + IMP_RANK_SQL + ")")
def q_importance_rank(spark, d):
    return _r6(_ranked(spark, d))


@register("importance_select", "SELECT model, feature, rank FROM (" + IMP_RANK_SQL + ") WHERE cumulative_pct <= 95")
def q_importance_select(spark, d):
    return R.importance_select(_ranked(spark, d), cumulative_pct=95.0).select("model", "feature", "rank")


@register("importance_summary", """SELECT model, method, count(*) AS n_features, count_if(importance >= 0.2e0) AS n_above_threshold,
  round(max(importance), 6) AS max_importance, round(min(importance), 6) AS min_importance, round(avg(importance), 6) AS mean_importance,
  round(stddev_samp(importance), 6) AS std_importance, arg_min(feature, rank) AS top_feature,
  count_if(cumulative_pct <= 80) AS n_features_80pct FROM (""" + IMP_RANK_SQL + ") GROUP BY model, method")
def q_importance_summary(spark, d):
    return _r6(R.importance_summary(_ranked(spark, d), threshold=0.2))


@register("version_history", """SELECT model, metric, round(max(value), 6) AS best, round(min(value), 6) AS worst,
  round(arg_max(value, created_at), 6) AS latest, round(arg_min(value, created_at), 6) AS first, count(*) AS n_versions,
  arg_max(value, created_at) > arg_min(value, created_at) AS improving,
  round((arg_max(value, created_at) - arg_min(value, created_at)) / count(*), 6) AS rate FROM versions GROUP BY model, metric""")
def q_version_history(spark, d):
    return _r6(R.version_history(FX.versions(spark, d)))


@register("latest_version", """SELECT model, version, created_at,
  CAST(row_number() OVER (PARTITION BY model ORDER BY CAST(split_part(version, '.', 1) AS INTEGER), CAST(split_part(version, '.', 2) AS INTEGER), CAST(split_part(version, '.', 3) AS INTEGER)) AS INTEGER) AS position,
  row_number() OVER (PARTITION BY model ORDER BY CAST(split_part(version, '.', 1) AS INTEGER) DESC, CAST(split_part(version, '.', 2) AS INTEGER) DESC, CAST(split_part(version, '.', 3) AS INTEGER) DESC) = 1 AS is_latest
FROM (SELECT DISTINCT model, version, created_at FROM versions)""")
def q_latest_version(spark, d):
    return R.version_order(FX.versions(spark, d))


@register("last_n_stats", """SELECT endpoint, count(*) AS n, round(avg(latency_ms), 6) AS avg_latency_ms, max(latency_ms) AS max_latency_ms
FROM (SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY ts DESC, event_id DESC) AS rn FROM metrics_events) WHERE rn <= 1000
GROUP BY endpoint""")
def q_last_n_stats(spark, d):
    last = R.last_n(FX.metrics_events(spark, d), ["endpoint"], "ts", 1000, "event_id")
    return last.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("latency_ms"), 6).alias("avg_latency_ms"),
                                        F.max("latency_ms").alias("max_latency_ms"))


@register("health_history", """SELECT event_id, ts, endpoint AS component, status_code FROM metrics_events
WHERE ts >= (SELECT max(ts) FROM metrics_events) - INTERVAL 48 HOUR AND endpoint = 'error' ORDER BY ts DESC, event_id DESC""")
def q_health_history(spark, d):
    from vitrine.operators.monitor import max_ts, since
    ev = FX.metrics_events(spark, d)
    return (ev.where(since("ts", max_ts(ev, "ts"), 48) & (F.col("endpoint") == "error"))
            .orderBy(F.col("ts").desc(), F.col("event_id").desc())
            .select("event_id", "ts", F.col("endpoint").alias("component"), "status_code"))


# ----------------------------------------------------------------- filters --
@register("event_filter", "SELECT event_id, endpoint FROM metrics_events WHERE endpoint IN ('click', 'view', 'purchase', 'error')")
def q_event_filter(spark, d):
    return CL.event_filter(FX.metrics_events(spark, d), ["click", "view", "purchase", "error"], col="endpoint").select("event_id", "endpoint")


@register("retention_jobs", """SELECT count_if(started_at < m - INTERVAL 30 DAY) AS deleted, count_if(NOT (started_at < m - INTERVAL 30 DAY)) AS kept
FROM jobs, (SELECT max(started_at) AS m FROM jobs)""")
def q_retention_jobs(spark, d):
    from vitrine.operators.monitor import max_ts
    j = FX.jobs(spark, d)
    kept, deleted = CL.retention_split(j, "started_at", max_ts(j, "started_at"), 30)
    from vitrine.functions.partitioning import with_scalars
    return with_scalars(deleted.agg(F.count(F.lit(1)).alias("deleted")), kept.agg(F.count(F.lit(1)).alias("kept")))


@register("retention_counts", """SELECT
 (SELECT count(*) FROM metrics_events WHERE ts < (SELECT max(ts) FROM metrics_events) - INTERVAL 7 DAY) AS health_deleted,
 (SELECT count(*) FROM jobs WHERE status IN ('completed', 'failed') AND completed_at < (SELECT max(started_at) FROM jobs) - INTERVAL 30 DAY) AS jobs_deleted""")
def q_retention_counts(spark, d):
    from vitrine.operators.monitor import max_ts
    ev, j = FX.metrics_events(spark, d), FX.jobs(spark, d)
    _, h_del = CL.retention_split(ev, "ts", max_ts(ev, "ts"), 7)
    _, j_del = CL.retention_split(j, "completed_at", max_ts(j, "started_at"), 30, status_in=["completed", "failed"])
    from vitrine.functions.partitioning import with_scalars
    return with_scalars(h_del.agg(F.count(F.lit(1)).alias("health_deleted")), j_del.agg(F.count(F.lit(1)).alias("jobs_deleted")))
