"""Streaming queries (STR*): each runs its stream to completion with
``availableNow`` into a sink under the checkpoint folder and returns the
settled sink contents as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.plans.catalog import register
from vitrine.sources import fixtures as FX
from vitrine.streaming import jobs as SJ


def _events_stream(spark, d):
    return FX.metrics_events_from(SJ.stream_table(spark, d, "events"))


def _r6(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


@register("stream_tumbling", """WITH m AS (SELECT max(ts) AS mx FROM metrics_events),
w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS requests, avg(latency_ms) AS avg_latency_ms,
  max(latency_ms) AS max_latency_ms, count_if(status_code >= 400) AS errors FROM metrics_events GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, requests, round(avg_latency_ms, 6) AS avg_latency_ms, max_latency_ms, errors
FROM w, m WHERE window_start + INTERVAL 1 HOUR <= mx - INTERVAL 10 MINUTE""")
def q_stream_tumbling(spark, d):
    """Hourly latency statistics, watermark 10 minutes, append mode (STR2)."""
    base = SJ.run_dir(spark, "tumbling")
    SJ.run_available_now(SJ.tumbling_stats(_events_stream(spark, d)), base + "/out", base + "/ckpt")
    return _r6(spark.read.parquet(base + "/out"))


@register("stream_sliding", """WITH m AS (SELECT max(ts) AS mx FROM metrics_events),
x AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) - to_hours(k) AS window_start, status_code FROM metrics_events, range(0, 24) r(k)),
w AS (SELECT window_start, count(*) AS events, count_if(status_code >= 400) AS errors FROM x GROUP BY 1)
SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, events, errors FROM w, m
WHERE window_start + INTERVAL 24 HOUR <= mx - INTERVAL 10 MINUTE""")
def q_stream_sliding(spark, d):
    """24 h windows sliding every hour (STR3)."""
    base = SJ.run_dir(spark, "sliding")
    SJ.run_available_now(SJ.sliding_counts(_events_stream(spark, d)), base + "/out", base + "/ckpt")
    return spark.read.parquet(base + "/out")


@register("stream_endpoint", """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, endpoint, count(*) AS requests,
  count_if(status_code >= 400) AS errors FROM metrics_events GROUP BY 1, 2""")
def q_stream_endpoint(spark, d):
    """Requests and errors by endpoint and hour, update mode, upserted per micro-batch (STR4)."""
    base = SJ.run_dir(spark, "endpoint")
    SJ.run_available_now(SJ.endpoint_counts(_events_stream(spark, d)), None, base + "/ckpt", mode="update",
                         foreach_batch=SJ.upsert_batches(base + "/out", ["window_start", "endpoint"]))
    return SJ.settled(spark, base + "/out", ["window_start", "endpoint"])


#: Parts in which the crawl arrives; the stream stops after each and is started again from its checkpoint.
ARRIVALS = 2


@register("stream_dedup", """WITH c AS (SELECT listing_id, title, seller_name, url FROM crawl),
n AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.url = c.url) AND NOT EXISTS (SELECT 1 FROM products p WHERE p.title = c.title AND p.seller_name = c.seller_name)),
u AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY url ORDER BY listing_id) = 1)
SELECT listing_id, title, seller_name, url FROM u QUALIFY row_number() OVER (PARTITION BY title, seller_name ORDER BY listing_id) = 1""")
def q_stream_dedup(spark, d):
    """A crawl of all listings, arriving in order of listing_id: refused when seen before by url or (title, seller), in the
    whole stored table or in the stream (STR5)."""
    base = SJ.run_dir(spark, "dedup")
    crawl = FX.crawl(spark, d).select("listing_id", "title", "seller_name", "url")
    ends = crawl.agg(F.min("listing_id"), F.max("listing_id")).first()
    stream = spark.readStream.schema(crawl.schema).parquet(base + "/in/*")
    lo, hi = ends[0] or 0, (ends[1] or 0) + 1
    for part in range(ARRIVALS):
        a, b = (lo + (hi - lo) * x // ARRIVALS for x in (part, part + 1))
        crawl.where((F.col("listing_id") >= a) & (F.col("listing_id") < b)).write.parquet(f"{base}/in/{part}")
        SJ.run_available_now(SJ.dedup_new_listings(stream, FX.products(spark, d)), base + "/out", base + "/ckpt", empty_batches=False)
    return spark.read.parquet(base + "/out")


_THRESH = [("avg_latency_ms", 60.0), ("errors", 3.0)]


@register("stream_alerts", """WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, avg(latency_ms) AS avg_latency_ms,
  CAST(count_if(status_code >= 400) AS DOUBLE) AS errors FROM metrics_events GROUP BY 1),
l AS (SELECT window_start, 'avg_latency_ms' AS metric, avg_latency_ms AS value FROM w UNION ALL SELECT window_start, 'errors', errors FROM w)
SELECT window_start, metric, round(value, 6) AS value FROM l WHERE (metric = 'avg_latency_ms' AND value > 60) OR (metric = 'errors' AND value > 3)""")
def q_stream_alerts(spark, d):
    """Threshold alerts on fresh hourly statistics, checked per micro-batch (STR6)."""
    th = spark.createDataFrame(_THRESH, "metric string, threshold double")
    e = _events_stream(spark, d).withColumn("_et", SJ.event_time("ts")).withWatermark("_et", "10 minutes")
    g = e.groupBy(F.window("_et", "1 hour").alias("w")).agg(F.avg("latency_ms").alias("avg_latency_ms"),
                                                           F.count_if(F.col("status_code") >= 400).cast("double").alias("errors"))
    g = g.select(SJ.wall(F.col("w.start")).alias("window_start"), "avg_latency_ms", "errors")

    def alerts(b):
        long = b.select("window_start", "_batch_id", F.stack(F.lit(2), F.lit("avg_latency_ms"), F.col("avg_latency_ms"),
                                                             F.lit("errors"), F.col("errors")).alias("metric", "value"))
        return long.join(F.broadcast(th), "metric").select("window_start", "metric", "value", "threshold", "_batch_id")
    base = SJ.run_dir(spark, "alerts")
    SJ.run_available_now(g, None, base + "/ckpt", mode="update",
                         foreach_batch=SJ.upsert_batches(base + "/out", ["window_start", "metric"], extra=alerts))
    s = SJ.settled(spark, base + "/out", ["window_start", "metric"])
    return _r6(s.where(F.col("value") > F.col("threshold")).select("window_start", "metric", "value"))


@register("stream_ingest", "SELECT page_id, url, CAST(length(html) AS INTEGER) AS html_chars FROM pages")
def q_stream_ingest(spark, d):
    """Checkpointed availableNow ingestion of a file source (STR7)."""
    s = SJ.stream_table(spark, d, "pages").select("page_id", "url", F.length("html").alias("html_chars"))
    base = SJ.run_dir(spark, "ingest")
    SJ.run_available_now(s, base + "/out", base + "/ckpt")
    return spark.read.schema(s.schema).parquet(base + "/out")


@register("stream_stuck", """SELECT id, started_at, CAST(NULL AS TIMESTAMP) AS completed_at FROM jobs
WHERE (completed_at IS NULL OR completed_at > started_at + INTERVAL 2 HOUR)
  AND started_at + INTERVAL 2 HOUR < (SELECT least(max(started_at), max(completed_at)) FROM jobs) - INTERVAL 1 HOUR""")
def q_stream_stuck(spark, d):
    """Jobs with no completion within 2 hours, from a stream-stream outer join (STR8).
    A start is emitted with a null end once the combined watermark (the
    minimum over both streams of max event time - 1 h) passes its 2 h bound."""
    starts = FX.jobs_from(SJ.stream_table(spark, d, "orders"))
    ends = FX.jobs_from(SJ.stream_table(spark, d, "orders"))
    base = SJ.run_dir(spark, "stuck")
    SJ.run_available_now(SJ.stuck_jobs(starts, ends), base + "/out", base + "/ckpt")
    return spark.read.parquet(base + "/out").where(F.col("completed_at").isNull())


@register("stream_score")
def q_stream_score(spark, d):
    """Unscored products scored as they arrive; appended per micro-batch keyed by id (STR1)."""
    from pyspark.ml.functions import vector_to_array
    from vitrine.plans.ml_queries import _fit, prepared
    pm, _, _, _ = prepared(spark, d)
    model, _ = _fit(spark, d, "logistic_regression")
    lst = FX.listings_from(SJ.stream_table(spark, d, "orders")).where(F.col("listing_id") % 10 != 9)
    scored_ids = FX.classifications(spark, d).select(F.col("product_id").alias("listing_id")).distinct()
    new = lst.join(scored_ids, "listing_id", "left_anti")
    x = model.transform(pm.transform(new.withColumn("target", F.lit(0))))
    out = x.select(F.col("listing_id").alias("product_id"),
                   F.when(F.col("prediction") == 1, F.lit("original")).otherwise(F.lit("suspicious")).alias("prediction"),
                   F.array_max(vector_to_array("probability")).alias("confidence_score"))
    base = SJ.run_dir(spark, "score")
    SJ.run_available_now(out, None, base + "/ckpt", foreach_batch=SJ.upsert_batches(base + "/out", ["product_id"]))
    return SJ.settled(spark, base + "/out", ["product_id"])
