"""Fixture views over the driver tables.

The driver data has no listing table, so listings, service tables and the
long evaluation frames are derived from ``orders``, ``events``, ``documents``
and ``labels`` by deterministic column expressions. Each view is a lazy plan
over one scan; nothing is materialised, and every view grows with its table.
The same definitions are written as SQL for the DuckDB oracle in
``vitrine.plans.fixture_sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.partitioning import spread
from vitrine.sources.tables import table


def _case(x: Column, mapping: dict, default) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(x == k, v) if out is None else out.when(x == k, v)
    return out.otherwise(default)


def _s(x: Column) -> Column:
    return x.cast("string")


def listings(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """``heavy=True`` for regex-heavy consumers: small inputs are spread over
    all task slots first (no-op when the scan is already split wider)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return listings_from(spread(o) if heavy else o)


def listings_from(o: DataFrame) -> DataFrame:
    """Listing columns from an orders frame (batch or streaming)."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    title = F.concat(
        _case(k % 5, {0: "Cartucho HP 664", 1: "Toner HP 85A", 2: "Tinta Packard",
                      3: "Cartucho H.P. 122"}, F.lit("Impressora Canon")),
        _case(k % 7, {0: " Original", 1: " compatível", 2: " lacrado", 3: " recarga"}, F.lit("")))
    description = F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.concat(
        _case(k % 11, {0: "genérico,  ", 1: "com nota fiscal ", 2: "produto compativel "}, F.lit("")),
        F.lit("modelo: X"), _s(k % 40), F.lit(" cor: "),
        _case(k % 3, {0: "preto", 1: "magenta"}, F.lit("verde")),
        F.when(k % 2 == 0, F.lit(" garantia")).otherwise(F.lit(""))))
    seller = _case(c % 6, {0: "Loja Oficial HP", 1: "HP Store", 2: "Loja Online SA"},
                   F.concat(F.lit("Seller "), _s(c % 23)))
    price = _case(k % 19, {0: "invalid", 1: "", 2: "1,234.56", 3: "R$ 1.234,56", 4: "1.234"},
                  F.concat(F.lit("R$ "), _s((k * 37) % 300), F.lit(","), F.lpad(_s(k % 100), 2, "0")))
    return o.select(
        k.alias("listing_id"), title.alias("title"), description.alias("description"),
        seller.alias("seller_name"),
        F.when(k % 2 == 0, F.lit("mercadolivre")).otherwise(F.lit("americanas")).alias("platform"),
        price.alias("price"),
        F.when(k % 13 == 0, F.lit(None).cast("double"))
         .otherwise(((k * 31) % 41).cast("double") / F.lit(8.0)).alias("rating_numeric"),
        ((k * 7) % 500).cast("int").alias("reviews_count"),
        F.concat(F.lit("https://example.com/p/"), _s(k % 14000)).alias("url"),
        F.col("o_orderdate").alias("scraped_at"))


def products(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Service ``products`` table: listings minus every tenth id, price parsed."""
    from vitrine.functions.text import price_locale
    return (listings(spark, sf_dir, heavy).where(F.col("listing_id") % 10 != 9)
            .select(F.col("listing_id").alias("id"), "title", "description", "seller_name",
                    "platform", price_locale("price").alias("price_numeric"), "rating_numeric",
                    "reviews_count", "url", "scraped_at"))


def _unit(v: Column) -> Column:
    return F.least(F.greatest(v, F.lit(0.0)) / F.lit(100.0), F.lit(1.0))


def classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        ((F.col("event_id") * 7919) % 16000).alias("product_id"),
        F.when(F.col("value") >= 20, F.lit("original")).otherwise(F.lit("suspicious")).alias("prediction"),
        _unit(F.col("value")).alias("confidence_score"),
        F.concat(F.lit("v1."), _s(F.col("user_id") % 3)).alias("model_version"),
        F.col("ts").alias("classified_at"),
        F.get_json_object("props", "$.k").cast("int").alias("processing_time_ms"))


def crawl(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Another crawl of every listing: a quarter under its stored url, a quarter under its stored title, the rest under
    names of which some come again later in the crawl."""
    i = F.col("listing_id")
    return listings(spark, sf_dir, heavy=heavy).withColumns({
        "title": F.when(i % 4 == 1, F.col("title")).otherwise(F.concat("title", F.lit(" #"), (i % 411).cast("string"))),
        "url": F.when(i % 4 == 0, F.col("url")).otherwise(F.concat("url", F.lit("?v="), (i % 3).cast("string")))})


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("model"), F.col("event_id").alias("row_id"),
        (F.col("event_id") % 5).alias("fold"),
        ((F.col("value") + (F.col("user_id") % 7) * 15) > 80).cast("int").alias("y_true"),
        (F.col("value") >= 50).cast("int").alias("y_pred"),
        _unit(F.col("value")).alias("proba"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))
    return d.select("doc_id", F.substring_index("text", "\n", 1).alias("title"),
                    F.col("text").alias("description"), F.col("lang").alias("platform"),
                    F.col("source").alias("seller_name"), F.col("n_chars").alias("reviews_count"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"), "toxic")
    return texts(spark, sf_dir).join(lab, "doc_id")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs_from(table(spark, sf_dir, "orders"))


def jobs_from(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    status = _case(k % 10, {0: "failed", 1: "running"}, F.lit("completed"))
    return o.select(
        k.alias("id"), F.col("o_orderpriority").alias("job_type"), status.alias("status"),
        F.col("o_orderdate").alias("started_at"),
        F.when(k % 10 == 1, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.timestamp_add("MINUTE", k % 300, F.col("o_orderdate"))).alias("completed_at"),
        (k % 50).cast("int").alias("products_found"),
        F.least(k % 50, F.col("o_custkey") % 50).cast("int").alias("products_processed"))


def metrics_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_events_from(table(spark, sf_dir, "events"))


def metrics_events_from(e: DataFrame) -> DataFrame:
    return e.select("event_id", "ts", F.col("event_type").alias("endpoint"),
                    F.col("value").alias("latency_ms"),
                    F.when(F.col("value") > 90, F.lit(500)).otherwise(F.lit(200)).alias("status_code"))


def _fold_counts(p: DataFrame) -> DataFrame:
    yt, yp = F.col("y_true"), F.col("y_pred")
    return p.groupBy("model", "fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((yt == 1) & (yp == 1)).alias("tp"), F.count_if((yt == 0) & (yp == 1)).alias("fp"),
        F.count_if((yt == 1) & (yp == 0)).alias("fn"), F.count_if((yt == 0) & (yp == 0)).alias("tn"),
        F.max("ts").alias("last_ts"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(a.cast("double") / F.nullif(b, F.lit(0)).cast("double"), F.lit(0.0))


def cv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold scores (model, metric, fold, side, score): test = the fold, train = the rest."""
    e = table(spark, sf_dir, "events")
    p = predictions(spark, sf_dir).join(e.select(F.col("event_id").alias("row_id"), "ts"), "row_id")
    fc = _fold_counts(p)
    tot = fc.groupBy("model").agg(*[F.sum(x).alias("t_" + x) for x in ("n", "tp", "fp", "fn", "tn")])
    both = fc.join(tot, "model")
    test = both.select("model", "fold", F.lit("test").alias("side"), "n", "tp", "fp", "fn", "tn")
    train = both.select("model", "fold", F.lit("train").alias("side"),
                        *[(F.col("t_" + x) - F.col(x)).alias(x) for x in ("n", "tp", "fp", "fn", "tn")])
    s = test.unionByName(train)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    return s.select("model", "fold", "side", F.stack(
        F.lit(4), F.lit("accuracy"), _ratio(tp + tn, n), F.lit("precision"), _ratio(tp, tp + fp),
        F.lit("recall"), _ratio(tp, tp + fn), F.lit("f1_score"), _ratio(2 * tp, 2 * tp + fp + fn)
    ).alias("metric", "score")).select("model", "metric", "fold", "side", "score")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry-like frame: one version per (model, fold), two metrics each."""
    e = table(spark, sf_dir, "events")
    p = predictions(spark, sf_dir).join(e.select(F.col("event_id").alias("row_id"), "ts"), "row_id")
    fc = _fold_counts(p)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    return fc.select(
        "model", F.concat(F.lit("1."), _s(F.col("fold") * 3), F.lit(".0")).alias("version"),
        F.col("last_ts").alias("created_at"),
        F.stack(F.lit(2), F.lit("accuracy"), _ratio(tp + tn, n),
                F.lit("f1_score"), _ratio(2 * tp, 2 * tp + fp + fn)).alias("metric", "value"))


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, method, feature, importance) from predictions by (model, user bucket)."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), "user_id")
    p = predictions(spark, sf_dir).join(e, "row_id")
    feat = F.concat(F.lit("feature_"), F.lpad(_s(F.col("user_id") % 13), 2, "0"))
    g = p.groupBy("model", feat.alias("feature")).agg(
        (F.avg(F.col("y_true").cast("double")) * F.avg("proba")).alias("impurity"),
        (F.avg((F.col("y_true") == F.col("y_pred")).cast("double")) - F.lit(0.7)).alias("permutation"))
    return g.select("model", "feature", F.stack(F.lit(2), F.lit("impurity"), F.col("impurity"),
                                                F.lit("permutation"), F.col("permutation"))
                    .alias("method", "importance")).select("model", "method", "feature", "importance")


FIXTURES = {
    "listings": listings, "products": products, "classifications": classifications,
    "predictions": predictions, "texts": texts, "labelled": labelled, "jobs": jobs,
    "metrics_events": metrics_events, "cv_scores": cv_scores, "versions": versions,
    "importance": importance,
}
