"""The fixture views of ``vitrine.sources.fixtures`` as DuckDB SQL, for the
oracle. ``with_views(body)`` prefixes the CTEs a query body uses."""

from __future__ import annotations

import re


def price_locale_sql(e: str) -> str:
    s = f"regexp_replace(CAST({e} AS VARCHAR), '[^0-9,.]', '', 'g')"
    return ("TRY_CAST(CASE WHEN regexp_matches(" + s + ", '[.,][0-9]{1,2}$') THEN "
            "regexp_replace(regexp_extract(" + s + ", '^(.*)[.,][0-9]{1,2}$', 1), '[.,]', '', 'g') || '.' || "
            "regexp_extract(" + s + ", '[.,]([0-9]{1,2})$', 1) "
            "ELSE regexp_replace(" + s + ", '[.,]', '', 'g') END AS DOUBLE)")


def ratio_sql(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / CAST(nullif({b}, 0) AS DOUBLE), 0e0)"


LISTINGS = """SELECT o_orderkey AS listing_id,
  concat(CASE o_orderkey % 5 WHEN 0 THEN 'Cartucho HP 664' WHEN 1 THEN 'Toner HP 85A' WHEN 2 THEN 'Tinta Packard' WHEN 3 THEN 'Cartucho H.P. 122' ELSE 'Impressora Canon' END,
         CASE o_orderkey % 7 WHEN 0 THEN ' Original' WHEN 1 THEN ' compatível' WHEN 2 THEN ' lacrado' WHEN 3 THEN ' recarga' ELSE '' END) AS title,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat(CASE o_orderkey % 11 WHEN 0 THEN 'genérico,  ' WHEN 1 THEN 'com nota fiscal ' WHEN 2 THEN 'produto compativel ' ELSE '' END,
         'modelo: X', CAST(o_orderkey % 40 AS STRING), ' cor: ', CASE o_orderkey % 3 WHEN 0 THEN 'preto' WHEN 1 THEN 'magenta' ELSE 'verde' END,
         CASE WHEN o_orderkey % 2 = 0 THEN ' garantia' ELSE '' END) END AS description,
  CASE o_custkey % 6 WHEN 0 THEN 'Loja Oficial HP' WHEN 1 THEN 'HP Store' WHEN 2 THEN 'Loja Online SA' ELSE concat('Seller ', CAST(o_custkey % 23 AS STRING)) END AS seller_name,
  CASE WHEN o_orderkey % 2 = 0 THEN 'mercadolivre' ELSE 'americanas' END AS platform,
  CASE o_orderkey % 19 WHEN 0 THEN 'invalid' WHEN 1 THEN '' WHEN 2 THEN '1,234.56' WHEN 3 THEN 'R$ 1.234,56' WHEN 4 THEN '1.234'
       ELSE concat('R$ ', CAST((o_orderkey * 37) % 300 AS STRING), ',', lpad(CAST(o_orderkey % 100 AS STRING), 2, '0')) END AS price,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE ((o_orderkey * 31) % 41) / 8e0 END AS rating_numeric,
  CAST((o_orderkey * 7) % 500 AS INT) AS reviews_count,
  concat('https://example.com/p/', CAST(o_orderkey % 14000 AS STRING)) AS url,
  o_orderdate AS scraped_at
FROM orders"""

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "listings": (LISTINGS, ()),
    "crawl": (
        "SELECT * REPLACE (CASE WHEN listing_id % 4 = 1 THEN title ELSE title || ' #' || (listing_id % 411) END AS title, "
        "CASE WHEN listing_id % 4 = 0 THEN url ELSE url || '?v=' || (listing_id % 3) END AS url) FROM listings", ("listings",)),
    "products": (
        "SELECT listing_id AS id, title, description, seller_name, platform, "
        + price_locale_sql("price") + " AS price_numeric, rating_numeric, reviews_count, url, scraped_at "
        "FROM listings WHERE listing_id % 10 <> 9", ("listings",)),
    "classifications": (
        "SELECT event_id AS id, (event_id * 7919) % 16000 AS product_id, "
        "CASE WHEN value >= 20 THEN 'original' ELSE 'suspicious' END AS prediction, "
        "least(greatest(value, 0e0) / 100e0, 1e0) AS confidence_score, "
        "'v1.' || CAST(user_id % 3 AS VARCHAR) AS model_version, ts AS classified_at, "
        "CAST(json_extract_string(props, '$.k') AS INTEGER) AS processing_time_ms FROM events", ()),
    "predictions": (
        "SELECT event_type AS model, event_id AS row_id, event_id % 5 AS fold, "
        "CAST(value + (user_id % 7) * 15 > 80 AS INTEGER) AS y_true, CAST(value >= 50 AS INTEGER) AS y_pred, "
        "least(greatest(value, 0e0) / 100e0, 1e0) AS proba FROM events", ()),
    "texts": (
        "SELECT doc_id, split_part(text, chr(10), 1) AS title, text AS description, lang AS platform, "
        "source AS seller_name, n_chars AS reviews_count FROM documents", ()),
    "labelled": (
        "SELECT t.doc_id, t.title, t.description, t.platform, t.seller_name, t.reviews_count, "
        "l.quality AS target, l.toxic FROM texts t JOIN labels l ON t.doc_id = l.doc_id", ("texts",)),
    "jobs": (
        "SELECT o_orderkey AS id, o_orderpriority AS job_type, "
        "CASE o_orderkey % 10 WHEN 0 THEN 'failed' WHEN 1 THEN 'running' ELSE 'completed' END AS status, "
        "o_orderdate AS started_at, CASE WHEN o_orderkey % 10 = 1 THEN NULL "
        "ELSE o_orderdate + to_minutes(CAST(o_orderkey % 300 AS INTEGER)) END AS completed_at, "
        "CAST(o_orderkey % 50 AS INTEGER) AS products_found, "
        "CAST(least(o_orderkey % 50, o_custkey % 50) AS INTEGER) AS products_processed FROM orders", ()),
    "metrics_events": (
        "SELECT event_id, ts, event_type AS endpoint, value AS latency_ms, "
        "CASE WHEN value > 90 THEN 500 ELSE 200 END AS status_code FROM events", ()),
    "_fold_counts": (
        "SELECT p.model, p.fold, count(*) AS n, count_if(y_true = 1 AND y_pred = 1) AS tp, "
        "count_if(y_true = 0 AND y_pred = 1) AS fp, count_if(y_true = 1 AND y_pred = 0) AS fn, "
        "count_if(y_true = 0 AND y_pred = 0) AS tn, max(e.ts) AS last_ts "
        "FROM predictions p JOIN events e ON e.event_id = p.row_id GROUP BY p.model, p.fold", ("predictions",)),
    "_cv_sides": (
        "SELECT model, fold, 'test' AS side, n, tp, fp, fn, tn FROM _fold_counts UNION ALL "
        "SELECT f.model, f.fold, 'train' AS side, t.n - f.n, t.tp - f.tp, t.fp - f.fp, t.fn - f.fn, t.tn - f.tn "
        "FROM _fold_counts f JOIN (SELECT model, sum(n) AS n, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, "
        "sum(tn) AS tn FROM _fold_counts GROUP BY model) t ON f.model = t.model", ("_fold_counts",)),
    "cv_scores": (
        " UNION ALL ".join(
            f"SELECT model, '{m}' AS metric, fold, side, {ratio_sql(a, b)} AS score FROM _cv_sides"
            for m, a, b in [("accuracy", "tp + tn", "n"), ("precision", "tp", "tp + fp"),
                            ("recall", "tp", "tp + fn"), ("f1_score", "2 * tp", "2 * tp + fp + fn")]),
        ("_cv_sides",)),
    "versions": (
        " UNION ALL ".join(
            f"SELECT model, '1.' || CAST(fold * 3 AS VARCHAR) || '.0' AS version, last_ts AS created_at, "
            f"'{m}' AS metric, {ratio_sql(a, b)} AS value FROM _fold_counts"
            for m, a, b in [("accuracy", "tp + tn", "n"), ("f1_score", "2 * tp", "2 * tp + fp + fn")]),
        ("_fold_counts",)),
    "_imp_wide": (
        "SELECT p.model, 'feature_' || lpad(CAST(e.user_id % 13 AS VARCHAR), 2, '0') AS feature, "
        "avg(CAST(p.y_true AS DOUBLE)) * avg(p.proba) AS impurity, "
        "avg(CAST(p.y_true = p.y_pred AS DOUBLE)) - 0.7e0 AS permutation "
        "FROM predictions p JOIN events e ON e.event_id = p.row_id GROUP BY 1, 2", ("predictions",)),
    "importance": (
        "SELECT model, 'impurity' AS method, feature, impurity AS importance FROM _imp_wide UNION ALL "
        "SELECT model, 'permutation' AS method, feature, permutation AS importance FROM _imp_wide",
        ("_imp_wide",)),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in VIEWS[n][1]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(body: str) -> str:
    """Prefix ``body`` with the fixture CTEs it names (found by word match)."""
    used = [n for n in VIEWS if not n.startswith("_") and re.search(rf"\b{n}\b", body)]
    names = _closure(used)
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0]})" for n in names)
    b = body.lstrip()
    if b[:14].upper() == "WITH RECURSIVE":
        return "WITH RECURSIVE " + ctes + ",\n" + b[14:].lstrip()
    if b[:4].upper() == "WITH":
        return "WITH " + ctes + ",\n" + b[4:].lstrip()
    return "WITH " + ctes + "\n" + b
