"""Numeric, categorical, selection and TF-IDF features (NUM*, CAT*, SEL*, TXT3, TXT11)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vitrine.functions.stopwords import stop_words
from vitrine.operators import category as CT
from vitrine.operators import numeric as N
from vitrine.operators import select as SL
from vitrine.operators import textfeat as TF
from vitrine.plans.catalog import register
from vitrine.plans.sqlbits import q
from vitrine.sources import fixtures as FX


def _r6(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


IQR_SQL = """WITH b AS (SELECT quantile_cont(price_numeric, 0.25) AS q1, quantile_cont(price_numeric, 0.75) AS q3 FROM products)
SELECT id, price_numeric, coalesce(price_numeric < q1 - 1.5 * (q3 - q1) OR price_numeric > q3 + 1.5 * (q3 - q1), false) AS is_outlier FROM products, b"""


@register("outlier_iqr", IQR_SQL)
def q_outlier_iqr(spark, d):
    p = FX.products(spark, d)
    return p.select("id", "price_numeric", N.outlier_iqr(p, "price_numeric").alias("is_outlier"))


@register("outlier_zscore", """WITH b AS (SELECT avg(reviews_count) AS m, stddev_samp(reviews_count) AS s FROM texts)
SELECT doc_id, coalesce(abs((reviews_count - m) / s) > 3, false) AS is_outlier FROM texts, b""")
def q_outlier_zscore(spark, d):
    t = FX.texts(spark, d)
    return t.select("doc_id", N.outlier_zscore(t, "reviews_count").alias("is_outlier"))


_TREAT_BASE = """WITH b AS (SELECT quantile_cont(reviews_count, 0.25) AS q1, quantile_cont(reviews_count, 0.75) AS q3,
  quantile_cont(reviews_count, 0.05) AS lo, quantile_cont(reviews_count, 0.95) AS hi FROM texts),
f AS (SELECT t.*, coalesce(reviews_count < q1 - 1.5 * (q3 - q1) OR reviews_count > q3 + 1.5 * (q3 - q1), false) AS o, lo, hi FROM texts t, b),
a AS (SELECT max(CAST(o AS INTEGER)) = 1 AS any_out FROM f)"""


@register("outlier_cap", _TREAT_BASE + """
SELECT doc_id, round(CASE WHEN any_out AND reviews_count IS NOT NULL THEN least(greatest(reviews_count, lo), hi) ELSE reviews_count END, 6) AS reviews_count FROM f, a""")
def q_outlier_cap(spark, d):
    t = FX.texts(spark, d).select("doc_id", F.col("reviews_count").cast("double").alias("reviews_count"))
    return _r6(N.outlier_treat(t, "reviews_count", "cap"))


@register("outlier_remove", _TREAT_BASE + " SELECT doc_id FROM f, a WHERE NOT (o AND any_out)")
def q_outlier_remove(spark, d):
    t = FX.texts(spark, d).select("doc_id", F.col("reviews_count").cast("double").alias("reviews_count"))
    return N.outlier_treat(t, "reviews_count", "remove").select("doc_id")


@register("outlier_log", _TREAT_BASE + " SELECT doc_id, round(CASE WHEN any_out THEN ln(1 + reviews_count) ELSE reviews_count END, 6) AS reviews_count FROM f, a")
def q_outlier_log(spark, d):
    t = FX.texts(spark, d).select("doc_id", F.col("reviews_count").cast("double").alias("reviews_count"))
    return _r6(N.outlier_treat(t, "reviews_count", "transform"))


@register("outlier_report", """WITH b AS (SELECT quantile_cont(price_numeric, 0.25) AS q1, quantile_cont(price_numeric, 0.75) AS q3,
  quantile_cont(rating_numeric, 0.25) AS r1, quantile_cont(rating_numeric, 0.75) AS r3 FROM products)
SELECT 'price_numeric' AS column, id, title, url, price_numeric AS value FROM products, b WHERE price_numeric < q1 - 1.5 * (q3 - q1) OR price_numeric > q3 + 1.5 * (q3 - q1)
UNION ALL SELECT 'rating_numeric', id, title, url, rating_numeric FROM products, b WHERE rating_numeric < r1 - 1.5 * (r3 - r1) OR rating_numeric > r3 + 1.5 * (r3 - r1)""")
def q_outlier_report(spark, d):
    return N.outlier_report(FX.products(spark, d), ["price_numeric", "rating_numeric"], ["id", "title", "url"])


def _num5_sql():
    cols = ["price_numeric", "rating_numeric", "reviews_count"]
    med = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in cols)
    fill = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in cols)
    qq = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}, quantile_cont({c}, 0.05) AS lo_{c}, "
                   f"quantile_cont({c}, 0.95) AS hi_{c}" for c in cols)
    has = ", ".join(f"count_if({c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c})) > 0 AS o_{c}" for c in cols)
    cap = ", ".join(f"CASE WHEN o_{c} THEN least(greatest({c}, lo_{c}), hi_{c}) ELSE {c} END AS {c}" for c in cols)
    der = """price_numeric, rating_numeric, reviews_count,
  CAST(price_numeric <= p33 AS INTEGER) AS price_category_low, CAST(price_numeric > p33 AND price_numeric <= p67 AS INTEGER) AS price_category_medium,
  CAST(price_numeric > p67 AS INTEGER) AS price_category_high, ln(1 + price_numeric) AS log_price,
  CAST(rating_numeric >= 4.0 AS INTEGER) AS high_rating, CAST(rating_numeric <= 2.5 AS INTEGER) AS low_rating,
  pow(rating_numeric, 2) AS rating_squared, CAST(reviews_count >= r75 AS INTEGER) AS high_reviews,
  CAST(reviews_count <= r25 AS INTEGER) AS low_reviews, ln(1 + reviews_count) AS log_reviews,
  price_numeric / (rating_numeric + 0.1) AS price_per_rating, price_numeric / (reviews_count + 1) AS price_per_review,
  rating_numeric * ln(1 + reviews_count) AS rating_reliability"""
    outs = cols + N.DERIVED
    st = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS a_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in outs)
    fin = ", ".join(f"round((CAST({c} AS DOUBLE) - a_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1 ELSE s_{c} END, 6) AS {c}" for c in outs)
    return f"""WITH med AS (SELECT {med} FROM products),
f AS (SELECT id, {fill} FROM products, med),
qq AS (SELECT {qq} FROM f), oo AS (SELECT {has} FROM f, qq),
c AS (SELECT id, {cap} FROM f, qq, oo),
qc AS (SELECT quantile_cont(price_numeric, 0.33) AS p33, quantile_cont(price_numeric, 0.67) AS p67,
  quantile_cont(reviews_count, 0.25) AS r25, quantile_cont(reviews_count, 0.75) AS r75 FROM c),
der AS (SELECT id, {der} FROM c, qc), st AS (SELECT {st} FROM der)
SELECT id, {fin} FROM der, st"""


@register("numeric_features", _num5_sql())
def q_numeric_features(spark, d):
    p = FX.products(spark, d, heavy=True)
    m = N.fit_numeric(p)
    return _r6(m.transform(p).select("id", *m.output_columns))


# ------------------------------------------------------------- categorical --
@register("onehot", """WITH tr AS (SELECT coalesce(seller_name, 'unknown') AS v FROM labelled WHERE doc_id % 4 <> 0 AND seller_name <> 'src3'),
codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS k FROM (SELECT DISTINCT v FROM tr)),
te AS (SELECT doc_id, coalesce(seller_name, 'unknown') AS v FROM labelled WHERE doc_id % 4 = 0)
SELECT te.doc_id, te.v AS seller_name, coalesce(codes.k, -1) AS onehot_index, (SELECT count(*) FROM codes) AS onehot_size
FROM te LEFT JOIN codes ON te.v = codes.v""")
def q_onehot(spark, d):
    lab = FX.labelled(spark, d)
    train = lab.where((F.col("doc_id") % 4 != 0) & (F.col("seller_name") != "src3"))
    test = lab.where(F.col("doc_id") % 4 == 0).select("doc_id", "seller_name")
    out, labels = CT.onehot(train, test, "seller_name")
    arr = vector_to_array(F.col("seller_name_onehot"))
    return out.select("doc_id", "seller_name", (F.array_position(arr, 1.0) - 1).cast("int").alias("onehot_index"),
                      F.size(arr).cast("long").alias("onehot_size"))


@register("label_code", """WITH codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS label_code
  FROM (SELECT DISTINCT coalesce(platform, 'unknown') AS v FROM texts))
SELECT doc_id, codes.label_code FROM texts JOIN codes ON coalesce(texts.platform, 'unknown') = codes.v""")
def q_label_code(spark, d):
    t = FX.texts(spark, d).select("doc_id", "platform")
    return CT.label_code(t, t, "platform").select("doc_id", "label_code")


@register("frequency_code", """WITH tr AS (SELECT coalesce(seller_name, 'unknown') AS v FROM labelled WHERE doc_id % 4 <> 0 AND seller_name <> 'src3'),
c AS (SELECT v, count(*) AS f FROM tr GROUP BY v)
SELECT l.doc_id, coalesce(c.f, 0) AS seller_name_frequency FROM labelled l LEFT JOIN c ON coalesce(l.seller_name, 'unknown') = c.v WHERE l.doc_id % 4 = 0""")
def q_frequency_code(spark, d):
    lab = FX.labelled(spark, d)
    train = lab.where((F.col("doc_id") % 4 != 0) & (F.col("seller_name") != "src3"))
    test = lab.where(F.col("doc_id") % 4 == 0).select("doc_id", "seller_name")
    return CT.frequency_code(train, test, "seller_name").select("doc_id", "seller_name_frequency")


# --------------------------------------------------------------- selection --
SEL_COLS = ["title_char_count", "title_word_count", "title_avg_word_length", "description_char_count",
            "description_word_count", "description_avg_word_length", "description_uppercase_count", "reviews_count"]


def _sel_frame(spark, d):
    return TF.text_length(FX.texts(spark, d))


def _sel_sql_base():
    from vitrine.plans.listing_queries import _text_length_sql
    return f"tl AS (SELECT doc_id, reviews_count, {_text_length_sql('title')}, {_text_length_sql('description')} FROM texts)"


def _pairs_sql():
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {i} AS i, {j} AS j, "
             f"{'max(1e0)' if a == b else f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))'} AS correlation FROM tl"
             for i, a in enumerate(SEL_COLS) for j, b in enumerate(SEL_COLS)]
    return " UNION ALL ".join(parts)


@register("corr_pairs", f"WITH {_sel_sql_base()}, p AS ({_pairs_sql()}) SELECT feature_a, feature_b, i, j, round(correlation, 6) AS correlation FROM p")
def q_corr_pairs(spark, d):
    return _r6(SL.corr_pairs(_sel_frame(spark, d), SEL_COLS))


@register("corr_high_pairs", f"WITH {_sel_sql_base()}, p AS ({_pairs_sql()}) SELECT feature_a, feature_b, round(correlation, 6) AS correlation FROM p WHERE i < j AND abs(correlation) >= 0.8")
def q_corr_high_pairs(spark, d):
    return _r6(SL.corr_high_pairs(SL.corr_pairs(_sel_frame(spark, d), SEL_COLS), 0.8).select("feature_a", "feature_b", "correlation"))


@register("corr_pick", f"WITH {_sel_sql_base()}, p AS ({_pairs_sql()}) SELECT DISTINCT feature_b AS feature FROM p WHERE i < j AND abs(correlation) >= 0.8")
def q_corr_pick(spark, d):
    return SL.corr_pick(SL.corr_high_pairs(SL.corr_pairs(_sel_frame(spark, d), SEL_COLS), 0.8))


@register("corr_stats", f"""WITH {_sel_sql_base()}, p AS ({_pairs_sql()}) SELECT round(max(abs(correlation)), 6) AS max_abs_corr,
  round(avg(abs(correlation)), 6) AS mean_abs_corr, count_if(i < j AND abs(correlation) >= 0.8) AS n_high_pairs, max(i) AS n_features_minus_1 FROM p""")
def q_corr_stats(spark, d):
    return _r6(SL.corr_stats(SL.corr_pairs(_sel_frame(spark, d), SEL_COLS), 0.8))


# ------------------------------------------------------------------ TF-IDF --
_EN = stop_words("english")
_EN_SQL = "[" + ", ".join(q(w) for w in _EN) + "]"
TFIDF_BASE = f"""WITH tk AS (SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(description, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
    lambda t: NOT list_contains({_EN_SQL}, t)) AS t FROM texts),
tm AS (SELECT doc_id, list_concat(t, CASE WHEN len(t) >= 2 THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE [] END) AS terms FROM tk),
cnt AS (SELECT doc_id, term, count(*) AS count FROM (SELECT doc_id, unnest(terms) AS term FROM tm) GROUP BY doc_id, term),
nd AS (SELECT count(*) AS n FROM texts),
g AS (SELECT term, sum(count) AS tf, count(*) AS df FROM cnt GROUP BY term),
voc AS (SELECT term, tf, df, ln((1e0 + n) / (1e0 + df)) + 1e0 AS idf FROM g, nd WHERE df >= 2 AND df <= 0.95 * n ORDER BY tf DESC, term LIMIT 1000)"""


def _tfidf(spark, d):
    t = FX.texts(spark, d)
    terms = TF.doc_terms(t, "doc_id", "description", _EN)
    n_docs = t.agg(F.count(F.lit(1))).scalar()
    stats = TF.frequent_stats(TF.doc_tokens(t, "doc_id", "description", _EN), n_docs, 1000, 2, 0.95)
    return terms, TF.tfidf_vocabulary(stats, n_docs, 1000, 2, 0.95)


@register("tfidf_terms", TFIDF_BASE + " SELECT term, CAST(tf AS BIGINT) AS tf, df, round(idf, 6) AS idf FROM voc")
def q_tfidf_terms(spark, d):
    _, voc = _tfidf(spark, d)
    return _r6(voc)


@register("tfidf_weights", TFIDF_BASE + """, w AS (SELECT cnt.doc_id, cnt.term, cnt.count * voc.idf AS w FROM cnt JOIN voc ON cnt.term = voc.term),
nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT w.doc_id, w.term, round(w.w / nrm.norm, 6) AS weight FROM w JOIN nrm ON w.doc_id = nrm.doc_id""")
def q_tfidf_weights(spark, d):
    terms, voc = _tfidf(spark, d)
    return _r6(TF.tfidf_weights(terms, voc))


@register("feature_names", """SELECT feature, CASE WHEN contains(lower(feature), 'tfidf') THEN 'Text Content: ' || trim(replace(b, 'Tfidf', ''))
  WHEN contains(lower(feature), 'scaled') THEN replace(b, 'Scaled', '(Normalized)') WHEN contains(lower(feature), 'encoded') THEN replace(b, 'Encoded', '(Category)')
  ELSE b END AS readable_name FROM (SELECT feature, array_to_string(list_transform(string_split(replace(feature, '_', ' '), ' '),
  lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS b FROM (SELECT DISTINCT feature FROM (
  SELECT feature FROM importance UNION ALL SELECT 'title_tfidf_' || term FROM (SELECT DISTINCT word AS term FROM
  (SELECT unnest(regexp_extract_all(lower(title), '[a-z]+')) AS word FROM listings)) UNION ALL SELECT 'price_numeric_scaled'
  UNION ALL SELECT 'platform_encoded')))""")
def q_feature_names(spark, d):
    imp = FX.importance(spark, d).select("feature")
    words = FX.listings(spark, d).select(F.explode(F.regexp_extract_all(F.lower("title"), F.lit("[a-z]+"), 0)).alias("w")).distinct()
    names = imp.unionByName(words.select(F.concat(F.lit("title_tfidf_"), "w").alias("feature")))
    names = names.unionByName(spark.createDataFrame([("price_numeric_scaled",), ("platform_encoded",)], "feature string")).distinct()
    return names.select("feature", TF.feature_readable_name(F.col("feature")).alias("readable_name"))
