"""Listing flow queries: clean, enrich, label, structure (CLN*, FIL*, TXT6-10, SET1, WIN1-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.text import price_locale
from vitrine.operators import clean as CL
from vitrine.operators import label as LB
from vitrine.plans.catalog import register
from vitrine.plans.fixture_sql import price_locale_sql
from vitrine.sources import fixtures as FX


def labelled_listings(spark, sf_dir):
    """Listings with CLN4 price and the TXT10 label."""
    lst = FX.listings(spark, sf_dir, heavy=True).withColumn("price_numeric", price_locale("price"))
    return LB.heuristic_label(lst)


def _contains_any_sql(col, words):
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


def heuristic_label_sql():
    from vitrine import config as C
    t, d, s = "lower(coalesce(title, ''))", "lower(coalesce(description, ''))", "lower(coalesce(seller_name, ''))"
    off = _contains_any_sql(s, C.OFFICIAL_STORES)
    okw = f"({_contains_any_sql(t, C.ORIGINAL_KEYWORDS)} OR {_contains_any_sql(d, C.ORIGINAL_KEYWORDS)})"
    skw = f"({_contains_any_sql(t, C.SUSPICIOUS_KEYWORDS)} OR {_contains_any_sql(d, C.SUSPICIOUS_KEYWORDS)})"
    lowp = "coalesce(price_numeric < 30, false)"
    highp = "coalesce(NOT (price_numeric < 30) AND price_numeric > 200, false)"
    lowr = "coalesce(rating_numeric < 3 AND reviews_count > 50, false)"
    typo = f"({_contains_any_sql(t, C.COMMON_TYPOS)} AND NOT contains({t}, 'cartucho hp'))"
    gen = _contains_any_sql(s, C.GENERIC_SELLERS)
    return f"""
WITH lp AS (SELECT *, {price_locale_sql('price')} AS price_numeric FROM listings),
f AS (SELECT *, {off} AS r1, {okw} AS r2, {highp} AS r4h, {skw} AS r3, {lowp} AS r4l, {lowr} AS r5,
             {typo} AS r6, {gen} AS r7 FROM lp),
g AS (SELECT *, (r1 OR r2 OR r4h) AS is_o, (r3 OR r4l OR r5 OR r6 OR r7) AS is_s,
  (CASE WHEN r1 THEN 0.4e0 ELSE 0e0 END) + (CASE WHEN r2 THEN 0.3e0 ELSE 0e0 END) + (CASE WHEN r4h THEN 0.1e0 ELSE 0e0 END) AS w_o,
  (CASE WHEN r3 THEN 0.4e0 ELSE 0e0 END) + (CASE WHEN r4l THEN 0.3e0 ELSE 0e0 END) + (CASE WHEN r5 THEN 0.2e0 ELSE 0e0 END)
   + (CASE WHEN r6 THEN 0.1e0 ELSE 0e0 END) + (CASE WHEN r7 THEN 0.1e0 ELSE 0e0 END) AS w_s FROM f),
labelled_listings AS (SELECT listing_id, title, description, seller_name, platform, price, rating_numeric,
  reviews_count, url, scraped_at, price_numeric,
  CASE WHEN is_o AND NOT is_s THEN 'original' WHEN is_s AND NOT is_o THEN 'pirate/suspicious'
       WHEN is_o AND is_s THEN 'mixed_signals' ELSE 'unknown' END AS label,
  CASE WHEN is_o AND NOT is_s THEN least(w_o, 1e0) WHEN is_s AND NOT is_o THEN least(w_s, 1e0)
       WHEN is_o AND is_s THEN 0.5e0 ELSE 0e0 END AS confidence FROM g)
"""


LABELLED_SQL = heuristic_label_sql()


@register("heuristic_label", LABELLED_SQL + """
SELECT listing_id, label, round(confidence, 6) AS confidence, price_numeric FROM labelled_listings""")
def q_heuristic_label(spark, sf_dir):
    return labelled_listings(spark, sf_dir).select(
        "listing_id", "label", F.round("confidence", 6).alias("confidence"), "price_numeric")


@register("label_summary", LABELLED_SQL + """
SELECT label, count(*) AS n, round(avg(confidence), 6) AS mean_confidence
FROM labelled_listings GROUP BY label""")
def q_label_summary(spark, sf_dir):
    """Flagship: label every listing, count and mean confidence by label."""
    return labelled_listings(spark, sf_dir).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


@register("label_distribution", LABELLED_SQL + """
SELECT label, count(*) AS count FROM labelled_listings GROUP BY label""")
def q_label_distribution(spark, sf_dir):
    return labelled_listings(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("count"))


# ----------------------------------------------------------- scalar cleaning --
from vitrine import config as C  # noqa: E402
from vitrine.functions import text as TX  # noqa: E402
from vitrine.operators import textfeat as TF  # noqa: E402
from vitrine.plans import sqlbits as S  # noqa: E402


@register("price_simple", f"SELECT listing_id, {S.price_simple('price')} AS price_cleaned FROM listings")
def q_price_simple(spark, sf_dir):
    return FX.listings(spark, sf_dir).select("listing_id", TX.price_simple("price").alias("price_cleaned"))


@register("text_normalize", f"SELECT doc_id, {S.normalize_ws('description')} AS description FROM texts")
def q_text_normalize(spark, sf_dir):
    return FX.texts(spark, sf_dir).select("doc_id", TX.normalize_ws("description").alias("description"))


@register("clean_table", f"""
SELECT title, description, seller_name, platform, price, reviews_count, rating, url, scraped_at,
  {S.price_simple('price')} AS price_cleaned FROM (
  SELECT DISTINCT {S.normalize_ws('title')} AS title, {S.normalize_ws('description')} AS description,
    {S.normalize_ws('seller_name')} AS seller_name, platform, price,
    coalesce(TRY_CAST(CAST(reviews_count AS VARCHAR) AS DOUBLE), 0e0) AS reviews_count,
    coalesce(TRY_CAST(CAST(rating_numeric AS VARCHAR) AS DOUBLE), 0e0) AS rating, url, scraped_at
  FROM (SELECT DISTINCT title, description, seller_name, platform, price, reviews_count, rating_numeric, url, scraped_at
        FROM listings))""")
def q_clean_table(spark, sf_dir):
    raw = FX.listings(spark, sf_dir).drop("listing_id").withColumnRenamed("rating_numeric", "rating")
    return CL.clean_table(raw)


@register("price_locale", f"SELECT listing_id, price, {price_locale_sql('price')} AS price_numeric FROM listings")
def q_price_locale(spark, sf_dir):
    return FX.listings(spark, sf_dir).select("listing_id", "price", TX.price_locale("price").alias("price_numeric"))


@register("rating_parse", f"SELECT listing_id, {S.rating_parse('price')} AS rating_numeric FROM listings")
def q_rating_parse(spark, sf_dir):
    return FX.listings(spark, sf_dir).select("listing_id", TX.rating_parse("price").alias("rating_numeric"))


@register("reviews_parse", f"SELECT listing_id, {S.reviews_parse('price')} AS reviews_count FROM listings")
def q_reviews_parse(spark, sf_dir):
    return FX.listings(spark, sf_dir).select("listing_id", TX.reviews_parse("price").alias("reviews_count"))


@register("product_type", f"""SELECT listing_id,
  {S.first_keyword("lower(coalesce(title, ''))", C.PRODUCT_TYPES, C.PRODUCT_TYPE_OTHER)} AS product_type FROM listings""")
def q_product_type(spark, sf_dir):
    return FX.listings(spark, sf_dir).select("listing_id", CL.product_type("title").alias("product_type"))


def _raw_listing_text(spark, sf_dir, listings=FX.listings):
    """Raw collected record: every field as text, as a collector delivers it."""
    return listings(spark, sf_dir, heavy=True).select(
        "listing_id", "title", "description", "price", "seller_name",
        F.concat(F.col("rating_numeric").cast("string"), F.lit(" estrelas")).alias("rating"),
        F.concat(F.col("reviews_count").cast("string"), F.lit(" avaliações")).alias("reviews_count"),
        F.when(F.col("listing_id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("platform")).alias("platform"),
        "url")


RAW_TEXT_SQL = """raw AS (SELECT listing_id, title, description, price, seller_name,
  CAST(rating_numeric AS VARCHAR) || ' estrelas' AS rating, CAST(reviews_count AS VARCHAR) || ' avaliações' AS reviews_count,
  CASE WHEN listing_id % 3 = 0 THEN NULL ELSE platform END AS platform, url FROM listings)"""


@register("listing_clean", f"""WITH {RAW_TEXT_SQL}
SELECT listing_id, substr({S.normalize_ws('title')}, 1, 500) AS title,
  substr({S.normalize_ws('description')}, 1, 2000) AS description,
  {price_locale_sql('price')} AS price_numeric,
  substr({S.normalize_ws('seller_name')}, 1, 200) AS seller_name, {S.rating_parse('rating')} AS rating_numeric,
  {S.reviews_parse('reviews_count')} AS reviews_count, coalesce(platform, 'mercadolivre') AS platform,
  coalesce(url, '') AS url FROM raw""")
def q_listing_clean(spark, sf_dir):
    return CL.listing_clean(_raw_listing_text(spark, sf_dir))


def _fd_sql(f, e):
    if f in C.STRING_FIELDS:
        return f"trim(coalesce(CAST({e} AS VARCHAR), ''))"
    if f in C.FLOAT_FIELDS:
        return f"CASE WHEN {e} IS NULL OR CAST({e} AS VARCHAR) = '' THEN 0e0 ELSE TRY_CAST(CAST({e} AS VARCHAR) AS DOUBLE) END"
    return (f"CASE WHEN {e} IS NULL OR CAST({e} AS VARCHAR) = '' THEN 0 "
            f"ELSE CAST(trunc(TRY_CAST(CAST({e} AS VARCHAR) AS DOUBLE)) AS INTEGER) END")


FD_INPUT_SQL = """fd_in AS (SELECT listing_id, title, description, price AS price_numeric, rating_numeric,
  reviews_count, platform, seller_name FROM listings)"""


def _fd_input(spark, sf_dir):
    return FX.listings(spark, sf_dir).select(
        "listing_id", "title", "description", F.col("price").alias("price_numeric"), "rating_numeric",
        "reviews_count", "platform", "seller_name")


_FD_FIELDS = ["title", "description", "price_numeric", "rating_numeric", "reviews_count", "platform", "seller_name"]


@register("field_defaults", f"WITH {FD_INPUT_SQL} SELECT listing_id, "
          + ", ".join(f"{_fd_sql(f, f)} AS {f}" for f in _FD_FIELDS) + " FROM fd_in")
def q_field_defaults(spark, sf_dir):
    return CL.field_defaults(_fd_input(spark, sf_dir))


def _dflt_sql(f):
    v = C.DEFAULT_VALUES[f]
    return S.q(v) if isinstance(v, str) else ("0e0" if isinstance(v, float) else "0")


_RD_SQL = (f"WITH {FD_INPUT_SQL}, c AS (SELECT listing_id, "
           + ", ".join(f"{_fd_sql(f, f)} AS {f}" for f in _FD_FIELDS) + " FROM fd_in) SELECT listing_id, "
           + ", ".join(f"coalesce({f}, {_dflt_sql(f)}) AS {f}" for f in _FD_FIELDS)
           + ", 'product_type' AS missing_fields, "
           + "coalesce(nullif(concat_ws(',', " + ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in _FD_FIELDS)
           + "), ''), '') AS invalid_fields, 'unknown' AS product_type FROM c")


def _record_defaults_flat(spark, sf_dir):
    r = CL.record_defaults(_fd_input(spark, sf_dir))
    return r.withColumns({"missing_fields": F.array_join("missing_fields", ","),
                          "invalid_fields": F.array_join("invalid_fields", ",")})


@register("record_defaults", _RD_SQL)
def q_record_defaults(spark, sf_dir):
    return _record_defaults_flat(spark, sf_dir)


@register("range_clamp", _RD_SQL.replace(" SELECT listing_id, coalesce(", " , d AS (SELECT listing_id, coalesce(", 1)
          .replace("'unknown' AS product_type FROM c", "'unknown' AS product_type FROM c)") + """
SELECT listing_id, title, description, missing_fields, invalid_fields, product_type, platform, seller_name,
  CASE WHEN price_numeric < 0 THEN 0e0 ELSE price_numeric END AS price_numeric,
  CASE WHEN rating_numeric IS NOT NULL THEN greatest(0e0, least(5e0, rating_numeric)) END AS rating_numeric,
  CASE WHEN reviews_count < 0 THEN 0 ELSE reviews_count END AS reviews_count,
  concat_ws('|', CASE WHEN price_numeric < 0 THEN 'Negative price detected, setting to 0' END,
    CASE WHEN rating_numeric < 0 OR rating_numeric > 5 THEN 'Rating out of range [0-5], clamping' END,
    CASE WHEN reviews_count < 0 THEN 'Negative reviews count, setting to 0' END,
    CASE WHEN length(title) > 10000 THEN 'title too long, truncating' END,
    CASE WHEN length(description) > 10000 THEN 'description too long, truncating' END) AS warnings
FROM d""")
def q_range_clamp(spark, sf_dir):
    r = CL.range_clamp(_record_defaults_flat(spark, sf_dir))
    return r.withColumn("warnings", F.array_join("warnings", "|"))


def _reject_input(spark, sf_dir):
    return FX.listings(spark, sf_dir).select(
        "listing_id", F.when(F.col("listing_id") % 23 == 0, F.lit("")).otherwise(F.col("title")).alias("title"),
        "description", "price", (F.col("rating_numeric") * 1.25).cast("string").alias("rating"),
        (F.col("reviews_count") - 250).cast("string").alias("reviews_count"))


@register("reject_reason", """
WITH r AS (SELECT listing_id, CASE WHEN listing_id % 23 = 0 THEN '' ELSE title END AS title, description, price,
  CAST(rating_numeric * 1.25e0 AS VARCHAR) AS rating, CAST(reviews_count - 250 AS VARCHAR) AS reviews_count FROM listings)
SELECT listing_id, CASE WHEN title IS NULL OR title = '' THEN 'Missing required fields: title'
  WHEN price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL THEN 'Price must be a valid number'
  WHEN rating IS NOT NULL AND TRY_CAST(rating AS DOUBLE) IS NULL THEN 'Rating must be a valid number'
  WHEN rating IS NOT NULL AND (TRY_CAST(rating AS DOUBLE) < 0 OR TRY_CAST(rating AS DOUBLE) > 5) THEN 'Rating must be between 0 and 5'
  WHEN reviews_count IS NOT NULL AND TRY_CAST(trim(reviews_count) AS INTEGER) IS NULL THEN 'Reviews count must be a valid integer'
  WHEN reviews_count IS NOT NULL AND TRY_CAST(trim(reviews_count) AS INTEGER) < 0 THEN 'Reviews count must be non-negative'
  WHEN length(title) > 500 THEN 'Title must be less than 500 characters'
  WHEN length(description) > 2000 THEN 'Description must be less than 2000 characters' END AS reject_reason
FROM r""")
def q_reject_reason(spark, sf_dir):
    return CL.reject_reason(_reject_input(spark, sf_dir)).select("listing_id", "reject_reason")


@register("structured_dataset", LABELLED_SQL + """
SELECT coalesce(title, '') AS title, coalesce(description, '') AS description, coalesce(seller_name, '') AS seller_name,
  coalesce(platform, '') AS platform, coalesce(price_numeric, 0e0) AS price_numeric,
  coalesce(rating_numeric, 0e0) AS rating_numeric, coalesce(reviews_count, 0) AS reviews_count,
  CAST(NULL AS BOOLEAN) AS is_original, CAST(NULL AS BOOLEAN) AS is_xl, '' AS product_type,
  CAST(NULL AS BOOLEAN) AS has_sealed_info, CAST(NULL AS BOOLEAN) AS has_invoice_info,
  CAST(NULL AS BOOLEAN) AS has_warranty_info, CASE WHEN label = 'original' THEN 1 ELSE 0 END AS target_is_original
FROM labelled_listings""")
def q_structured_dataset(spark, sf_dir):
    return CL.structured_dataset(labelled_listings(spark, sf_dir))


@register("valid_listing", f"""SELECT listing_id, title FROM listings
WHERE coalesce(title, '') <> '' AND coalesce(url, '') <> '' AND {S.contains_any("lower(coalesce(title, ''))", C.HP_KEYWORDS)}""")
def q_valid_listing(spark, sf_dir):
    return CL.valid_listing(FX.listings(spark, sf_dir)).select("listing_id", "title")


# ------------------------------------------------------------ enrichment --
_TD = "lower(concat_ws(' ', coalesce(title, ''), coalesce(description, '')))"
_DS = "lower(concat_ws(' ', coalesce(description, ''), ''))"
LISTING_CLASS_SQL = (f"CASE WHEN contains({_TD}, 'original') AND NOT contains({_TD}, 'compativel') THEN 'Original' "
                     f"WHEN contains({_TD}, 'compativel') THEN 'Compatível' "
                     f"WHEN {S.contains_any(_TD, C.CLASS_SUSPECT_WORDS)} THEN 'Suspeito' ELSE 'Não Classificado' END")
MODELO_SQL = f"upper(nullif(regexp_extract({_DS}, 'modelo:?\\s*([a-z0-9\\-]+)', 1), ''))"
COR_SQL = S.capitalize(f"nullif(regexp_extract({_DS}, 'cor:?\\s*(preto|colorido|tricolor|magenta|ciano|amarelo)', 1), '')")
REND_SQL = f"TRY_CAST(nullif(regexp_extract({_DS}, 'rendimento:?\\s*(\\d+)\\s*paginas', 1), '') AS INTEGER)"
FLAGS_SQL = (f"{S.contains_any(_TD, C.SEALED_WORDS)} AS tem_lacrado, {S.contains_any(_TD, C.INVOICE_WORDS)} AS tem_nota_fiscal, "
             f"{S.contains_any(_TD, C.WARRANTY_WORDS)} AS tem_garantia")


@register("listing_class", f"SELECT listing_id, {LISTING_CLASS_SQL} AS classificacao_produto FROM listings")
def q_listing_class(spark, sf_dir):
    return FX.listings(spark, sf_dir).select("listing_id", LB.listing_class().alias("classificacao_produto"))


@register("attribute_extract", f"SELECT listing_id, {MODELO_SQL} AS modelo, {COR_SQL} AS cor, {REND_SQL} AS rendimento_paginas FROM listings")
def q_attribute_extract(spark, sf_dir):
    return FX.listings(spark, sf_dir).select("listing_id", *[v.alias(k) for k, v in LB.attribute_columns().items()])


@register("trust_flags", f"SELECT listing_id, {FLAGS_SQL} FROM listings")
def q_trust_flags(spark, sf_dir):
    return FX.listings(spark, sf_dir).select("listing_id", *[v.alias(k) for k, v in LB.trust_flag_columns().items()])


@register("enrich_table", f"""SELECT listing_id, title, platform, {LISTING_CLASS_SQL} AS classificacao_produto,
  {MODELO_SQL} AS modelo, {COR_SQL} AS cor, {REND_SQL} AS rendimento_paginas, {FLAGS_SQL} FROM listings""")
def q_enrich_table(spark, sf_dir):
    return LB.enrich_table(FX.listings(spark, sf_dir, heavy=True).select("listing_id", "title", "description", "platform")).drop("description")


# --------------------------------------------------------- text features --
def _text_length_sql(c):
    w = f"list_filter(string_split_regex(coalesce({c}, ''), '\\s+'), lambda w: w <> '')"
    return (f"CAST(length(coalesce({c}, '')) AS INTEGER) AS {c}_char_count, CAST(length({w}) AS INTEGER) AS {c}_word_count, "
            f"CASE WHEN length({w}) > 0 THEN CAST(list_sum(list_transform({w}, lambda x: length(x))) AS DOUBLE) / length({w}) ELSE 0e0 END AS {c}_avg_word_length, "
            f"CAST(length(list_filter({w}, lambda x: upper(x) = x AND lower(x) <> x)) AS INTEGER) AS {c}_uppercase_count")


@register("text_length", f"SELECT doc_id, {_text_length_sql('title')}, {_text_length_sql('description')} FROM texts")
def q_text_length(spark, sf_dir):
    t = TF.text_length(FX.texts(spark, sf_dir))
    return t.select("doc_id", *[c for c in t.columns if c.startswith(("title_", "description_"))])


def _kw_sql(c):
    low = f"lower(coalesce({c}, ''))"
    parts = [f"CAST({S.contains_any(low, ws)} AS INTEGER) AS {c}_has_{n}" for n, ws in C.KEYWORD_GROUPS]
    parts.append(f"{S.count_contained(low, [w for _, ws in C.KEYWORD_GROUPS for w in ws])} AS {c}_authenticity_keyword_count")
    return ", ".join(parts)


@register("keyword_flags", f"SELECT listing_id, {_kw_sql('title')}, {_kw_sql('description')} FROM listings")
def q_keyword_flags(spark, sf_dir):
    t = TF.keyword_flags(FX.listings(spark, sf_dir, heavy=True).select("listing_id", "title", "description"))
    return t.drop("title", "description")
