"""Page extraction queries over the ``pages`` table (PAGE*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine import config as C
from vitrine.operators import pages as PG
from vitrine.plans.catalog import register
from vitrine.plans.sqlbits import q
from vitrine.sources.tables import table


def _pages(spark, d):
    from vitrine.functions.partitioning import spread
    return spread(table(spark, d, "pages"))


def strip_sql(e):
    return f"trim(regexp_replace(regexp_replace({e}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


def sel_sql(p):
    return f"nullif({strip_sql(f'regexp_extract(html, {q(p)}, 1)')}, '')"


def first_sql(patterns, accept=None, default=None):
    picks = [(f"CASE WHEN {accept(sel_sql(p))} THEN {sel_sql(p)} END" if accept else sel_sql(p)) for p in patterns]
    out = f"coalesce({', '.join(picks)})" if len(picks) > 1 else picks[0]
    return f"coalesce({out}, {q(default)})" if default is not None else out


def title_sql(patterns):
    return first_sql(patterns, lambda t: f"length({t}) > 5")


def price_sql(patterns):
    t = first_sql(patterns, lambda x: f"regexp_matches({x}, '[0-9]')")
    num = f"regexp_extract({t}, '([0-9]+(?:[.,][0-9]+)*)', 1)"
    sym = f"nullif(regexp_extract({t}, '(R\\$|US\\$|\\$|€)', 1), '')"
    return f"CASE WHEN {t} IS NOT NULL THEN concat_ws(' ', coalesce({sym}, 'R$'), {num}) END"


def seller_sql(patterns):
    t = first_sql(patterns, lambda x: f"length({x}) > 2")
    return f"coalesce({t}, nullif(trim(regexp_extract(html, {q(C.SELLER_FALLBACK)}, 1)), ''))"


def reviews_sql(patterns):
    t = first_sql(patterns, lambda x: f"regexp_matches({x}, '[0-9]')")
    return f"TRY_CAST(regexp_extract({t}, '([0-9]+)', 1) AS INTEGER)"


def rating_sql(patterns):
    attr = "nullif(regexp_extract(html, 'data-rating=\"([^\"]*[0-9][^\"]*)\"', 1), '')"
    return f"coalesce({attr}, {first_sql(patterns, lambda x: f'regexp_matches({x}, {q(chr(91) + '0-9' + chr(93))})')})"


def description_sql():
    frags = f"list_transform(regexp_extract_all(html, '(?s)<p[^>]*>(.*?)</p>', 1), lambda x: {strip_sql('x')})"
    good = f"list_filter({frags}, lambda x: length(x) > 20)"
    body = "regexp_replace(regexp_extract(html, '(?s)<body[^>]*>(.*)</body>', 1), '<[^>]+>', chr(10), 'g')"
    kw = "|".join(C.DESCRIPTION_KEYWORDS)
    fb = f"list_filter(list_transform(string_split({body}, chr(10)), lambda x: trim(x)), lambda x: length(x) > 30 AND length(x) < 200 AND regexp_matches(lower(x), '{kw}'))"
    chosen = f"CASE WHEN len({good}) > 0 THEN {good} ELSE {fb} END"
    return f"nullif(array_to_string(list_slice({chosen}, 1, 3), ' | '), '')"


def specs_sql():
    items = f"list_transform(regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1), lambda x: {strip_sql('x')})"
    return f"array_to_string(list_slice(list_filter({items}, lambda x: length(x) > 5 AND length(x) < 100), 1, 8), ' | ')"


def images_sql():
    srcs = "regexp_extract_all(html, '<img[^>]+src=\"([^\"]+)\"', 1)"
    return f"array_to_string(list_slice(list_filter({srcs}, lambda s: contains(s, 'http') AND contains(s, 'cdn')), 1, 3), ' | ')"


A = C.SITE_A


@register("page_title", f"SELECT page_id, {title_sql(A['title'])} AS title FROM pages")
def q_page_title(spark, d):
    return _pages(spark, d).select("page_id", PG.page_title(F.col("html")).alias("title"))


@register("page_price", f"SELECT page_id, {price_sql(A['price'])} AS price FROM pages")
def q_page_price(spark, d):
    return _pages(spark, d).select("page_id", PG.page_price(F.col("html")).alias("price"))


@register("page_seller", f"SELECT page_id, {seller_sql(A['seller'])} AS seller_name FROM pages")
def q_page_seller(spark, d):
    return _pages(spark, d).select("page_id", PG.page_seller(F.col("html")).alias("seller_name"))


@register("page_first_match", f"SELECT page_id, {first_sql(A['reputation'], default='')} AS seller_reputation, "
          f"{first_sql(A['availability'], default='')} AS availability, {first_sql(A['shipping'], default='')} AS shipping_info FROM pages")
def q_page_first_match(spark, d):
    h = F.col("html")
    return _pages(spark, d).select("page_id", PG.first_match(h, A["reputation"], default="").alias("seller_reputation"),
                                   PG.first_match(h, A["availability"], default="").alias("availability"),
                                   PG.first_match(h, A["shipping"], default="").alias("shipping_info"))


@register("page_reviews", f"SELECT page_id, {reviews_sql(A['reviews'])} AS reviews_count, {rating_sql(A['rating'])} AS rating FROM pages")
def q_page_reviews(spark, d):
    h = F.col("html")
    return _pages(spark, d).select("page_id", PG.page_reviews(h).alias("reviews_count"), PG.page_rating(h).alias("rating"))


@register("page_description", f"SELECT page_id, {description_sql()} AS description FROM pages")
def q_page_description(spark, d):
    return _pages(spark, d).select("page_id", PG.page_description(F.col("html")).alias("description"))


@register("page_specs", f"SELECT page_id, {specs_sql()} AS specifications, {images_sql()} AS images FROM pages")
def q_page_specs(spark, d):
    h = F.col("html")
    return _pages(spark, d).select("page_id", PG.page_specs(h).alias("specifications"), PG.page_images(h).alias("images"))


@register("page_links", """WITH e AS (SELECT page_id, unnest(l) AS href, unnest(range(1, len(l) + 1)) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages)),
f AS (SELECT page_id, href, min(pos) AS pos FROM e WHERE regexp_matches(href, '^/') GROUP BY page_id, href),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) AS INTEGER) AS link_rank FROM f)
SELECT page_id, href, CAST(pos - 1 AS INTEGER) AS pos, link_rank FROM r WHERE link_rank <= 10""")
def q_page_links(spark, d):
    return PG.page_links(_pages(spark, d))


def _record_sql(site, platform):
    return (f"SELECT {title_sql(site['title'])} AS title, {price_sql(site['price'])} AS price, {seller_sql(site['seller'])} AS seller_name, "
            f"{first_sql(site['reputation'], default='')} AS seller_reputation, {reviews_sql(site['reviews'])} AS reviews_count, "
            f"{rating_sql(site['rating'])} AS rating, url, '{platform}' AS platform, {description_sql()} AS description, "
            f"{specs_sql()} AS specifications, {images_sql()} AS images, {first_sql(site['availability'], default='')} AS availability, "
            f"{first_sql(site['shipping'], default='')} AS shipping_info, page_id FROM pages")


@register("page_record", _record_sql(A, "site_a"))
def q_page_record(spark, d):
    return PG.page_record(_pages(spark, d))


@register("page_record_site2", _record_sql(C.SITE_B, "site_b"))
def q_page_record_site2(spark, d):
    """Second site: its own selector map, rating comma to dot (PAGE16)."""
    return PG.page_record(_pages(spark, d), C.SITE_B, "site_b", comma_rating=True)


@register("raw_trim", "SELECT page_id, trim(regexp_replace(price, '\\s+', ' ', 'g')) AS price, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title, "
          "substr(trim(regexp_replace(description, '\\s+', ' ', 'g')), 1, 500) AS description, "
          "substr(trim(regexp_replace(specifications, '\\s+', ' ', 'g')), 1, 1000) AS specifications FROM (" + _record_sql(A, "site_a") + ")")
def q_raw_trim(spark, d):
    return PG.raw_trim(PG.page_record(_pages(spark, d))).select("page_id", "price", "title", "description", "specifications")


@register("page_images", f"SELECT page_id, {images_sql()} AS images FROM pages")
def q_page_images(spark, d):
    """img src values with http and the CDN name, first 3 joined (PAGE10)."""
    return _pages(spark, d).select("page_id", PG.page_images(F.col("html")).alias("images"))
