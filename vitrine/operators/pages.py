"""Page extraction as a Spark job over a ``pages(page_id, url, html)`` table
(PAGE*). Every field is a native regex / higher-order array expression; one
``select`` builds the whole record and Catalyst drops unused fields."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine import config as C


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", " "), r"\s+", " "))


def selected_texts(html: Column, patterns: Sequence[str]) -> list:
    return [F.nullif(strip_tags(F.regexp_extract(html, p, 1)), F.lit("")) for p in patterns]


def first_match(html: Column, patterns: Sequence[str], accept=None, default=None) -> Column:
    """Text of the first selector whose text passes ``accept`` (PAGE5)."""
    texts = selected_texts(html, patterns)
    picks = [F.when(accept(t), t) if accept else t for t in texts]
    out = F.coalesce(*picks) if len(picks) > 1 else picks[0]
    return F.coalesce(out, F.lit(default)) if default is not None else out


def page_title(html: Column, patterns=tuple(C.SITE_A["title"])) -> Column:
    """First selector text longer than 5 characters (PAGE2)."""
    return first_match(html, patterns, lambda t: F.length(t) > 5)


def page_price(html: Column, patterns=tuple(C.SITE_A["price"]), currency: str = C.DEFAULT_CURRENCY) -> Column:
    """First selector holding a digit; its first number with the currency symbol (PAGE3)."""
    t = first_match(html, patterns, lambda x: x.rlike(r"[0-9]"))
    num = F.regexp_extract(t, r"([0-9]+(?:[.,][0-9]+)*)", 1)
    sym = F.nullif(F.regexp_extract(t, r"(R\$|US\$|\$|€)", 1), F.lit(""))
    return F.when(t.isNotNull(), F.concat_ws(" ", F.coalesce(sym, F.lit(currency)), num))


def page_seller(html: Column, patterns=tuple(C.SITE_A["seller"])) -> Column:
    """Selector text longer than 2, else the 'Vendido por' text of the raw page (PAGE4)."""
    t = first_match(html, patterns, lambda x: F.length(x) > 2)
    return F.coalesce(t, F.nullif(F.trim(F.regexp_extract(html, C.SELLER_FALLBACK, 1)), F.lit("")))


def page_reviews(html: Column, patterns=tuple(C.SITE_A["reviews"])) -> Column:
    """First digit run of the first selector that has one (PAGE6)."""
    t = first_match(html, patterns, lambda x: x.rlike(r"[0-9]"))
    return F.regexp_extract(t, r"([0-9]+)", 1).try_cast("int")


def page_rating(html: Column, patterns=tuple(C.SITE_A["rating"]), comma_decimal: bool = False) -> Column:
    """``data-rating`` attribute, else selector text holding a digit (PAGE7)."""
    attr = F.nullif(F.regexp_extract(html, r'data-rating="([^"]*[0-9][^"]*)"', 1), F.lit(""))
    t = F.coalesce(attr, first_match(html, patterns, lambda x: x.rlike(r"[0-9]")))
    if comma_decimal:
        t = F.replace(t, F.lit(","), F.lit("."))
    return t


def page_description(html: Column, keywords=tuple(C.DESCRIPTION_KEYWORDS)) -> Column:
    """Paragraph fragments longer than 20; fallback: body lines of 31-199
    characters holding a keyword; first 3 joined by ' | ' (PAGE8)."""
    frags = F.transform(F.regexp_extract_all(html, F.lit(r"(?s)<p[^>]*>(.*?)</p>"), 1), strip_tags)
    good = F.filter(frags, lambda x: F.length(x) > 20)
    body = F.regexp_replace(F.regexp_extract(html, r"(?s)<body[^>]*>(.*)</body>", 1), r"<[^>]+>", "\n")
    lines = F.transform(F.split(body, "\n"), lambda x: F.trim(x))
    kw = "|".join(keywords)
    fallback = F.filter(lines, lambda x: (F.length(x) > 30) & (F.length(x) < 200) & F.lower(x).rlike(kw))
    chosen = F.when(F.size(good) > 0, good).otherwise(fallback)
    return F.nullif(F.array_join(F.slice(chosen, 1, 3), " | "), F.lit(""))


def page_specs(html: Column) -> Column:
    """List items with 5 < length < 100, first 8 joined by ' | ' (PAGE9)."""
    items = F.transform(F.regexp_extract_all(html, F.lit(r"(?s)<li[^>]*>(.*?)</li>"), 1), strip_tags)
    keep = F.filter(items, lambda x: (F.length(x) > 5) & (F.length(x) < 100))
    return F.array_join(F.slice(keep, 1, 8), " | ")


def page_images(html: Column, cdn: str = C.IMAGE_CDN) -> Column:
    """img src with http and the CDN name, first 3 joined (PAGE10)."""
    srcs = F.regexp_extract_all(html, F.lit(r'<img[^>]+src="([^"]+)"'), 1)
    keep = F.filter(srcs, lambda s: s.contains("http") & s.contains(cdn))
    return F.array_join(F.slice(keep, 1, 3), " | ")


def page_links(pages: DataFrame, pattern: str = C.ITEM_LINK_PATTERN, limit: int = 10) -> DataFrame:
    """Item links per page: first-seen order, unique, first ``limit`` (PAGE1).
    The windows are per page and bounded by the page's own links."""
    ex = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r'href="([^"]+)"'), 1)).alias("pos", "href"))
    ex = ex.where(F.col("href").rlike(pattern))
    first = ex.groupBy("page_id", "href").agg(F.min("pos").alias("pos"))
    w = Window.partitionBy("page_id").orderBy("pos")
    return first.withColumn("link_rank", F.row_number().over(w)).where(F.col("link_rank") <= limit)


def raw_trim(df: DataFrame) -> DataFrame:
    """Collapse whitespace in price, title, description (500) and specs (1000) (PAGE14)."""
    def ws(c):
        return F.trim(F.regexp_replace(F.col(c), r"\s+", " "))
    return df.withColumns({"price": ws("price"), "title": ws("title"),
                           "description": F.substring(ws("description"), 1, 500),
                           "specifications": F.substring(ws("specifications"), 1, 1000)})


def page_record(pages: DataFrame, site: dict = C.SITE_A, platform: str = "site_a", comma_rating: bool = False) -> DataFrame:
    """The 14-field raw listing of each page in one select (PAGE13, PAGE16)."""
    h = F.col("html")
    return pages.select(
        page_title(h, site["title"]).alias("title"), page_price(h, site["price"]).alias("price"),
        page_seller(h, site["seller"]).alias("seller_name"),
        first_match(h, site["reputation"], default="").alias("seller_reputation"),
        page_reviews(h, site["reviews"]).alias("reviews_count"), page_rating(h, site["rating"], comma_rating).alias("rating"),
        F.col("url"), F.lit(platform).alias("platform"), page_description(h).alias("description"),
        page_specs(h).alias("specifications"), page_images(h).alias("images"),
        first_match(h, site["availability"], default="").alias("availability"),
        first_match(h, site["shipping"], default="").alias("shipping_info"), F.col("page_id"))
