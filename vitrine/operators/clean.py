"""Scalar cleaning, projections and filters (CLN*, FIL*).

Each operator is a single narrow projection or filter: it fuses into one
whole-stage-codegen span with the scan, needs no shuffle and scales with the
number of input splits.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import config as C
from vitrine.functions.text import (contains_any, first_keyword, normalize_ws, price_locale,
                                    price_simple, rating_parse, reviews_parse)


def clean_table(df: DataFrame, text_columns: Sequence[str] = tuple(C.CLEAN_TEXT_COLUMNS),
                numeric_columns: Sequence[str] = ("reviews_count", "rating"),
                price_column: str = "price") -> DataFrame:
    """Exact-row dedup, price_cleaned, whitespace-normalised text, numeric coercion (CLN3)."""
    out = df.dropDuplicates()
    cols = {}
    if price_column in df.columns:
        cols["price_cleaned"] = price_simple(price_column)
    for c in text_columns:
        if c in df.columns:
            cols[c] = normalize_ws(c)
    for c in numeric_columns:
        if c in df.columns:
            cols[c] = F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0))
    return out.withColumns(cols)


def product_type(title, types: Sequence[str] = tuple(C.PRODUCT_TYPES),
                 other: str = C.PRODUCT_TYPE_OTHER) -> Column:
    """First product type word found in the lowered title (CLN7)."""
    t = F.lower(F.coalesce(F.col(title) if isinstance(title, str) else title, F.lit("")))
    return first_keyword(t, types, other)


def listing_clean(df: DataFrame, rating_col: str = "rating", reviews_col: str = "reviews_count",
                  default_platform: str = C.DEFAULT_PLATFORM) -> DataFrame:
    """Service-side cleaning of raw listing text (CLN8)."""
    keep = [c for c in df.columns if c not in {"title", "description", "price", "seller_name",
                                               rating_col, reviews_col, "platform", "url"}]
    return df.select(
        *keep,
        F.substring(normalize_ws("title"), 1, C.TITLE_MAX).alias("title"),
        F.substring(normalize_ws("description"), 1, C.DESCRIPTION_MAX).alias("description"),
        price_locale("price").alias("price_numeric"),
        F.substring(normalize_ws("seller_name"), 1, C.SELLER_MAX).alias("seller_name"),
        rating_parse(rating_col).alias("rating_numeric"),
        reviews_parse(reviews_col).alias("reviews_count"),
        F.coalesce(F.col("platform"), F.lit(default_platform)).alias("platform"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"))


def _field_clean(name: str, c: Column) -> Column:
    """Per-field cast: null/blank -> default of the type, failed cast -> null (CLN9)."""
    if name in C.STRING_FIELDS:
        return F.trim(F.coalesce(c.cast("string"), F.lit("")))
    s = c.cast("string")
    blank = s.isNull() | (s == "")
    if name in C.FLOAT_FIELDS:
        return F.when(blank, F.lit(0.0)).otherwise(s.try_cast("double"))
    if name in C.INT_FIELDS:
        return F.when(blank, F.lit(0)).otherwise(s.try_cast("double").cast("int"))
    return c


def field_defaults(df: DataFrame, fields: Sequence[str] = tuple(C.EXPECTED_COLUMNS)) -> DataFrame:
    present = [f for f in fields if f in df.columns]
    others = [c for c in df.columns if c not in present]
    return df.select(*others, *[_field_clean(f, F.col(f)).alias(f) for f in present])


def record_defaults(df: DataFrame, fields: Sequence[str] = tuple(C.EXPECTED_COLUMNS)) -> DataFrame:
    """Fill the expected fields; list missing and invalid ones per row (CLN10)."""
    missing = [f for f in fields if f not in df.columns]
    cleaned = {f: _field_clean(f, F.col(f)) for f in fields if f in df.columns}
    invalid = F.array_compact(F.array(*[F.when(v.isNull(), F.lit(f)) for f, v in cleaned.items()])) \
        if cleaned else F.array().cast("array<string>")
    out = {f: F.coalesce(v, F.lit(C.DEFAULT_VALUES[f])) for f, v in cleaned.items()}
    for f in missing:
        out[f] = F.lit(C.DEFAULT_VALUES[f])
    others = [c for c in df.columns if c not in cleaned]
    return df.select(*others, *[out[f].alias(f) for f in fields],
                     F.array(*[F.lit(m) for m in missing]).cast("array<string>").alias("missing_fields"),
                     invalid.alias("invalid_fields"))


def range_clamp(df: DataFrame, text_fields: Sequence[str] = ("title", "description"),
                text_max: int = C.TEXT_MAX) -> DataFrame:
    """Business clamps with a warnings array (CLN11)."""
    p, r, n = F.col("price_numeric"), F.col("rating_numeric"), F.col("reviews_count")
    warns = [F.when(p < 0, F.lit(C.WARN_NEGATIVE_PRICE)),
             F.when((r < 0) | (r > 5), F.lit(C.WARN_RATING_RANGE)),
             F.when(n < 0, F.lit(C.WARN_NEGATIVE_REVIEWS))]
    warns += [F.when(F.length(F.col(t)) > text_max, F.lit(f"{t} too long, truncating")) for t in text_fields]
    cols = {"price_numeric": F.when(p < 0, F.lit(0.0)).otherwise(p),
            "rating_numeric": F.when(r.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(5.0), r))),
            "reviews_count": F.when(n < 0, F.lit(0)).otherwise(n)}
    for t in text_fields:
        cols[t] = F.substring(F.col(t), 1, text_max)
    return df.withColumn("warnings", F.array_compact(F.array(*warns))).withColumns(cols)


def reject_reason(df: DataFrame, title: str = "title", price: str = "price", rating: str = "rating",
                  reviews: str = "reviews_count", description: str = "description") -> DataFrame:
    """First failing request rule as ``reject_reason`` (null = valid) (CLN12)."""
    t = F.col(title)
    pr = F.col(price).cast("string")
    ra = F.col(rating).cast("string")
    rv = F.col(reviews).cast("string")
    rnum = ra.try_cast("double")
    rint = F.trim(rv).try_cast("int")
    reason = (F.when(t.isNull() | (t == ""), F.lit(C.REJECT_TITLE_MISSING))
              .when(pr.isNotNull() & pr.try_cast("double").isNull(), F.lit(C.REJECT_PRICE))
              .when(ra.isNotNull() & rnum.isNull(), F.lit(C.REJECT_RATING))
              .when(ra.isNotNull() & ((rnum < 0) | (rnum > 5)), F.lit(C.REJECT_RATING_RANGE))
              .when(rv.isNotNull() & rint.isNull(), F.lit(C.REJECT_REVIEWS))
              .when(rv.isNotNull() & (rint < 0), F.lit(C.REJECT_REVIEWS_NEGATIVE))
              .when(F.length(t) > C.TITLE_MAX, F.lit(C.REJECT_TITLE_LONG))
              .when(F.length(F.col(description)) > C.DESCRIPTION_MAX, F.lit(C.REJECT_DESCRIPTION_LONG)))
    return df.withColumn("reject_reason", reason)


def split_rejects(df: DataFrame):
    """(good, bad) frames of ``reject_reason``; both are lazy filters of one plan."""
    r = reject_reason(df)
    return r.where(F.col("reject_reason").isNull()), r.where(F.col("reject_reason").isNotNull())


def structured_dataset(df: DataFrame, features: Sequence[str] = tuple(C.STRUCTURED_FEATURES),
                       label_col: str = "label") -> DataFrame:
    """14 model columns, absent ones null, binary target, typed null fills (CLN13)."""
    types = {"price_numeric": "double", "rating_numeric": "double", "reviews_count": "int",
             "is_original": "boolean", "is_xl": "boolean", "has_sealed_info": "boolean",
             "has_invoice_info": "boolean", "has_warranty_info": "boolean"}
    cols = []
    for f in features:
        c = F.col(f) if f in df.columns else F.lit(None)
        c = c.cast(types.get(f, "string"))
        if f in ("price_numeric", "rating_numeric"):
            c = F.coalesce(c, F.lit(0.0))
        elif f == "reviews_count":
            c = F.coalesce(c, F.lit(0))
        elif f in ("title", "description", "seller_name", "platform", "product_type"):
            c = F.coalesce(c, F.lit(""))
        cols.append(c.alias(f))
    target = F.when(F.col(label_col) == C.LABEL_ORIGINAL, 1).otherwise(0) if label_col in df.columns \
        else F.lit(0)
    return df.select(*cols, target.cast("int").alias("target_is_original"))


# ---------------------------------------------------------------- filters --

def valid_listing(df: DataFrame, keywords: Sequence[str] = tuple(C.HP_KEYWORDS)) -> DataFrame:
    """Title and url non-empty, title names the brand (FIL1)."""
    t = F.coalesce(F.col("title"), F.lit(""))
    u = F.coalesce(F.col("url"), F.lit(""))
    return df.where((t != "") & (u != "") & contains_any(F.lower(t), keywords))


def listing_filter(df: DataFrame, prediction: str | None = None, min_confidence: float | None = None,
                   date_from=None, date_to=None) -> DataFrame:
    """Optional conjuncts; a confidence of 0 counts as no filter (FIL2).

    The predicate is one Column, so Catalyst pushes it into the parquet scan.
    """
    conds = []
    if prediction:
        conds.append(F.col("prediction") == prediction)
    if min_confidence:
        conds.append(F.col("confidence_score") >= F.lit(float(min_confidence)))
    if date_from is not None:
        conds.append(F.col("scraped_at") >= F.lit(date_from).cast("timestamp_ntz"))
    if date_to is not None:
        conds.append(F.col("scraped_at") <= F.lit(date_to).cast("timestamp_ntz"))
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def event_filter(df: DataFrame, types: Sequence[str] = tuple(C.PERFORMANCE_EVENT_TYPES),
                 col: str = "event_type") -> DataFrame:
    """Keep a class of event types (FIL3)."""
    return df.where(F.col(col).isin(list(types)))


def severity_filter(df: DataFrame, min_level: int = 30, col: str = "level") -> DataFrame:
    """Keep warning and above (FIL3 severity variant)."""
    return df.where(F.col(col) >= min_level)


def retention_split(df: DataFrame, ts_col: str, as_of: Column, days: int,
                    status_in: Sequence[str] | None = None):
    """(kept, deleted) frames of a retention rule (FIL5, FIL7). ``as_of`` is a
    Column (e.g. a scalar subquery result), never the wall clock."""
    cutoff = F.timestamp_add("DAY", F.lit(-days), as_of)
    old = F.col(ts_col) < cutoff
    if status_in:
        old = old & F.col("status").isin(list(status_in))
    return df.where(~old | old.isNull()), df.where(old)
