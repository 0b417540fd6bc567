"""Enrichment and heuristic labelling (TXT6-TXT10).

The labeller replaces a per-row loop by two boolean sums and a CASE chain:
one narrow projection, no UDF, no shuffle; it runs at scan speed on any number
of partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import config as C
from vitrine.config import LabelRules
from vitrine.functions.text import contains_any, extract_or_null, lower_or_empty


def _joined_lower(a: str, b: str) -> Column:
    return F.lower(F.concat_ws(" ", F.coalesce(F.col(a), F.lit("")), F.coalesce(F.col(b), F.lit(""))))


def listing_class(title: str = "title", description: str = "description") -> Column:
    """Original / Compatível / Suspeito / Não Classificado (TXT6)."""
    t = _joined_lower(title, description)
    return (F.when(t.contains(C.CLASS_ORIGINAL_WORD) & ~t.contains(C.CLASS_COMPATIBLE_WORD),
                   F.lit(C.CLASS_ORIGINAL))
            .when(t.contains(C.CLASS_COMPATIBLE_WORD), F.lit(C.CLASS_COMPATIBLE))
            .when(contains_any(t, C.CLASS_SUSPECT_WORDS), F.lit(C.CLASS_SUSPECT))
            .otherwise(F.lit(C.CLASS_UNCLASSIFIED)))


def attribute_columns(description: str = "description", specifications: str | None = None) -> dict:
    """Model token, colour and page yield from description + specs (TXT7)."""
    spec = F.col(specifications) if specifications else F.lit("")
    t = F.lower(F.concat_ws(" ", F.coalesce(F.col(description), F.lit("")), F.coalesce(spec, F.lit(""))))
    return {
        "modelo": F.upper(extract_or_null(t, C.MODEL_PATTERN)),
        "cor": F.initcap(extract_or_null(t, C.COLOR_PATTERN)),
        "rendimento_paginas": extract_or_null(t, C.YIELD_PATTERN).try_cast("int"),
    }


def trust_flag_columns(title: str = "title", description: str = "description") -> dict:
    """Sealed, invoice, warranty mentions (TXT8)."""
    t = _joined_lower(title, description)
    return {"tem_lacrado": contains_any(t, C.SEALED_WORDS),
            "tem_nota_fiscal": contains_any(t, C.INVOICE_WORDS),
            "tem_garantia": contains_any(t, C.WARRANTY_WORDS)}


def enrich_table(df: DataFrame, specifications: str | None = None) -> DataFrame:
    """TXT6-TXT8 as columns in one select (TXT9)."""
    spec = specifications if specifications and specifications in df.columns else None
    cols = {"classificacao_produto": listing_class()}
    cols.update(attribute_columns(specifications=spec))
    cols.update(trust_flag_columns())
    return df.withColumns(cols)


def heuristic_label(df: DataFrame, rules: LabelRules = LabelRules(),
                    price_col: str = "price_numeric", rating_col: str = "rating_numeric",
                    reviews_col: str = "reviews_count") -> DataFrame:
    """Label each listing original / pirate/suspicious / mixed_signals / unknown (TXT10).

    Each rule is a (flag, weight) pair of columns; the label is a CASE over the
    two flag disjunctions and the confidence the capped weighted sum.
    """
    price, rating, reviews = F.col(price_col), F.col(rating_col), F.col(reviews_col)
    false = F.lit(False)
    # lowered text once per row; Catalyst keeps these as one projection
    lowered = df.withColumns({"_t": lower_or_empty("title"), "_d": lower_or_empty("description"),
                              "_s": lower_or_empty("seller_name")})
    title, desc, seller = F.col("_t"), F.col("_d"), F.col("_s")

    def either(words):
        return contains_any(title, words) | contains_any(desc, words)

    flags = {
        "_r_official": contains_any(seller, rules.official_stores),
        "_r_orig_kw": either(rules.original_keywords),
        "_r_high_price": F.coalesce(~(price < rules.low_price) & (price > rules.high_price), false),
        "_r_susp_kw": either(rules.suspicious_keywords),
        "_r_low_price": F.coalesce(price < rules.low_price, false),
        "_r_low_rating": F.coalesce((rating < rules.low_rating) & (reviews > rules.many_reviews), false),
        "_r_typo": contains_any(title, rules.typos) & ~title.contains(rules.typo_exclude),
        "_r_generic": contains_any(seller, rules.generic_sellers),
    }
    original_rules = [("_r_official", C.W_OFFICIAL), ("_r_orig_kw", C.W_ORIGINAL_KW),
                      ("_r_high_price", C.W_HIGH_PRICE)]
    suspicious_rules = [("_r_susp_kw", C.W_SUSPICIOUS_KW), ("_r_low_price", C.W_LOW_PRICE),
                        ("_r_low_rating", C.W_LOW_RATING), ("_r_typo", C.W_TYPO),
                        ("_r_generic", C.W_GENERIC_SELLER)]

    def weight_sum(rs):
        # rule order is kept so the float sum equals a left-to-right accumulation
        return reduce(lambda a, b: a + b, [F.when(F.col(f), F.lit(w)).otherwise(F.lit(0.0)) for f, w in rs])

    scored = lowered.withColumns(flags).withColumns({
        "_is_o": reduce(lambda a, b: a | b, [F.col(f) for f, _ in original_rules]),
        "_is_s": reduce(lambda a, b: a | b, [F.col(f) for f, _ in suspicious_rules]),
        "_w_o": weight_sum(original_rules), "_w_s": weight_sum(suspicious_rules)})
    is_o, is_s = F.col("_is_o"), F.col("_is_s")
    label = (F.when(is_o & ~is_s, F.lit(C.LABEL_ORIGINAL))
             .when(is_s & ~is_o, F.lit(C.LABEL_SUSPICIOUS))
             .when(is_o & is_s, F.lit(C.LABEL_MIXED))
             .otherwise(F.lit(C.LABEL_UNKNOWN)))
    conf = (F.when(is_o & ~is_s, F.least(F.col("_w_o"), F.lit(1.0)))
            .when(is_s & ~is_o, F.least(F.col("_w_s"), F.lit(1.0)))
            .when(is_o & is_s, F.lit(C.MIXED_CONFIDENCE))
            .otherwise(F.lit(0.0)))
    tmp = ["_t", "_d", "_s", "_is_o", "_is_s", "_w_o", "_w_s"] + list(flags)
    return scored.withColumns({"label": label, "confidence": conf}).drop(*tmp)
