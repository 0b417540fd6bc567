"""String expressions. All JVM-side, codegen friendly; no Python per row."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_ws(c, null_to_empty: bool = True) -> Column:
    """Trim and collapse every whitespace run to one space (CLN2)."""
    x = col_(c)
    if null_to_empty:
        x = F.coalesce(x, F.lit(""))
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def lower_or_empty(c) -> Column:
    return F.lower(F.coalesce(col_(c), F.lit("")))


def contains_any(c, words: Iterable[str]) -> Column:
    """True when any word is a substring of ``c`` (``c`` must be non-null)."""
    x = col_(c)
    return reduce(lambda a, b: a | b, [x.contains(w) for w in words])


def count_contained(c, words: Iterable[str]) -> Column:
    x = col_(c)
    return reduce(lambda a, b: a + b, [x.contains(w).cast("int") for w in words])


def first_keyword(c, words: Iterable[str], default: str) -> Column:
    """The first word of ``words`` that occurs in ``c``, else ``default``."""
    x = col_(c)
    out = None
    for w in words:
        out = F.when(x.contains(w), F.lit(w)) if out is None else out.when(x.contains(w), F.lit(w))
    return out.otherwise(F.lit(default))


def extract_or_null(c, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(col_(c), pattern, group), F.lit(""))


def price_simple(c) -> Column:
    """Keep digits and commas, comma to dot, cast; null on failure (CLN1)."""
    s = F.replace(F.regexp_replace(col_(c).cast("string"), r"[^0-9,]", ""), F.lit(","), F.lit("."))
    return s.try_cast("double")


def price_locale(c) -> Column:
    """Price text in either separator style (CLN4).

    The last separator followed by one or two digits is the decimal mark; every
    other separator is a thousands mark. Null when nothing numeric remains.
    """
    s = F.regexp_replace(col_(c).cast("string"), r"[^0-9,.]", "")
    int_part = F.regexp_replace(F.regexp_extract(s, r"^(.*)[.,][0-9]{1,2}$", 1), r"[.,]", "")
    frac = F.regexp_extract(s, r"[.,]([0-9]{1,2})$", 1)
    decimal = F.concat(int_part, F.lit("."), frac)
    digits = F.regexp_replace(s, r"[.,]", "")
    return F.when(s.rlike(r"[.,][0-9]{1,2}$"), decimal).otherwise(digits).try_cast("double")


def rating_parse(c, lo: float = 0.0, hi: float = 5.0) -> Column:
    """First signed number, comma or dot decimal, clamped to [lo, hi] (CLN5)."""
    m = F.regexp_extract(col_(c).cast("string"), r"(-?[0-9]+(?:[.,][0-9]+)?)", 1)
    v = F.replace(F.nullif(m, F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(lo)), F.lit(hi)))


def reviews_parse(c) -> Column:
    """First digit run, thousands separators between digits removed; else 0 (CLN6)."""
    s = F.regexp_replace(col_(c).cast("string"), r"(?<=[0-9])[.,](?=[0-9]{3})", "")
    return F.coalesce(F.regexp_extract(s, r"([0-9]+)", 1).try_cast("int"), F.lit(0))


def word_tokens(c, pattern: str = r"[\p{L}\p{N}_]+") -> Column:
    """Unicode word tokens of a lowered column as an array."""
    return F.regexp_extract_all(F.lower(col_(c)), F.lit(pattern), 0)
