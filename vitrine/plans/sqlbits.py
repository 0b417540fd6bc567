"""Small SQL text helpers for the DuckDB oracle strings."""

from __future__ import annotations


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def contains_any(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, {q(w)})" for w in words) + ")"


def count_contained(col: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains({col}, {q(w)}) AS INTEGER)" for w in words) + ")"


def first_keyword(col: str, words, default: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({col}, {q(w)}) THEN {q(w)}" for w in words) + f" ELSE {q(default)} END"


def normalize_ws(col: str) -> str:
    return f"trim(regexp_replace(coalesce({col}, ''), '\\s+', ' ', 'g'))"


def price_simple(col: str) -> str:
    return f"TRY_CAST(replace(regexp_replace(CAST({col} AS VARCHAR), '[^0-9,]', '', 'g'), ',', '.') AS DOUBLE)"


def rating_parse(col: str) -> str:
    v = (f"TRY_CAST(replace(nullif(regexp_extract(CAST({col} AS VARCHAR), '(-?[0-9]+(?:[.,][0-9]+)?)', 1), ''),"
         f" ',', '.') AS DOUBLE)")
    return f"CASE WHEN {v} IS NOT NULL THEN least(greatest({v}, 0e0), 5e0) END"


def reviews_parse(col: str) -> str:
    s = f"regexp_replace(CAST({col} AS VARCHAR), '([0-9])[.,]([0-9]{{3}})', '\\1\\2', 'g')"
    return f"coalesce(TRY_CAST(regexp_extract({s}, '([0-9]+)', 1) AS INTEGER), 0)"


def capitalize(e: str) -> str:
    return f"(upper(substr({e}, 1, 1)) || lower(substr({e}, 2)))"
