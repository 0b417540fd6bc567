"""Registry of query keys: Spark plan + DuckDB oracle SQL (or None = rows-only)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vitrine.plans.fixture_sql import with_views


@dataclass
class Entry:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def bigint_counts(sql: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT; Spark's is BIGINT. Wrap each call."""
    out, i = [], 0
    while True:
        j = sql.find("count_if(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("count_if")
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            k += 1
            if depth == 0:
                break
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


def register(key: str, sql: str | None = None):
    def deco(fn):
        known = REGISTRY.get(key)
        # the same function may register again when a failed import is tried once more
        if known and (known.build.__module__, known.build.__qualname__) != (fn.__module__, fn.__qualname__):
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, bigint_counts(with_views(sql)) if sql else None)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules fills the registry
    from vitrine.plans import (listing_queries, relational_queries, stats_queries,  # noqa: F401
                               feature_queries, eval_queries, ml_queries, page_queries,
                               stream_queries, io_queries)
    return REGISTRY
