"""Exact linear-interpolated quantiles without gathering a column into one task.

``percentile`` keeps every distinct value of a group in one buffer; fine for
small groups, not for a 100 TB column. ``exact_quantiles`` instead
1. finds N and a bracket [lo, hi] around each target rank with
   ``percentile_approx`` (rank error bounded by N / accuracy),
2. counts values below lo (one pass) and ranks only the values inside the
   bracket with the range-partitioned prefix sums,
3. reads the two order statistics around h = q (N - 1) and interpolates the
   way Spark's ``percentile`` does. A bracket that misses its ranks is widened
   and retried, so the result is exact, never approximate.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.prefix import prefix_sums


def _order_stats(x: DataFrame, ranks: Sequence[int], n: int, accuracy: int) -> dict:
    """Values at the given 0-based ranks of column ``x`` (non-null doubles)."""
    out = {}
    width = 4.0 / accuracy
    for r in sorted(set(ranks)):
        p = r / max(n - 1, 1)
        w = width
        while True:
            plo, phi = max(0.0, p - w), min(1.0, p + w)
            b = x.agg(F.percentile_approx("x", [plo, phi], accuracy).alias("b")).first()["b"]
            lo, hi = (b[0] if plo > 0 else float("-inf")), (b[1] if phi < 1 else float("inf"))
            c = x.agg(F.count_if(F.col("x") < lo).alias("below"),
                      F.count_if((F.col("x") >= lo) & (F.col("x") <= hi)).alias("inside")).first()
            if c["below"] <= r < c["below"] + c["inside"]:
                break
            w *= 4
        inside = x.where((F.col("x") >= lo) & (F.col("x") <= hi)).select("x", F.monotonically_increasing_id().alias("_i"))
        ranked = prefix_sums(inside.select(F.struct("x", "_i").alias("_o"), F.lit(1).alias("_one")), [], "_o", ["_one"])
        out[r] = ranked.where(F.col("cum__one") == r - c["below"] + 1).select("_o.x").first()[0]
    return out


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], accuracy: int = 100000) -> dict:
    """{q: value} exact (linear interpolation, as ``percentile``), distributed."""
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())  # NaN is the largest value, as for percentile
    n = x.count()
    if n == 0:
        return {q: None for q in qs}
    pos = {q: q * (n - 1) for q in qs}
    need = [int(math.floor(p)) for p in pos.values()] + [int(math.ceil(p)) for p in pos.values()]
    stats = _order_stats(x, need, n, accuracy)
    out = {}
    for q, p in pos.items():
        lr, hr = int(math.floor(p)), int(math.ceil(p))
        lv, hv = stats[lr], stats[hr]
        out[q] = lv if lr == hr else (hr - p) * lv + (p - lr) * hv
    return out


def quantiles(df: DataFrame, col: str, qs: Sequence[float], large_rows: int = 50_000_000) -> dict:
    """Exact quantiles: one ``percentile`` aggregate for columns up to
    ``large_rows`` values, the distributed method above beyond it."""
    n = df.where(F.col(col).isNotNull()).count()
    if n <= large_rows:
        row = df.agg(*[F.percentile(F.col(col).cast("double"), q).alias(f"q{i}") for i, q in enumerate(qs)]).first()
        return {q: row[f"q{i}"] for i, q in enumerate(qs)}
    return exact_quantiles(df, col, qs)


def quantiles_multi(df: DataFrame, cols: Sequence[str], qs: Sequence[float], large_rows: int = 50_000_000) -> dict:
    """{col: {q: value}} for several columns: one count pass, then one
    ``percentile`` aggregate for all small columns; large ones go distributed."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first()
    small = [c for c in cols if counts[c] <= large_rows]
    out = {}
    if small:
        row = df.agg(*[F.percentile(F.col(c).cast("double"), q).alias(f"{c}|{i}") for c in small
                       for i, q in enumerate(qs)]).first()
        out = {c: {q: row[f"{c}|{i}"] for i, q in enumerate(qs)} for c in small}
    for c in cols:
        if c not in out:
            out[c] = exact_quantiles(df, c, qs)
    return out
