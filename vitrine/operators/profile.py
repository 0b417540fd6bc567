"""Aggregations and profiles (AGG*). All are single-pass aggregates: partial
aggregation runs in every task, so only one small row per task per group
crosses the shuffle, whatever the skew of the grouping key."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.text import word_tokens


def unpivot_stats(one_row: DataFrame, columns: Sequence[str], stats: Sequence[str],
                  name_col: str = "column") -> DataFrame:
    """Columns named ``{col}__{stat}`` of a 1-row frame -> one row per column."""
    stack = F.stack(F.lit(len(columns)), *[x for c in columns for x in
                                          [F.lit(c)] + [F.col(f"`{c}__{s}`").cast("double") for s in stats]])
    return one_row.select(stack.alias(name_col, *stats))


def quantile(c: Column, q, exact: bool = True) -> Column:
    """Linear-interpolated quantile. ``exact=False`` uses the bounded-memory
    sketch (``percentile_approx``) for very large groups."""
    return F.percentile(c, q) if exact else F.percentile_approx(c, q, 10000)


def describe(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """count, mean, std (n-1), min, quartiles, max per column (AGG3). Exact
    quartiles come from ``quantiles_multi`` (one percentile aggregate for
    moderate columns, the distributed exact method for huge ones)."""
    qv = None
    if exact:
        from vitrine.functions.quantile import quantiles_multi
        qv = quantiles_multi(df.select(*columns), columns, [0.25, 0.5, 0.75])
    aggs = []
    for c in columns:
        x = F.col(c)
        qs = [F.lit(qv[c][q]).cast("double") if qv else quantile(x, q, False) for q in (0.25, 0.5, 0.75)]
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 qs[0].alias(f"{c}__q25"), qs[1].alias(f"{c}__q50"), qs[2].alias(f"{c}__q75"), F.max(x).alias(f"{c}__max")]
    return unpivot_stats(df.agg(*aggs), columns, ["count", "mean", "std", "min", "q25", "q50", "q75", "max"])


def class_balance(df: DataFrame, label: str, threshold: float = 0.1) -> DataFrame:
    """Counts, shares, minority/majority, max/min ratio, imbalanced flag (AGG4)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_classes"),
        F.min_by(label, F.struct("n", label)).alias("minority_class"),
        F.max_by(label, F.struct("n", label)).alias("majority_class"),
        F.min("n").alias("minority_count"), F.max("n").alias("majority_count"),
    ).select("*", (F.col("minority_count") / F.col("total")).alias("minority_ratio"),
             (F.col("majority_count") / F.col("total")).alias("majority_ratio"),
             (F.col("majority_count") / F.col("minority_count")).alias("imbalance_ratio"),
             ((F.col("minority_count") / F.col("total")) < threshold).alias("is_imbalanced"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max, last bin closed (AGG6, AGG19).
    min/max come from a scalar subquery; binning is a map-side aggregate."""
    x = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    bounds = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - lo) / (hi - lo) * F.lit(float(bins))), F.lit(bins - 1))).cast("int")
    g = x.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return g.select("bin", "count", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"))


def word_counts(df: DataFrame, col: str, top_n: int = 20, stop_words: Sequence[str] = ()) -> DataFrame:
    """Lowercased word tokens, counted, top N by count then word (AGG8/AGG9).
    Counting is a map-side combined aggregate; the top-N is a bounded
    TakeOrderedAndProject."""
    tok = df.select(F.explode(word_tokens(col)).alias("word"))
    if stop_words:
        # a hashed set; words of digits alone say nothing about a text
        tok = tok.where(~F.col("word").isin(list(stop_words)) & ~F.col("word").rlike(r"^[0-9]+$"))
    return (tok.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("word")).limit(top_n))


TOKEN_SPLIT = r"[\s.,;:!?()\[\]\"]+"


def alpha_tokens(col: str, stop_words: Sequence[str]) -> Column:
    toks = F.filter(F.split(F.lower(F.coalesce(F.col(col), F.lit(""))), TOKEN_SPLIT),
                    lambda t: t.rlike(r"^\p{L}+$"))
    sw = F.array(*[F.lit(w) for w in stop_words]) if stop_words else None
    return F.filter(toks, lambda t: ~F.array_contains(sw, t)) if sw is not None else toks


def bigram_counts(df: DataFrame, col: str, stop_words: Sequence[str], top_n: int = 10) -> DataFrame:
    """Bigrams of alphabetic non-stop tokens of each text, top N (AGG9)."""
    from vitrine.operators.textfeat import adjacent_pairs
    t = df.select(alpha_tokens(col, stop_words).alias("t"))
    g = t.select(F.explode(adjacent_pairs(F.col("t"))).alias("bigram"))
    return (g.groupBy("bigram").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("bigram")).limit(top_n))


def profile_table(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Rows, nulls per column, duplicate rows, errors and warnings (AGG10).
    One aggregate over all columns plus one distinct count."""
    cols = df.columns
    n = F.count(F.lit(1))
    one = df.agg(n.alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null__{c}") for c in cols])
    distinct_rows = df.distinct().agg(F.count(F.lit(1)).alias("distinct_rows"))
    from vitrine.functions.partitioning import with_scalars
    j = with_scalars(one, distinct_rows)
    missing = [c for c in required if c not in cols]
    empty_req = [F.when(F.col(f"null__{c}") == F.col("rows"), F.lit(c)) for c in required if c in cols]
    half = [F.when(F.col(f"null__{c}") > F.col("rows") * 0.5, F.lit(c)) for c in cols]
    return j.select(
        "rows", F.lit(len(cols)).alias("n_columns"),
        (F.col("rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        sum([F.col(f"null__{c}") for c in cols]).alias("total_nulls"),
        F.array_join(F.array_compact(F.array(*[F.lit(m) for m in missing], *empty_req, F.lit(None).cast("string"))), ",")
        .alias("errors"),
        F.array_join(F.array_compact(F.array(*half, F.lit(None).cast("string"))), ",").alias("high_null_columns"),
        (F.col("rows") > F.col("distinct_rows")).alias("has_duplicates"))


def profile_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """mean, std (n-1), min, max, nulls, infinities, zero variance by column (AGG11)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        fin = F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)
        aggs += [F.avg(fin).alias(f"{c}__mean"), F.stddev_samp(fin).alias(f"{c}__std"),
                 F.min(fin).alias(f"{c}__min"), F.max(fin).alias(f"{c}__max"),
                 F.count_if(x.isNull() | F.isnan(x)).alias(f"{c}__nulls"),
                 F.count_if(F.abs(x) == F.lit(float("inf"))).alias(f"{c}__infinities")]
    out = unpivot_stats(df.agg(*aggs), columns, ["mean", "std", "min", "max", "nulls", "infinities"], "feature")
    return out.withColumn("zero_variance", F.coalesce(F.col("std") == 0, F.lit(False)))


def corr_matrix_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r of every column pair in ONE aggregate (AGG20), long form."""
    c = [F.col(x).cast("double") for x in columns]
    d = df.where(reduce(lambda a, b: a & b, [x.isNotNull() for x in c])) if columns else df
    pairs = [(a, b) for a in columns for b in columns]
    one = d.agg(*[(F.lit(1.0) if a == b else F.corr(a, b)).alias(f"{a}|{b}") for a, b in pairs])
    stack = F.stack(F.lit(len(pairs)), *[x for a, b in pairs for x in (F.lit(a), F.lit(b), F.col(f"`{a}|{b}`"))])
    return one.select(stack.alias("feature_a", "feature_b", "correlation"))


def group_moments(df: DataFrame, keys: Sequence[str], value: str, pop: bool = True) -> DataFrame:
    sd = F.stddev_pop if pop else F.stddev_samp
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), sd(value).alias("std"),
                                 F.min(value).alias("min"), F.max(value).alias("max"),
                                 F.count(F.lit(1)).alias("n"))


def window_total(col: str, part: Sequence[str] = ()) -> Column:
    return F.sum(col).over(Window.partitionBy(*part))
