"""Numeric features and outliers (NUM1-NUM5).

Fitting is a handful of 1-row aggregates (exact linear quantiles, moments);
their results are the fitted parameters, kept like an MLlib model's state and
applied by a narrow projection. No step needs more than one partial
aggregate per task, so it scales with the number of splits. For very large
inputs ``exact=False`` switches the quantiles to ``percentile_approx``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(c: Column, p: float, exact: bool) -> Column:
    return F.percentile(c, p) if exact else F.percentile_approx(c, p, 10000)


def iqr_bounds(df: DataFrame, col: str, k: float = 1.5, exact: bool = True) -> DataFrame:
    x = F.col(col)
    return df.agg(_q(x, 0.25, exact).alias("q1"), _q(x, 0.75, exact).alias("q3")).select(
        (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower"),
        (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper"))


def outlier_iqr(df: DataFrame, col: str, k: float = 1.5, exact: bool = True) -> Column:
    """Outside [Q1 - k IQR, Q3 + k IQR] (NUM1); bounds are scalar subqueries."""
    b = iqr_bounds(df, col, k, exact)
    x = F.col(col)
    return F.coalesce((x < b.select("lower").scalar()) | (x > b.select("upper").scalar()), F.lit(False))


def outlier_zscore(df: DataFrame, col: str, z: float = 3.0) -> Column:
    """abs((x - mean) / std) > z with std over n-1 (NUM2)."""
    m = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s"))
    x = F.col(col)
    return F.coalesce(F.abs((x - m.select("m").scalar()) / m.select("s").scalar()) > z, F.lit(False))


def outlier_report(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Outlier rows by column, unpivoted (NUM4)."""
    out = None
    for c in cols:
        part = df.where(outlier_iqr(df, c)).select(F.lit(c).alias("column"), *keep, F.col(c).cast("double").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def outlier_treat(df: DataFrame, col: str, method: str = "cap", exact: bool = True) -> DataFrame:
    """If the column has IQR outliers: cap to the 5-95 percentiles, drop the
    rows, or log1p the column (NUM3)."""
    flag = outlier_iqr(df, col, exact=exact)
    any_out = df.agg(F.max(flag.cast("int")).alias("a")).select("a").scalar() == 1
    x = F.col(col)
    if method == "cap":
        p = df.agg(_q(x, 0.05, exact).alias("lo"), _q(x, 0.95, exact).alias("hi"))
        capped = F.least(F.greatest(x, p.select("lo").scalar()), p.select("hi").scalar())
        return df.withColumn(col, F.when(any_out & x.isNotNull(), capped).otherwise(x))
    if method == "remove":
        return df.where(~(flag & any_out))
    if method == "transform":
        return df.withColumn(col, F.when(any_out, F.log1p(x)).otherwise(x))
    raise ValueError(method)


DERIVED = ["price_category_low", "price_category_medium", "price_category_high", "log_price", "high_rating",
           "low_rating", "rating_squared", "high_reviews", "low_reviews", "log_reviews", "price_per_rating",
           "price_per_review", "rating_reliability"]
_P, _R, _N = {"price_numeric"}, {"rating_numeric"}, {"reviews_count"}
#: Columns that each of them is derived from.
NEEDS = dict(zip(DERIVED, [_P] * 4 + [_R] * 3 + [_N] * 3 + [_P | _R, _P | _N, _R | _N]))


@dataclass
class NumericModel:
    """Fitted parameters of ``numeric_features``: train-time medians, caps,
    category quantiles, and the scaler's means and population stds."""
    columns: list
    medians: dict = field(default_factory=dict)
    caps: dict = field(default_factory=dict)
    quantiles: dict = field(default_factory=dict)
    means: dict = field(default_factory=dict)
    stds: dict = field(default_factory=dict)

    @property
    def output_columns(self) -> list:
        """The columns and what derives from them: all of ``DERIVED`` where price, rating and reviews are there."""
        return list(self.columns) + [c for c in DERIVED if NEEDS[c] <= set(self.columns)]

    def _filled_capped(self, df: DataFrame) -> DataFrame:
        cols = {}
        for c in self.columns:
            x = F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c]))
            if c in self.caps:
                lo, hi = self.caps[c]
                x = F.least(F.greatest(x, F.lit(lo)), F.lit(hi))
            cols[c] = x
        return df.withColumns(cols)

    def _derived(self, df: DataFrame) -> DataFrame:
        p, r, n = F.col("price_numeric"), F.col("rating_numeric"), F.col("reviews_count")
        q = {"p33": None, "p67": None, "r25": None, "r75": None} | self.quantiles
        derived = {
            "price_category_low": (p <= q["p33"]).cast("int"),
            "price_category_medium": ((p > q["p33"]) & (p <= q["p67"])).cast("int"),
            "price_category_high": (p > q["p67"]).cast("int"),
            "log_price": F.log1p(p), "high_rating": (r >= 4.0).cast("int"), "low_rating": (r <= 2.5).cast("int"),
            "rating_squared": F.pow(r, 2), "high_reviews": (n >= q["r75"]).cast("int"),
            "low_reviews": (n <= q["r25"]).cast("int"), "log_reviews": F.log1p(n),
            "price_per_rating": p / (r + 0.1), "price_per_review": p / (n + 1), "rating_reliability": r * F.log1p(n)}
        return df.withColumns({c: derived[c] for c in self.output_columns[len(self.columns):]})

    def unscaled(self, df: DataFrame) -> DataFrame:
        return self._derived(self._filled_capped(df))

    def transform(self, df: DataFrame) -> DataFrame:
        """Scaled features with train-time parameters (no refit on new data)."""
        u = self.unscaled(df)
        return u.withColumns({c: (F.col(c).cast("double") - F.lit(self.means[c])) /
                              F.lit(self.stds[c] if self.stds[c] else 1.0) for c in self.output_columns})


def fit_numeric(df: DataFrame, columns: Sequence[str] = ("price_numeric", "rating_numeric", "reviews_count"),
                exact: bool = True) -> NumericModel:
    """Median fill, IQR-gated 5-95 caps, 13 derived columns, population-std
    scaling (NUM5). Four 1-row aggregates; only their rows reach the driver."""
    from vitrine.functions.quantile import quantiles_multi
    # each pass reads only the fitted columns (pruned parquet scan); measured
    # faster than caching them, and a cache would spill at 100 TB anyway
    df = df.select(*columns)
    m = NumericModel(list(columns))
    if exact:
        med = quantiles_multi(df, columns, [0.5])
        m.medians = {c: float(med[c][0.5]) for c in columns}
    else:
        row = df.agg(*[_q(F.col(c).cast("double"), 0.5, exact).alias(c) for c in columns]).first()
        m.medians = {c: float(row[c]) for c in columns}
    filled = m._filled_capped(df)
    if exact:
        qq = quantiles_multi(filled, columns, [0.25, 0.75, 0.05, 0.95])
    else:
        row = filled.agg(*[_q(F.col(c), q, exact).alias(f"{c}|{q}") for c in columns for q in (0.25, 0.75, 0.05, 0.95)]).first()
        qq = {c: {q: row[f"{c}|{q}"] for q in (0.25, 0.75, 0.05, 0.95)} for c in columns}
    bounds = {c: (qq[c][0.25] - 1.5 * (qq[c][0.75] - qq[c][0.25]), qq[c][0.75] + 1.5 * (qq[c][0.75] - qq[c][0.25]))
              for c in columns}
    outs = filled.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) for c, (lo, hi) in bounds.items()]).first()
    for c in columns:
        if outs[c] > 0:
            m.caps[c] = (float(qq[c][0.05]), float(qq[c][0.95]))
    capped = m._filled_capped(df)
    if exact:
        asked = {c: names for c, names in (("price_numeric", {"p33": 0.33, "p67": 0.67}), ("reviews_count", {"r25": 0.25, "r75": 0.75})) if c in columns}
        qp = quantiles_multi(capped, list(asked), [0.33, 0.67, 0.25, 0.75]) if asked else {}
        m.quantiles = {k: float(qp[c][p]) for c, names in asked.items() for k, p in names.items()}
    else:
        row = capped.agg(_q(F.col("price_numeric"), 0.33, exact).alias("p33"), _q(F.col("price_numeric"), 0.67, exact).alias("p67"),
                         _q(F.col("reviews_count"), 0.25, exact).alias("r25"), _q(F.col("reviews_count"), 0.75, exact).alias("r75")).first()
        m.quantiles = {k: float(row[k]) for k in ("p33", "p67", "r25", "r75")}
    u = m.unscaled(df)
    row = u.agg(*[F.avg(F.col(c).cast("double")).alias(f"{c}|m") for c in m.output_columns],
                *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}|s") for c in m.output_columns]).first()
    m.means = {c: float(row[f"{c}|m"]) for c in m.output_columns}
    m.stds = {c: float(row[f"{c}|s"]) for c in m.output_columns}
    return m
