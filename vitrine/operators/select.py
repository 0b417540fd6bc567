"""Correlation-based feature selection (SEL1-SEL5). The F x F matrix comes
from MLlib's distributed ``Correlation.corr`` (a tree aggregate of the Gram
matrix); only the F x F result is small, never the rows."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corr_pairs(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """Long correlation matrix (feature_a, feature_b, i, j, correlation) (SEL1)."""
    vec = VectorAssembler(inputCols=list(columns), outputCol="_features", handleInvalid="skip").transform(
        df.select(*[F.col(c).cast("double") for c in columns]))
    mat = Correlation.corr(vec, "_features", method).first()[0].toArray()
    rows = [(columns[i], columns[j], i, j, float(mat[i][j])) for i in range(len(columns)) for j in range(len(columns))]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, i int, j int, correlation double")


def corr_high_pairs(pairs: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Upper triangle with abs(r) >= threshold (SEL2)."""
    return pairs.where((F.col("i") < F.col("j")) & (F.abs("correlation") >= threshold))


def corr_high_slots(df: DataFrame, vector: str, names: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """``corr_high_pairs`` of the slots of a vector column: only the pairs found become rows. A constant slot correlates with none."""
    import numpy as np
    mat = Correlation.corr(df.select(vector), vector).first()[0].toArray()
    i, j = np.nonzero(np.triu(np.abs(np.nan_to_num(mat)) >= threshold, 1))
    rows = [(names[a], names[b], int(a), int(b), float(mat[a, b])) for a, b in zip(i, j)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, i int, j int, correlation double")


def corr_pick(high: DataFrame, importance: DataFrame | None = None) -> DataFrame:
    """Feature to drop from each pair: the second, or the less important (SEL3)."""
    if importance is None:
        return high.select(F.col("feature_b").alias("feature")).distinct()
    ia = importance.select(F.col("feature").alias("feature_a"), F.col("importance").alias("imp_a"))
    ib = importance.select(F.col("feature").alias("feature_b"), F.col("importance").alias("imp_b"))
    j = high.join(ia, "feature_a", "left").join(ib, "feature_b", "left")
    return j.select(F.when(F.coalesce("imp_a", F.lit(0.0)) >= F.coalesce("imp_b", F.lit(0.0)), F.col("feature_b"))
                    .otherwise(F.col("feature_a")).alias("feature")).distinct()


def corr_stats(pairs: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Max and mean abs(r) over the full matrix (diagonal included), high-pair count (SEL5)."""
    return pairs.agg(F.max(F.abs("correlation")).alias("max_abs_corr"), F.avg(F.abs("correlation")).alias("mean_abs_corr"),
                     F.count_if((F.col("i") < F.col("j")) & (F.abs("correlation") >= threshold)).alias("n_high_pairs"),
                     F.max("i").alias("n_features_minus_1"))


def kept_indices(columns: Sequence[str], dropped: Sequence[str]) -> list:
    """Indices kept after dropping correlated features (SEL4), for ``VectorSlicer``."""
    d = set(dropped)
    return [i for i, c in enumerate(columns) if c not in d]
