"""Categorical encodings (CAT1-CAT3, JOIN11). The fitted state is a code map
whose size is the number of categories, not the number of rows."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_unknown(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit("unknown")))


def fit_label_codes(train: DataFrame, col: str) -> DataFrame:
    """(value, label_code) with code = position of the value in sorted order
    (CAT2), fitted by ``StringIndexer(alphabetAsc)``."""
    model = StringIndexer(inputCol=col, outputCol="_idx", stringOrderType="alphabetAsc",
                          handleInvalid="keep").fit(with_unknown(train, col))
    spark = train.sparkSession
    return spark.createDataFrame([(v, i) for i, v in enumerate(model.labels)], f"{col} string, label_code int")


def label_code(train: DataFrame, df: DataFrame, col: str) -> DataFrame:
    """Code of each value, -1 when unseen at fit time (CAT2 + JOIN11)."""
    from vitrine.operators.relational import apply_code_map
    return apply_code_map(with_unknown(df, col), col, fit_label_codes(train, col), "label_code", -1)


def onehot(train: DataFrame, df: DataFrame, col: str):
    """Sorted-category one-hot with the last category dropped; unseen values
    give the all-zero vector (CAT1)."""
    idx = StringIndexer(inputCol=col, outputCol=f"{col}_idx", stringOrderType="alphabetAsc",
                        handleInvalid="keep").fit(with_unknown(train, col))
    enc = OneHotEncoder(inputCols=[f"{col}_idx"], outputCols=[f"{col}_onehot"], dropLast=True,
                        handleInvalid="error")
    # the indexer's "keep" slot is the dropped last category: unseen values give the zero vector
    model = enc.fit(idx.transform(with_unknown(train, col)))
    x = idx.transform(with_unknown(df, col))
    return model.transform(x), idx.labels


def frequency_code(train: DataFrame, df: DataFrame, col: str) -> DataFrame:
    """Value replaced by its training count, 0 when unseen (CAT3). The count
    table is a map-side combined aggregate joined back by key."""
    counts = with_unknown(train, col).groupBy(col).agg(F.count(F.lit(1)).alias(f"{col}_frequency"))
    from vitrine.operators.relational import apply_code_map
    return apply_code_map(with_unknown(df, col), col, counts, f"{col}_frequency", 0)
