"""The reference's feature pipeline (PIPE1): text, numeric and categorical features of training rows, stacked, without the
features that correlate with an earlier one. Fitted state is the vocabularies, numeric parameters, categories and kept
slots; rows are only aggregated."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer, OneHotEncoder, StringIndexer, StringIndexerModel,
                                VectorAssembler, VectorSlicer)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import config as C
from vitrine.functions.stopwords import stop_words
from vitrine.operators import numeric as N
from vitrine.operators import select as SL
from vitrine.operators import textfeat as TF

LENGTHS = ("char_count", "word_count", "avg_word_length", "uppercase_count")


def validate(df: DataFrame, required: Sequence[str]) -> int:
    """Rows of ``df``; missing columns or no rows are an error."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    n = df.count()
    if not n:
        raise ValueError("no rows to fit features on")
    return n


@dataclass
class FeatureModel:
    """Fitted features: ``names`` of the assembled slots, and those ``kept`` after the correlated were ``removed``."""
    text: dict  # column -> (terms in order, their idf)
    numeric: N.NumericModel
    onehot: dict  # column -> sorted values
    codes: dict  # column -> sorted values
    names: list
    kept: list
    removed: list

    def assembled(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_all``: every feature, before the correlated are removed."""
        used = dict.fromkeys((*self.text, *self.numeric.columns, *self.onehot, *self.codes))
        out = df.select(F.struct(*df.columns).alias("_row"), *used)  # names made on the way clash with none of the given
        dense, sw, slots = dense_text_names(self.text), list(stop_words("english")), []
        out = TF.keyword_flags(TF.text_length(out, list(self.text)), list(self.text))
        out = out.select("_row", *used, *[F.col(c).cast("double").alias(f"_f_{c}") for c in dense])
        slots += [f"_f_{c}" for c in dense]
        for c, (terms, idf) in self.text.items():
            if not terms:
                continue
            out = TF.with_terms(out, c, f"_terms_{c}", sw)
            count = CountVectorizerModel.from_vocabulary(terms, inputCol=f"_terms_{c}", outputCol=f"_tf_{c}")
            weigh = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=f"_tf_{c}", outputCol=f"_raw_{c}")
            norm = Normalizer(inputCol=f"_raw_{c}", outputCol=f"_tfidf_{c}", p=2.0)
            out = norm.transform(weigh.transform(count.transform(out))).drop(f"_terms_{c}", f"_tf_{c}", f"_raw_{c}")
            slots.append(f"_tfidf_{c}")
        for c in (*self.onehot, *self.codes):
            values = {**self.onehot, **self.codes}[c]
            known = StringIndexerModel.from_labels(values, inputCol=f"_v_{c}", outputCol=f"_i_{c}", handleInvalid="keep")
            out = known.transform(out.withColumn(f"_v_{c}", _value(c))).drop(f"_v_{c}")
        out = self.numeric.transform(out).withColumns({f"_n_{c}": F.col(c) for c in self.numeric.output_columns})
        slots += [f"_n_{c}" for c in self.numeric.output_columns]
        for c, values in self.onehot.items():
            # the slot of unseen values is the one dropped: they give the zero vector
            enc = OneHotEncoder(inputCols=[f"_i_{c}"], outputCols=[f"_o_{c}"], dropLast=True, handleInvalid="error")
            out = enc.fit(out.sparkSession.range(len(values) + 1).select(F.col("id").cast("double").alias(f"_i_{c}"))).transform(out)
            slots.append(f"_o_{c}")
        for c, values in self.codes.items():
            out = out.withColumn(f"_c_{c}", F.when(F.col(f"_i_{c}") < len(values), F.col(f"_i_{c}")).otherwise(F.lit(-1.0)))
            slots.append(f"_c_{c}")
        return VectorAssembler(inputCols=slots, outputCol="_all").transform(out).select("_row.*", "_all")

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``features``, by the fitted parameters alone."""
        return VectorSlicer(inputCol="_all", outputCol="features", indices=self.kept).transform(self.assembled(df)).drop("_all")


def dense_text_names(columns: Sequence[str]) -> list:
    """Names of lengths and keyword features, as the reference orders them."""
    return [f"{c}_{n}" for c in columns for n in LENGTHS] + \
        [f"{c}_{n}" for c in columns for n in (*(f"has_{k}" for k, _ in C.KEYWORD_GROUPS), "authenticity_keyword_count")]


def _value(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit("unknown"))


def _values(df: DataFrame, col: str) -> list:
    v = df.select(_value(col).alias("v"))
    return list(StringIndexer(inputCol="v", outputCol="i", stringOrderType="alphabetAsc").fit(v).labelsArray[0])


def fit_features(df: DataFrame, id_col: str, label: str, text: Sequence[str], numeric: Sequence[str], onehot: Sequence[str],
                 codes: Sequence[str], max_features: int = 1000, threshold: float = 0.95) -> FeatureModel:
    """Fit on training rows ``df``, which are read several times (PIPE1): up to ``max_features`` uni- and bigrams of each text
    column with smooth idf, text lengths and keywords; numeric columns filled, capped, extended and scaled; ``onehot`` and
    ``codes`` columns by their sorted values. Of two slots that correlate by ``threshold`` or more the later is removed."""
    n = validate(df, [id_col, label, *text, *numeric, *onehot, *codes])
    sw, terms = list(stop_words("english")), {}
    for c in text:
        toks = TF.doc_tokens(df, id_col, c, sw)
        voc = TF.tfidf_vocabulary(TF.frequent_stats(toks, F.lit(n), max_features, 2, 0.95), F.lit(n), max_features, 2, 0.95)
        got = sorted((r["term"], r["idf"]) for r in voc.collect())
        terms[c] = ([t for t, _ in got], [i for _, i in got])
    model = FeatureModel(terms, N.fit_numeric(df, numeric), {c: _values(df, c) for c in onehot}, {c: _values(df, c) for c in codes}, [], [], [])
    model.names = dense_text_names(text) + [f"{c}_tfidf_{t}" for c in text for t in terms[c][0]] + model.numeric.output_columns + \
        [f"{c}_{v}" for c in onehot for v in model.onehot[c]] + [f"{c}_encoded" for c in codes]
    slots = model.assembled(df.select(*dict.fromkeys((*text, *numeric, *onehot, *codes)))).select("_all").persist()
    try:
        high = SL.corr_high_slots(slots, "_all", model.names, threshold)
    finally:
        slots.unpersist()
    model.removed = sorted(r["feature"] for r in SL.corr_pick(high).collect())
    model.kept = SL.kept_indices(model.names, model.removed)
    return model
