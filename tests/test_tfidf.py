"""The TF-IDF vocabulary from frequent words against counting every term."""

import random

import pytest
from pyspark.sql import functions as F


@pytest.mark.parametrize("size", [5, 12, 1000])
def test_vocabulary_equals_that_of_all_terms(spark, size):
    from vitrine.operators import textfeat as TF
    r = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(["all", *(words[int(40 * r.random() ** 3)] for _ in range(25)), *["same pair"] * (i % 3)])) for i in range(30)] + [(99, None), (100, "once")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    n = F.lit(len(docs))
    plain = TF.tfidf_vocabulary(TF.term_stats(TF.doc_terms(df, "doc_id", "text", ["the"])), n, size, 2, 0.9)
    stats = TF.frequent_stats(TF.doc_tokens(df, "doc_id", "text", ["the"]), n, size, 2, 0.9)
    got = TF.tfidf_vocabulary(stats, n, size, 2, 0.9)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    if size == 5:  # and not every bigram was counted
        assert stats.count() < TF.term_stats(TF.doc_terms(df, "doc_id", "text", ["the"])).count()
