"""The whole feature pipeline on rows of its own, against plain Python."""

import math

import numpy as np
import pytest


@pytest.fixture(scope="module")
def train(spark):
    words = ["toner", "cartridge", "ink", "printer", "genuine", "sealed", "magenta", "black"]
    rows = [(i, f"HP {words[i % 5]} {words[(i * 3 + 1) % 7]}", f"{words[i % 8]} {words[(i // 2) % 8]} the {words[(i * 5) % 8]} warranty {'x' * (i % 9)}",
             f"p{i % 3}" if i % 7 else None, f"s{i % 4}", None if i % 11 == 0 else i * i % 50, i % 2) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, title string, description string, platform string, seller_name string, reviews_count int, target int")


def _fit(df, **k):
    from vitrine.operators.features import fit_features
    return fit_features(df, "doc_id", "target", ["title", "description"], ["reviews_count"], ["platform"], ["seller_name"], **k)


def test_all_kinds_of_features_are_made_and_the_correlated_removed(spark, train):
    m = _fit(train)
    for name in ("title_uppercase_count", "description_avg_word_length", "title_has_hp_brand", "description_authenticity_keyword_count",
                 "title_tfidf_hp", "title_tfidf_hp toner", "description_tfidf_warranty", "reviews_count", "log_reviews", "high_reviews",
                 "low_reviews", "platform_p0", "platform_unknown", "seller_name_encoded"):
        assert name in m.names or name in ("title_tfidf_hp", "description_tfidf_warranty"), name  # in over 95 % of the rows
    assert not {"title_tfidf_hp", "description_tfidf_warranty", "description_tfidf_the", "log_price"} & set(m.names)
    x = np.array([r["_all"].toArray() for r in m.assembled(train).collect()])
    assert x.shape == (60, len(m.names))
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = np.corrcoef(x.T)
    gone = {m.names[j] for i in range(len(m.names)) for j in range(i + 1, len(m.names)) if abs(corr[i, j]) >= 0.95}
    assert gone and set(m.removed) == gone
    out = m.transform(train).collect()
    assert len(out) == 60 and {r["features"].size for r in out} == {len(m.names) - len(gone)} and out[0]["target"] in (0, 1)


def test_weights_codes_and_unseen_values(spark, train):
    m = _fit(train)
    rows = train.collect()
    x = {r["doc_id"]: r["_all"].toArray() for r in m.assembled(train).collect()}
    at = {n: i for i, n in enumerate(m.names)}
    toks = {r["doc_id"]: r["title"].lower().split() for r in rows}
    terms = {i: [w for w in t] + [" ".join(p) for p in zip(t, t[1:])] for i, t in toks.items()}
    names = [n for n in m.names if n.startswith("title_tfidf_")]
    df = {n: sum(n.removeprefix("title_tfidf_") in t for t in terms.values()) for n in names}
    raw = {n: terms[8].count(n.removeprefix("title_tfidf_")) * (math.log(61 / (1 + df[n])) + 1) for n in names}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert [x[8][at[n]] for n in names] == pytest.approx([raw[n] / norm for n in names])
    assert [x[i][at["seller_name_encoded"]] for i in range(4)] == [0, 1, 2, 3]
    log = np.array([x[i][at["log_reviews"]] for i in range(60)])
    assert abs(log.mean()) < 1e-9 and abs(log.std() - 1) < 1e-9
    new = spark.createDataFrame([(1, None, None, "other", "other", None, 0)], train.schema)
    y = m.assembled(new).first()["_all"].toArray()
    assert y[at["seller_name_encoded"]] == -1 and not any(y[at[n]] for n in m.names if n.startswith("platform_") or "_tfidf_" in n)


def test_missing_columns_and_no_rows_are_errors(spark, train):
    for df in (train.drop("seller_name"), train.limit(0)):
        with pytest.raises(ValueError):
            _fit(df)


def test_the_query_uses_the_whole_pipeline(spark, train, monkeypatch):
    from pyspark.sql import functions as F

    from vitrine.plans import ml_queries as Q
    monkeypatch.setattr(Q, "_split", lambda spark, d: train.withColumn("side", F.when(F.col("doc_id") < 50, "train").otherwise("test")))
    monkeypatch.setattr(Q, "prepared", None)
    got = Q.q_feature_pipeline(spark, "none").collect()
    m = _fit(train.where("doc_id < 50"))
    assert len(got) == 50 and {r["n_features"] for r in got} == {len(m.kept)} and len(m.kept) < len(m.names)
