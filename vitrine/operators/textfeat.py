"""Text features (TXT1, TXT2, TXT11) as higher-order array expressions."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import config as C
from vitrine.functions.text import contains_any, count_contained


def whitespace_words(c: Column) -> Column:
    """Python ``str.split()``: non-empty runs between whitespace."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != "")


def text_length(df: DataFrame, columns: Sequence[str] = ("title", "description")) -> DataFrame:
    """Characters, words, mean word length (0 if none), all-uppercase words (TXT1)."""
    cols = {}
    for c in columns:
        words = whitespace_words(F.col(c))
        n = F.size(words)
        total = F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc + F.length(w))
        cols[f"{c}_char_count"] = F.length(F.coalesce(F.col(c), F.lit("")))
        cols[f"{c}_word_count"] = n
        cols[f"{c}_avg_word_length"] = F.when(n > 0, total.cast("double") / n).otherwise(F.lit(0.0))
        cols[f"{c}_uppercase_count"] = F.size(F.filter(words, lambda w: (F.upper(w) == w) & (F.lower(w) != w)))
    return df.withColumns(cols)


def keyword_flags(df: DataFrame, columns: Sequence[str] = ("title", "description"),
                  groups=tuple(C.KEYWORD_GROUPS)) -> DataFrame:
    """0/1 flag per keyword group and count of keywords present, per column (TXT2)."""
    cols = {}
    all_words = [w for _, ws in groups for w in ws]
    for c in columns:
        low = F.lower(F.coalesce(F.col(c), F.lit("")))
        for name, words in groups:
            cols[f"{c}_has_{name}"] = contains_any(low, words).cast("int")
        cols[f"{c}_authenticity_keyword_count"] = count_contained(low, all_words)
    return df.withColumns(cols)


# ------------------------------------------------------------------ TF-IDF --
TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens_no_stop(text: Column, stop_words: Sequence[str]) -> Column:
    """Lowered 2+ character word tokens without stop words (TXT3 analyzer)."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), 0)
    sw = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(toks, lambda t: ~F.array_contains(sw, t))


def adjacent_pairs(toks: Column) -> Column:
    """Bigrams of a token array in one linear pass (two shifted slices zipped).
    ``toks`` should be a column reference so it is computed once per row."""
    n = F.size(toks)
    return F.when(n >= 2, F.zip_with(F.slice(toks, 1, n - 1), F.slice(toks, 2, n - 1),
                                     lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))


from vitrine.functions.partitioning import spread  # noqa: E402


def with_terms(df: DataFrame, text_col: str, out: str, stop_words: Sequence[str]) -> DataFrame:
    """``df`` with the unigrams and bigrams of ``text_col`` after hashed stop-word removal (TXT3 analyzer)."""
    from pyspark.ml.feature import StopWordsRemover
    raw = df.withColumn("_raw", F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(TOKEN), 0))
    clean = StopWordsRemover(inputCol="_raw", outputCol="_t", stopWords=list(stop_words), caseSensitive=True).transform(raw)
    return clean.withColumn(out, F.concat(F.col("_t"), adjacent_pairs(F.col("_t")))).drop("_raw", "_t")


def doc_tokens(df: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str]) -> DataFrame:
    """(doc_id, _t): tokens after hashed stop-word removal."""
    from pyspark.ml.feature import StopWordsRemover
    toks = spread(df).select(F.col(id_col).alias("doc_id"), F.regexp_extract_all(
        F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(TOKEN), 0).alias("_raw"))
    sw = StopWordsRemover(inputCol="_raw", outputCol="_t", stopWords=list(stop_words), caseSensitive=True)
    return sw.transform(toks).select("doc_id", "_t")


def doc_terms(df: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str]) -> DataFrame:
    """(doc_id, terms): unigrams and bigrams after hashed stop-word removal (TXT3 analyzer)."""
    clean = doc_tokens(df, id_col, text_col, stop_words)
    return clean.select("doc_id", F.concat(F.col("_t"), adjacent_pairs(F.col("_t"))).alias("terms"))


def _tagged(terms: str) -> Column:
    return F.concat(F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(0).alias("d"))),
                    F.transform(F.array_distinct(terms), lambda t: F.struct(t.alias("term"), F.lit(1).alias("d"))))


def _stats(ex: DataFrame) -> DataFrame:
    return ex.groupBy(F.col("x.term").alias("term")).agg(F.sum(1 - F.col("x.d")).alias("tf"), F.sum("x.d").alias("df"))


def term_stats(terms: DataFrame) -> DataFrame:
    """(term, tf, df) from ONE explode: every occurrence tagged 0 and every
    distinct term of a document tagged 1, summed with map-side combine."""
    return _stats(terms.select(F.explode(_tagged("terms")).alias("x")))


def frequent_stats(toks: DataFrame, n_docs: Column, vocab_size: int = 1000, min_df: int = 2, max_df: float = 0.95) -> DataFrame:
    """(term, tf, df) of every unigram or bigram of ``toks`` (doc_id, _t) that ``tfidf_vocabulary`` with the same limits can keep.

    A bigram occurs no more often than either of its words. With ``vocab_size`` unigrams kept by document frequency, only
    terms as frequent as the last of them can be in the vocabulary, so only bigrams of such words are counted; with fewer,
    all are. The words that frequent are broadcast: besides ``vocab_size`` and ties they are those in fewer than ``min_df`` or
    more than ``max_df`` of the documents."""
    from vitrine.session import written
    uni = written(term_stats(toks.select(F.col("_t").alias("terms"))))
    kept = uni.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    last = kept.orderBy(F.col("tf").desc(), F.col("term")).limit(vocab_size).agg(F.count("*"), F.min("tf")).first()
    least = last[1] if last[0] == vocab_size else 0
    ex = toks.select(adjacent_pairs(F.col("_t")).alias("p")).select(F.explode(_tagged("p")).alias("x"))
    words = uni.where(F.col("tf") >= least)
    if least:
        ends = F.split(F.col("x.term"), " ")
        for i in (0, 1):
            side = words.select(F.col("term").alias(f"_w{i}"))
            side = F.broadcast(side) if words.count() <= 100 * vocab_size else side
            ex = ex.withColumn(f"_w{i}", F.get(ends, F.lit(i))).join(side, f"_w{i}", "left_semi")
    return words.unionByName(_stats(ex))


def tfidf_vocabulary(stats: DataFrame, n_docs: Column, vocab_size: int = 1000, min_df: int = 2,
                     max_df: float = 0.95) -> DataFrame:
    """Terms kept by document frequency, top ``vocab_size`` by corpus count
    (ties by term), with smooth idf = ln((1 + n) / (1 + df)) + 1 (TXT3)."""
    g = stats.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    top = g.orderBy(F.col("tf").desc(), F.col("term")).limit(vocab_size)
    return top.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))


def tfidf_weights(terms: DataFrame, vocab: DataFrame) -> DataFrame:
    """L2-normalised tf-idf weight per (doc, term). The vocabulary has at most
    ``vocab_size`` rows (broadcast is size-bounded by construction) and filters
    the exploded terms before the per-document count."""
    v = F.broadcast(vocab.select("term", "idf"))
    ex = terms.select("doc_id", F.explode("terms").alias("term")).join(v, "term")
    c = ex.groupBy("doc_id", "term", "idf").agg(F.count(F.lit(1)).alias("count"))
    w = c.withColumn("w", F.col("count") * F.col("idf"))
    norms = w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norms, "doc_id").select("doc_id", "term", (F.col("w") / F.col("norm")).alias("weight"))


def feature_readable_name(c: Column) -> Column:
    """Technical feature name -> readable name (TXT11)."""
    base = F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))
    low = F.lower(c)
    return (F.when(low.contains("tfidf"), F.concat(F.lit("Text Content: "), F.trim(F.replace(base, F.lit("Tfidf"), F.lit("")))))
            .when(low.contains("scaled"), F.replace(base, F.lit("Scaled"), F.lit("(Normalized)")))
            .when(low.contains("encoded"), F.replace(base, F.lit("Encoded"), F.lit("(Category)")))
            .otherwise(base))
