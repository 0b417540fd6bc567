"""The corpus pipeline: documents that are toxic go, near copies go, repeated passages go, sources are mixed to their
target weights, and what is left is encoded. Each stage takes (spark, docs, sf_dir) and reads the rows its predecessor
kept; ``run`` writes each stage's result to the shared folder and reads it again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import bpe, mixing, ngram_join, substring, toxicity
from vitrine.llm.common import settled, table
from vitrine.llm.queries import label_quality
from vitrine.session import checkpoint_dir, ship_package


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the model does not reject. It learns from labelled documents among its input."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity of 0.8 or more. A document is a doc_id with a text; the
    smallest doc_id stays (null last; of equal ids the smallest text hash), once. Documents without words are copies of
    nothing and stay."""
    ship_package(spark)
    keep = settled(spark, lambda: ngram_join.representatives(docs, n=5, percent=80))

    own, kept_row = (f"{x}_{uuid.uuid4().hex}" for x in ("hash", "kept"))  # names no column of the caller has

    def of(some: DataFrame) -> DataFrame:
        some = some.select(F.struct("doc_id", "th").alias(kept_row))
        return docs.withColumn(own, F.xxhash64("text")).join(
            some, F.col("doc_id").eqNullSafe(F.col(f"{kept_row}.doc_id")) & (F.col(own) == F.col(f"{kept_row}.th")), "left_semi")

    again = (F.col("copies") > 1) & (F.col("n_shingles") > 0)
    kept = of(keep.where(~again)).drop(own)
    if keep.where(again).isEmpty():
        return kept
    return kept.unionByName(of(keep.where(again)).dropDuplicates(["doc_id", own]).drop(own))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier document keeps."""
    ship_package(spark)
    return substring.remove_spans(docs, settled(spark, lambda: substring.duplicate_spans(docs)))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mix: a document as often as it is taken, the one that crosses a budget with its leading words."""
    ship_package(spark)
    return mixing.mixed_documents(docs, settled(spark, lambda: mixing.mix(docs, label_quality(spark, sf_dir))))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of the mix."""
    ship_package(spark)
    return bpe.bpe_digests(docs)


STAGES = [("toxicity", toxicity_stage), ("near duplicates", near_duplicate_stage), ("substring dedup", substring_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: No SQL: the toxicity stage's trained model and the near-duplicate stage's links are beyond it; tests/llm holds each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
