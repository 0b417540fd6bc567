"""Base tables. Reads are lazy; Catalyst prunes columns and pushes filters
into the parquet scan, so callers select only what they use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.session import table_path

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
