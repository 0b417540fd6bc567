"""File sources and sinks (SRC1-SRC4, SRC11): CSV at the edges, parquet
between stages. Schemas are explicit; no inference pass over the data."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_LISTING_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("price", T.StringType()),
    T.StructField("seller_name", T.StringType()), T.StructField("seller_reputation", T.StringType()),
    T.StructField("reviews_count", T.StringType()), T.StructField("rating", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("platform", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("specifications", T.StringType()),
    T.StructField("images", T.StringType()), T.StructField("availability", T.StringType()),
    T.StructField("shipping_info", T.StringType()), T.StructField("scraped_at", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

PRODUCTS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("price_numeric", T.DoubleType()),
    T.StructField("seller_name", T.StringType()), T.StructField("rating_numeric", T.DoubleType()),
    T.StructField("reviews_count", T.IntegerType()), T.StructField("platform", T.StringType()),
    T.StructField("product_type", T.StringType()), T.StructField("scraped_at", T.TimestampNTZType()),
    T.StructField("url", T.StringType()), T.StructField("raw_data", T.StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_LISTING_SCHEMA) -> DataFrame:
    """Header CSV with quoted multi-line fields (SRC1). Bad rows keep their text
    in ``_corrupt_record`` instead of failing the job."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    """UTF-8 header CSV (SRC3); list columns are joined with ' | '."""
    out = df.select(*[F.array_join(c, " | ").alias(c) if t.startswith("array") else F.col(c)
                      for c, t in df.dtypes])
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def latest_batch(spark: SparkSession, path_glob: str, schema: T.StructType = RAW_LISTING_SCHEMA,
                 fmt: str = "csv") -> DataFrame:
    """Rows of the newest batch among the files matching ``path_glob`` (SRC2): one
    scan, newest chosen from the ``_metadata`` column, no driver-side listing.
    Part files of one folder are one batch, as Spark writes them (their times
    differ); any other file is a batch by itself."""
    reader = spark.read.schema(schema)
    df = (reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path_glob)
          if fmt == "csv" else reader.parquet(path_glob))
    path = F.col("_metadata.file_path")
    df = df.withColumn("_batch", F.regexp_replace(path, "/part-[^/]*$", "/")).withColumn("_file_mtime", F.col("_metadata.file_modification_time"))
    newest = df.agg(F.max(F.struct("_file_mtime", "_batch"))["_batch"].alias("b")).scalar()
    return df.where(F.col("_batch") == newest).drop("_batch", "_file_mtime")


def order_columns(df: DataFrame, order: Sequence[str], fill_missing: bool = False) -> DataFrame:
    """Fixed leading column order, unknown columns kept at the end (SRC4)."""
    head = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
            for c in order if fill_missing or c in df.columns]
    rest = [c for c in df.columns if c not in order]
    return df.select(*head, *rest)


def read_table(spark: SparkSession, path: str, schema: T.StructType = PRODUCTS_SCHEMA) -> DataFrame:
    """Service table with a fixed schema (SRC5-SRC8); JSON kept as text."""
    return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append sink (SRC9)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
