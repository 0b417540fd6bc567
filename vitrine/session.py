"""Session helpers: a tuned local session for tests and benches, and the
shared checkpoint folder that long lineages are cut to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "vitrine", checkpoint: str | None = None) -> SparkSession:
    """Session for local runs; ``checkpoint`` sets ``spark.checkpoint.dir``. On a cluster the
    platform's session is used as is."""
    builder = SparkSession.builder
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = (
        builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Unset, a single-machine session (tests) gets a private folder; on a cluster that would be a
    folder executors do not share, so it is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="vitrine-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (never a local one)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df):
    """``df`` written once as a table in the shared checkpoint folder and read again, column by column."""
    path = f"{checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark, path: str) -> None:
    """Removes what was written at ``path`` of the shared checkpoint folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per application), wherever they were started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="vitrine-code-"), "vitrine_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(home)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
