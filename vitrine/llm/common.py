"""Small helpers shared by the operators."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


#: Settings under which tables are written: a written table's shuffle files have no further use, and batches that go to
#: Python are a fifth of the default, as texts are long.
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


class _Open(threading.local):
    """Tables written in this thread's open ``scratch`` blocks, innermost last."""

    def __init__(self):
        self.blocks: list[list[DataFrame]] = []


_OPEN = _Open()


@contextmanager
def while_writing(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in WHILE_WRITING}
    for k, v in WHILE_WRITING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the cluster's shared folder and read again: cuts lineage, survives lost executors, and
    (other than ``DataFrame.checkpoint``) the plan that reads it inherits no constraints, whose inference costs more in
    each round of a loop. The folder is the driver's to clear, like any checkpoint; ``forget`` and ``scratch`` drop a table
    sooner. What was shuffled for the table goes as soon as it is written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    with while_writing(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    if _OPEN.blocks:
        _OPEN.blocks[-1].append(out)
    return out


def forget(*tables: DataFrame) -> None:
    """Delete checkpointed tables that no later plan reads."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._written)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables checkpointed in this block go at its end, and shuffle files of its counts at once; tables given to the block's
    function stay (till the end of the block around, if there is one)."""
    kept: list[DataFrame] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    _OPEN.blocks.append([])
    try:
        with while_writing(spark):
            yield keep
    finally:
        own = _OPEN.blocks.pop()
        forget(*(t for t in own if not any(t is k for k in kept)))
        if _OPEN.blocks:
            _OPEN.blocks[-1].extend(kept)


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``checkpoint(build())``, without the tables written on the way there."""
    with scratch(spark) as keep:
        return keep(checkpoint(build()))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of one to three longs that the driver and every executor hold easily, several at a time (some 8 MB as a hash table).
BROADCAST_ROWS = 200_000


def bounded_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` while its counted size is under BROADCAST_ROWS, else ``df`` (a shuffle join).

    ``df`` should be checkpointed and narrow: the count reads it once."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


#: Most bits of a sieve (16 MB); beyond, it lets more through.
SIEVE_BITS = 1 << 27


def sieve(nodes: DataFrame, n: int) -> np.ndarray:
    """Bits that are set for all of ``n`` nodes (and by chance for few others), so that a task can leave out units that a
    join would drop."""
    bits = min(SIEVE_BITS, 1 << max(16, (16 * n).bit_length()))
    at = F.col("node").bitwiseAND(F.lit(bits - 1))
    words = nodes.select(F.shiftright(at, 6).alias("i"), F.expr("shiftleft(1L, cast(node & 63 as int))").alias("b"))
    got = words.groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[got.column("i").to_numpy()] = got.column("b").to_numpy()
    return out.view(np.uint64)


def passes(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether the sieve lets each 64-bit hash through."""
    return bits[(x & np.uint64(64 * len(bits) - 1)) >> np.uint64(6)] >> (x & np.uint64(63)) & np.uint64(1) > 0
