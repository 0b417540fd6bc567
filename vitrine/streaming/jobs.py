"""Structured Streaming forms of the service's polling loops (STR1-STR8).

Sources are file streams over the parquet tables; every query is
checkpointed under the cluster's ``spark.checkpoint.dir`` so a restarted or
failed run resumes exactly where it stopped. Event time comes from the data
(``timestamp_ntz`` cast to ``timestamp`` under a UTC session), watermarks bound
all state, and rows later than the watermark are dropped -- the only semantics
added to the reference.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import checkpoint_dir, table_path


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A parquet table, one file or a folder of files, as a file stream (schema taken from the batch table).

    A table's files lie in no order of event time, so by default they come in one trigger: with one after the other, rows
    of a later file would be late. The path is a pattern that fits the table alone: it takes a file as well as a folder."""
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    s = spark.readStream.schema(schema)
    if max_files:
        s = s.option("maxFilesPerTrigger", max_files)
    return s.parquet(path[:-1] + f"[{path[-1]}]")


def run_dir(spark: SparkSession, tag: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"stream-{tag}-{uuid.uuid4().hex[:10]}")


def run_available_now(df: DataFrame, sink: str, ckpt: str, mode: str = "append", foreach_batch=None,
                      partition_by=(), empty_batches: bool = True) -> None:
    """Process everything available, then stop (STR7 trigger). State is kept in RocksDB, off the executors' heap.

    ``empty_batches``: whether batches without rows may follow, as windows need that wait for the watermark; with state that
    lives by processing time they would follow without end."""
    conf, want = df.sparkSession.conf, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
                                        "spark.sql.streaming.noDataMicroBatches.enabled": str(empty_batches).lower()}
    before = {k: conf.get(k) for k in want}
    try:
        for k, v in want.items():
            conf.set(k, v)
        _run(df, sink, ckpt, mode, foreach_batch, partition_by)
    finally:
        for k, v in before.items():
            conf.set(k, v)


def _run(df: DataFrame, sink: str, ckpt: str, mode: str, foreach_batch, partition_by) -> None:
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        if partition_by:
            w = w.partitionBy(*partition_by)
        q = w.format("parquet").option("path", sink).start()
    q.awaitTermination()


def event_time(col: str) -> F.Column:
    """Event time instant of a wall-clock (NTZ) column, read as UTC whatever
    the session time zone."""
    from vitrine.functions.partitioning import ntz_to_instant
    return ntz_to_instant(F.col(col))


def wall(c) -> F.Column:
    from vitrine.functions.partitioning import instant_to_ntz
    return instant_to_ntz(c)


def tumbling_stats(events: DataFrame, ts: str = "ts", delay: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Latency and error statistics per tumbling window (STR2)."""
    e = events.withColumn("_et", event_time(ts)).withWatermark("_et", delay)
    g = e.groupBy(F.window("_et", size).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), F.avg("latency_ms").alias("avg_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"), F.count_if(F.col("status_code") >= 400).alias("errors"))
    return g.select(wall(F.col("w.start")).alias("window_start"),
                    wall(F.col("w.end")).alias("window_end"), "requests", "avg_latency_ms",
                    "max_latency_ms", "errors")


def sliding_counts(events: DataFrame, ts: str = "ts", delay: str = "10 minutes", size: str = "24 hours",
                   slide: str = "1 hour") -> DataFrame:
    """24 h look-back counts every hour (STR3)."""
    e = events.withColumn("_et", event_time(ts)).withWatermark("_et", delay)
    g = e.groupBy(F.window("_et", size, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("status_code") >= 400).alias("errors"))
    return g.select(wall(F.col("w.start")).alias("window_start"),
                    wall(F.col("w.end")).alias("window_end"), "events", "errors")


def endpoint_counts(events: DataFrame, ts: str = "ts", delay: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Requests and errors by (window, endpoint), emitted in update mode (STR4)."""
    e = events.withColumn("_et", event_time(ts)).withWatermark("_et", delay)
    g = e.groupBy(F.window("_et", size).alias("w"), "endpoint").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status_code") >= 400).alias("errors"))
    return g.select(wall(F.col("w.start")).alias("window_start"), "endpoint", "requests", "errors")


def upsert_batches(sink: str, keys, extra=None):
    """foreachBatch writer for update mode: each micro-batch's changed rows are
    appended with their batch id; readers keep the newest row per key."""
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("_batch_id", F.lit(batch_id))
        if extra is not None:
            b = extra(b)
        b.write.mode("append").parquet(sink)
    return write


def settled(spark: SparkSession, sink: str, keys, schema=None) -> DataFrame:
    """Latest row per key of an upsert sink: a struct max, combined map-side."""
    df = spark.read.parquet(sink) if schema is None else spark.read.schema(schema).parquet(sink)
    rest = [c for c in df.columns if c not in keys and c != "_batch_id"]
    g = df.groupBy(*keys).agg(F.max(F.struct("_batch_id", *rest)).alias("_l"))
    return g.select(*keys, *[F.col("_l." + c).alias(c) for c in rest])


def first_of_key(rows: DataFrame, keys: list, seq: str, ttl_hours: int) -> DataFrame:
    """Rows of a stream whose ``keys`` did not come before: of a key's rows the first micro-batch's one with the least ``seq``.

    A value state per key, in the state store, remembers for ``ttl_hours`` of processing time that the key has come, so
    state is bounded by the keys of that time. A row whose key holds a null or an empty value is never refused. A key's
    rows are read block by block, none are held but the least."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    names = rows.columns

    class FirstSeen(StatefulProcessor):
        def init(self, handle):
            self._seen = handle.getValueState("seen", "seq long", ttl_hours * 3600 * 1000)

        def handleInputRows(self, key, blocks, timers):
            least = None
            for b in blocks:
                i = b[seq].idxmin()
                if least is None or b.at[i, seq] < least.at[0, seq]:
                    least = b.loc[[i], names].reset_index(drop=True)
            if least is not None and not self._seen.exists():
                self._seen.update((int(least.at[0, seq]),))
                yield least
            else:
                yield pd.DataFrame(columns=names)

        def close(self):
            pass

    blank = F.lit(False)
    for k in keys:
        blank = blank | F.coalesce(F.col(k) == "", F.lit(True))
    own = F.when(blank, F.col(seq).cast("string")).otherwise("")
    keyed = rows.withColumns({f"_key{i}": F.coalesce(F.col(k).cast("string"), F.lit("")) for i, k in enumerate(keys)} | {"_own": own})
    return keyed.groupBy(*[f"_key{i}" for i in range(len(keys))], "_own").transformWithStateInPandas(
        statefulProcessor=FirstSeen(), outputStructType=rows.schema, outputMode="Append", timeMode="ProcessingTime")


def dedup_new_listings(listings_stream: DataFrame, stored: DataFrame, seq: str = "listing_id", ttl_hours: int = 24 * 365) -> DataFrame:
    """Refuse a listing seen before (STR5), by url and then by (title, seller).

    Against the stored table: stream-static anti joins; against the stream itself: two keyed states, each in the order in
    which rows come. A listing refused by its url leaves no trace in the (title, seller) state, as in the service, which
    looks a listing up among those it has stored; one refused by (title, seller) has marked its url already, so a later
    listing with that url is refused as well (the service would take it; a stream has no way back to the first state)."""
    by_url = stored.where(F.col("url") != "").select("url").distinct()
    by_name = stored.where((F.col("title") != "") & (F.col("seller_name") != "")).select("title", "seller_name").distinct()
    s = listings_stream.join(by_url, "url", "left_anti").join(by_name, ["title", "seller_name"], "left_anti").select(*listings_stream.columns)
    s = first_of_key(s, ["url"], seq, ttl_hours)
    return first_of_key(s, ["title", "seller_name"], seq, ttl_hours)


def stuck_jobs(starts: DataFrame, ends: DataFrame, bound_hours: int = 2, delay: str = "1 hour") -> DataFrame:
    """Jobs with no completion within ``bound_hours`` of their start (STR8): a
    stream-stream left outer join with a time bound; a start is emitted with a
    null end once the watermark passes its bound, so state stays bounded."""
    s = starts.select(F.col("id").alias("s_id"), event_time("started_at").alias("s_t")).withWatermark("s_t", delay)
    e = ends.where(F.col("completed_at").isNotNull()).select(
        F.col("id").alias("e_id"), event_time("completed_at").alias("e_t")).withWatermark("e_t", delay)
    cond = (F.col("s_id") == F.col("e_id")) & (F.col("e_t") >= F.col("s_t")) & \
        (F.col("e_t") <= F.col("s_t") + F.expr(f"INTERVAL {bound_hours} HOURS"))
    j = s.join(e, cond, "leftOuter")
    return j.select(F.col("s_id").alias("id"), wall(F.col("s_t")).alias("started_at"),
                    wall(F.col("e_t")).alias("completed_at"))
