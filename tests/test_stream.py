"""Streaming semantics: availableNow over split files equals the batch answer,
and a row later than the watermark is dropped (SURVEY 5.4)."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from vitrine.session import checkpoint_dir
from vitrine.streaming import jobs as SJ

SCHEMA = "event_id long, ts timestamp_ntz, endpoint string, latency_ms double, status_code int"


def _write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def test_late_row_dropped(spark):
    base = os.path.join(checkpoint_dir(spark), f"late-{time.time_ns()}")
    t0 = dt.datetime(2024, 1, 1, 0, 5)
    first = [(i, t0 + dt.timedelta(minutes=30 * i), "api", 10.0 * i, 200) for i in range(10)]   # up to 04:35
    advance = [(101, t0 + dt.timedelta(hours=6), "api", 1.0, 200)]     # batch 2: the 00:00 window is emitted
    late = [(100, t0, "api", 999.0, 500)]                               # batch 3: 6 h behind the watermark
    _write(spark, first, base + "/in/a")
    time.sleep(1.1)
    _write(spark, advance, base + "/in/b")
    time.sleep(1.1)
    _write(spark, late, base + "/in/c")
    schema = spark.read.parquet(base + "/in/a").schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(base + "/in"))
    SJ.run_available_now(SJ.tumbling_stats(stream), base + "/out", base + "/ckpt")
    rows = [r for r in spark.read.parquet(base + "/out").collect() if r.window_start == dt.datetime(2024, 1, 1, 0, 0)]
    # the window was emitted once with its two on-time rows; the late row neither changed nor re-opened it
    assert [r.requests for r in rows] == [2]


def test_tumbling_equals_batch_on_split_files(spark):
    base = os.path.join(checkpoint_dir(spark), f"split-{time.time_ns()}")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_id", "ts", F.col("event_type").alias("endpoint"), F.col("value").alias("latency_ms"),
        F.when(F.col("value") > 90, 500).otherwise(200).alias("status_code"))
    ev.orderBy("ts").repartition(1).write.parquet(base + "/in")
    stream = spark.readStream.schema(ev.schema).parquet(base + "/in")
    SJ.run_available_now(SJ.tumbling_stats(stream), base + "/out", base + "/ckpt")
    got = {(r.window_start, r.requests) for r in spark.read.parquet(base + "/out").collect()}
    mx = ev.agg(F.max("ts")).first()[0]
    batch = (ev.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("w.end").cast("timestamp_ntz") <= F.lit(mx - dt.timedelta(minutes=10)))
             .select(F.col("w.start").cast("timestamp_ntz").alias("s"), "n").collect())
    assert got == {(r.s, r.n) for r in batch}


def test_refusal_by_two_keys_over_batches_and_restarts(spark):
    base = os.path.join(checkpoint_dir(spark), f"dedup-{time.time_ns()}")
    schema = "listing_id long, title string, seller_name string, url string, scraped_at timestamp_ntz"
    row = lambda i, t, s, u: (i, t, s, u, dt.datetime(2024, 1, 1))
    parts = [[row(3, "a", "s", "u1"), row(1, "a", "s", "u2"), row(2, "b", "s", "u2"), row(4, "stored", "s", "u9"), row(5, "x", "s", "ustored")],
             [row(6, "b", "s", "u3"), row(7, "c", "s", "u2"), row(8, None, "s", "u4"), row(9, None, "s", "u5"), row(10, "d", "s", ""), row(11, "e", "s", "")],
             [row(12, "d", "s", "u6"), row(13, "d", "other", "u7"), row(14, "f", "s", "u7"), row(15, "g", "s", "u9")]]
    stored = spark.createDataFrame([("ustored", "t0", "s0"), ("u0", "stored", "s"), ("", "t1", "s1")], "url string, title string, seller_name string")
    for k, part in enumerate(parts):
        spark.createDataFrame(part, schema).repartition(3).write.parquet(f"{base}/in/{k}")
        stream = spark.readStream.schema(schema).parquet(base + "/in/*")
        SJ.run_available_now(SJ.dedup_new_listings(stream, stored), base + "/out", base + "/ckpt", empty_batches=False)
    got = sorted(r.listing_id for r in spark.read.parquet(base + "/out").collect())
    # 2: url of 1; 3: title and seller of 1; 4, 5: stored; 7: url of 1; 12: title and seller of 10; 14: url of 13
    assert got == [1, 6, 8, 9, 10, 11, 13, 15]


def test_a_table_in_many_files_streams_whole(spark, tmp_path):
    from vitrine.plans.stream_queries import q_stream_ingest
    from vitrine.streaming import jobs as SJ
    pages = spark.createDataFrame([(i, f"u{i}", "x" * i) for i in range(9)], "page_id long, url string, html string")
    pages.repartition(3).write.parquet(f"{tmp_path}/many/pages.parquet")
    got = q_stream_ingest(spark, f"{tmp_path}/many").collect()
    assert sorted(tuple(r) for r in got) == [(i, f"u{i}", i) for i in range(9)]
    # files out of the order of event time lose no rows to the watermark
    for day in (9, 1):
        spark.sql(f"SELECT {day} AS event_id, timestamp_ntz'2024-01-0{day} 10:00:00' AS ts, 'v' AS event_type, 1.0 AS value") \
            .coalesce(1).write.mode("append").parquet(f"{tmp_path}/many/events.parquet")
    from vitrine.sources import fixtures as FX
    base = f"{tmp_path}/windows"
    SJ.run_available_now(SJ.endpoint_counts(FX.metrics_events_from(SJ.stream_table(spark, f"{tmp_path}/many", "events"))), None, base + "/ckpt",
                         mode="update", foreach_batch=SJ.upsert_batches(base + "/out", ["window_start", "endpoint"]))
    assert SJ.settled(spark, base + "/out", ["window_start", "endpoint"]).count() == 2
