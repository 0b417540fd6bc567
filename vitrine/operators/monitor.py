"""Service monitoring aggregates (AGG12-15, MON*). ``as_of`` is always a
Column (usually the max timestamp of the table as a scalar subquery), never
the wall clock, so results are reproducible."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_ts(df: DataFrame, col: str) -> Column:
    return df.agg(F.max(col)).scalar()


def since(ts: str, as_of: Column, hours: int) -> Column:
    return F.col(ts) >= F.timestamp_add("HOUR", F.lit(-hours), as_of)


def seconds_between(a: Column, b: Column) -> Column:
    from vitrine.functions.partitioning import seconds_between_ntz
    return seconds_between_ntz(a, b)


def table_counts(tables: dict, ts_cols: dict, hours: int = 24) -> DataFrame:
    """Row counts of several tables and of their last ``hours`` (AGG1)."""
    frames = []
    for name, df in tables.items():
        ts = ts_cols[name]
        as_of = max_ts(df, ts)
        frames.append(df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("total"),
                             F.count_if(since(ts, as_of, hours)).alias("last_24h")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def scoring_stats(cls: DataFrame, low: float = 0.7) -> DataFrame:
    """Time and confidence statistics, low-confidence share, count by prediction (AGG12)."""
    by_pred = cls.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))
    counts = by_pred.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("prediction", "n"))))
                         .alias("by_prediction"))
    stats = cls.agg(F.avg("processing_time_ms").alias("avg_time_ms"), F.max("processing_time_ms").alias("max_time_ms"),
                    F.min("processing_time_ms").alias("min_time_ms"), F.avg("confidence_score").alias("avg_confidence"),
                    F.avg((F.col("confidence_score") < low).cast("double")).alias("low_confidence_share"),
                    F.count(F.lit(1)).alias("total"))
    from vitrine.functions.partitioning import with_scalars
    return with_scalars(stats, counts)


def endpoint_stats(ev: DataFrame) -> DataFrame:
    """Latency and errors (status >= 400) by endpoint, error rate (AGG13)."""
    return ev.groupBy("endpoint").agg(
        F.avg("latency_ms").alias("avg_latency_ms"), F.max("latency_ms").alias("max_latency_ms"),
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status_code") >= 400).alias("errors"),
    ).withColumn("error_rate", F.col("errors") / F.col("requests"))


def job_success_rate(jobs: DataFrame) -> Column:
    """processed / found, 0 when none found (MON8)."""
    return F.coalesce(F.try_divide(F.col("products_processed").cast("double"),
                                   F.nullif(F.col("products_found"), F.lit(0)).cast("double")), F.lit(0.0))


def job_stats(jobs: DataFrame) -> DataFrame:
    """Average / max duration, average success rate, jobs (AGG14)."""
    dur = seconds_between(F.col("started_at"), F.col("completed_at"))
    return jobs.agg(F.avg(dur).alias("avg_duration_s"), F.max(dur).alias("max_duration_s"),
                    F.avg(job_success_rate(jobs)).alias("avg_success_rate"), F.count(F.lit(1)).alias("jobs"))


def confidence_stats(cls: DataFrame) -> DataFrame:
    """Mean, population std, min, max confidence and success share (AGG15)."""
    return cls.agg(F.avg("confidence_score").alias("mean_confidence"),
                   F.stddev_pop("confidence_score").alias("std_confidence"),
                   F.min("confidence_score").alias("min_confidence"), F.max("confidence_score").alias("max_confidence"),
                   F.avg(F.col("prediction").isNotNull().cast("double")).alias("success_rate"),
                   F.count(F.lit(1)).alias("n"))


def scoring_health(cls: DataFrame, hours: int = 24, slow_ms: float = 5000.0, low: float = 0.7,
                   low_share_alert: float = 0.5) -> DataFrame:
    """Last-24h scoring statistics with alerts (MON2)."""
    as_of = max_ts(cls, "classified_at")
    recent = cls.where(since("classified_at", as_of, hours))
    s = recent.agg(F.count(F.lit(1)).alias("n_recent"),
                   F.avg(F.nullif(F.col("processing_time_ms"), F.lit(0))).alias("avg_processing_time_ms"),
                   F.max("processing_time_ms").alias("max_processing_time_ms"),
                   F.avg(F.nullif(F.col("confidence_score"), F.lit(0.0))).alias("avg_confidence_score"),
                   F.avg(F.when(F.col("confidence_score") != 0, (F.col("confidence_score") < low).cast("double")))
                   .alias("low_confidence_rate"))
    alerts = F.array_compact(F.array(
        F.when(F.col("n_recent") == 0, F.lit("No recent classifications")),
        F.when(F.col("avg_processing_time_ms") > slow_ms, F.lit("ML processing is slow")),
        F.when(F.col("low_confidence_rate") > low_share_alert, F.lit("High rate of low confidence predictions"))))
    return s.withColumn("alerts", F.array_join(alerts, "; ")).withColumn(
        "status", F.when(F.size(alerts) > 0, F.lit("degraded")).otherwise(F.lit("healthy")))


def job_health(jobs: DataFrame, last: int = 5, min_success: float = 0.8, stuck_hours: int = 2,
               stale_hours: int = 24) -> DataFrame:
    """Last N jobs: success share, stuck running jobs, hours since a success (MON3)."""
    as_of = max_ts(jobs, "started_at")
    recent = jobs.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(last)
    s = recent.agg(F.count(F.lit(1)).alias("recent_jobs"),
                   F.avg((F.col("status") == "completed").cast("double")).alias("success_rate"),
                   F.avg(job_success_rate(jobs)).alias("avg_processing_rate"),
                   F.avg(seconds_between(F.col("started_at"), F.col("completed_at"))).alias("avg_duration_s"))
    stuck = jobs.agg(F.count_if((F.col("status") == "running") &
                                (F.col("started_at") < F.timestamp_add("HOUR", F.lit(-stuck_hours), as_of)))
                     .alias("stuck_jobs"),
                     (seconds_between(F.max(F.when(F.col("status") == "completed", F.col("completed_at"))), as_of)
                      / 3600.0).alias("hours_since_success"))
    from vitrine.functions.partitioning import with_scalars
    j = with_scalars(s, stuck)
    alerts = F.array_compact(F.array(
        F.when(F.col("success_rate") < min_success, F.lit("Low scraper success rate")),
        F.when(F.col("stuck_jobs") > 0, F.lit("Jobs running too long")),
        F.when(F.col("hours_since_success") > stale_hours, F.lit("No successful job recently"))))
    return j.withColumn("alerts", F.array_join(alerts, "; "))


def throughput(cls: DataFrame, hours: int = 24, high: float = 0.8) -> DataFrame:
    """Totals, uptime hours since the first record, per-hour rate over 24h,
    share with confidence above ``high`` (MON4)."""
    as_of = max_ts(cls, "classified_at")
    return cls.agg(
        F.count(F.lit(1)).alias("total_classifications"),
        (seconds_between(F.min("classified_at"), as_of) / 3600.0).alias("uptime_hours"),
        (F.count_if(since("classified_at", as_of, hours)) / F.lit(float(hours))).alias("per_hour_24h"),
        F.avg(F.when(since("classified_at", as_of, hours), (F.col("confidence_score") > high).cast("double")))
        .alias("high_confidence_share"))


def threshold_alerts(stats_long: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Alert where a statistic passes its threshold (MON6). ``thresholds`` is a
    small config frame (metric, threshold, direction) and is broadcast."""
    j = stats_long.join(F.broadcast(thresholds), "metric")
    fire = F.when(F.col("direction") == "above", F.col("value") > F.col("threshold")) \
        .otherwise(F.col("value") < F.col("threshold"))
    return j.where(fire).select("metric", "value", "threshold", "direction")


def overall_status(component_status: DataFrame, key: Sequence[str] = ("ts",)) -> DataFrame:
    """healthy if every component is, unhealthy if none is, else degraded (MON7)."""
    ok = F.col("status") == "healthy"
    return component_status.groupBy(*key).agg(
        F.bool_and(ok).alias("all_ok"), F.bool_or(ok).alias("any_ok"),
        F.array_join(F.array_sort(F.collect_set(F.when(~ok, F.concat_ws(": ", "component", "status")))), "; ")
        .alias("alerts")
    ).select(*key, F.when(F.col("all_ok"), F.lit("healthy")).when(F.col("any_ok"), F.lit("degraded"))
             .otherwise(F.lit("unhealthy")).alias("overall_status"), "alerts")
