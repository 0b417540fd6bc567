"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Spread CPU-heavy per-row work (regex parsing, tokenising) over all task
    slots when the input arrives in fewer partitions than slots (small files).
    Inputs already split at least as wide -- the normal case on a cluster --
    are returned unchanged, so no extra shuffle happens at scale."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Adds every column of a 1-row frame to ``df`` as a scalar subquery (the
    optimizer merges them into one computation) -- no keyless join."""
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


# --------------------------------------------------------------- time zones --
from pyspark.sql import Column  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402



def _epoch_ntz() -> Column:
    # built on call: module import must not need a session (Python workers import this)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_instant(c: Column) -> Column:
    """A ``timestamp_ntz`` wall-clock value read as UTC, independent of the
    session time zone (no DST gaps or overlaps): rebuilt from its fields.
    (``timestampdiff`` on NTZ values follows the session zone, so it is not used.)"""
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def instant_to_ntz(c: Column) -> Column:
    """The UTC wall-clock of an instant as ``timestamp_ntz``, zone independent."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())


def seconds_between_ntz(a: Column, b: Column) -> Column:
    """b - a in seconds (fractional), computed on wall-clock values."""
    return (F.unix_micros(ntz_to_instant(b)) - F.unix_micros(ntz_to_instant(a))) / F.lit(1e6)
