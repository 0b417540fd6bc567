"""Distributed prefix sums.

A cumulative window with no partition key (or one coarse key such as a model
name) runs in a single task. ``prefix_sums`` avoids that: rows are range
partitioned on (keys, order), each range computes local running sums, the
per-range totals (one row per range and key: small and bounded by the
partition count) give every range its offset, and a broadcast join adds it.

The range id is materialised with a reliable ``checkpoint()`` into the
cluster's ``spark.checkpoint.dir`` before it is used twice: range bounds are
sampled, so two independently planned branches could disagree on them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefix_sums(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str],
                descending: bool = False, partitions: int | None = None) -> DataFrame:
    """Adds ``cum_<v>`` = sum of ``v`` over rows with the same keys and an
    order value up to and including this row's. ``order`` must be unique per key."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = F.col(order).desc() if descending else F.col(order).asc()
    from vitrine.session import cut_lineage
    r = df.repartitionByRange(n, *[F.col(k) for k in keys], o).withColumn("_pid", F.spark_partition_id())
    r = cut_lineage(r)
    w_local = Window.partitionBy("_pid", *keys).orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    w_part = Window.partitionBy("_pid", *keys)
    local = r.withColumns({**{f"_loc_{v}": F.sum(v).over(w_local) for v in values},
                           **{f"_tot_{v}": F.sum(v).over(w_part) for v in values}})
    tots = local.select("_pid", *keys, *[f"_tot_{v}" for v in values]).distinct()
    # offsets: a window over the small per-range totals (ranges x keys rows)
    w_off = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tots.select("_pid", *keys, *[F.coalesce(F.sum(f"_tot_{v}").over(w_off), F.lit(0)).alias(f"_off_{v}")
                                        for v in values])
    out = local.join(F.broadcast(offs), ["_pid", *keys])
    return out.select(*df.columns, *[(F.col(f"_loc_{v}") + F.col(f"_off_{v}")).alias(f"cum_{v}") for v in values])
