"""Storing a batch of new listings (SCO4) with the exact insert-order duplicate
rule: a row is refused when an earlier *accepted* row (or a stored row) has
the same url or the same (title, seller). Rejected rows block nobody, so the
result is the greedy order-dependent choice, computed as a distributed
fixpoint: each round accepts every undecided row that is the earliest
non-rejected row of both its groups and rejects rows behind an accepted one.
Every round decides at least the earliest undecided row; lineage is cut with a
reliable checkpoint per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.session import cut_lineage

UNDECIDED, ACCEPTED, REJECTED = 0, 1, 2


def greedy_unique(df: DataFrame, seq: str, key_a: list, key_b: list) -> DataFrame:
    """Rows of ``df`` accepted in ``seq`` order so that no two accepted rows share key_a or key_b.

    Ends without a cap: the earliest undecided row is always decided, so the undecided rows grow fewer each round."""
    cur = cut_lineage(df.withColumn("_st", F.lit(UNDECIDED)))
    while True:
        live = cur.where(F.col("_st") != REJECTED)
        ma = live.groupBy(*key_a).agg(F.min(seq).alias("_ma"),
                                      F.min(F.when(F.col("_st") == ACCEPTED, F.col(seq))).alias("_aa"))
        mb = live.groupBy(*key_b).agg(F.min(seq).alias("_mb"),
                                      F.min(F.when(F.col("_st") == ACCEPTED, F.col(seq))).alias("_ab"))
        j = cur.join(ma, key_a, "left").join(mb, key_b, "left")
        und = F.col("_st") == UNDECIDED
        blocked = (F.col("_aa") < F.col(seq)) | (F.col("_ab") < F.col(seq))
        first = (F.col("_ma") == F.col(seq)) & (F.col("_mb") == F.col(seq))
        nxt = j.withColumn("_st", F.when(und & F.coalesce(blocked, F.lit(False)), F.lit(REJECTED))
                           .when(und & first, F.lit(ACCEPTED)).otherwise(F.col("_st"))).select(*cur.columns)
        nxt = cut_lineage(nxt)
        left = nxt.where(F.col("_st") == UNDECIDED).limit(1).count()
        cur = nxt
        if left == 0:
            break
    return cur.where(F.col("_st") == ACCEPTED).drop("_st")
