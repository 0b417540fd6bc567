"""Bootstrap of the AUC by row weights (EVA10).

Every row draws a Poisson(1) weight for each replicate from an integer hash of its id and the replicate's number: one rule for
all rows, whatever their ties, which SQL can follow. Rows are range partitioned by (key, score, id), so neither a key nor a
score is gathered in one task, and each range sums its weights for all replicates at once as arrays. A range passes on its
first and its last score, which other ranges may share, and what lies between them: three rows per key. Their offsets are
running sums over those few rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The hash: x = id * A + replicate * B + seed, then twice x * (x * x + C), all modulo the prime P.
P, A, B, C = 2**31 - 1, 48271, 69621, 1103515245
#: The hash values from which a weight is at least 1, 2, ...
STEPS = [math.floor(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) * P) for k in range(12)]
#: Rows whose weights are drawn at a time.
ROWS = 1000


def weights(ids: np.ndarray, replicates: int, seed: int) -> np.ndarray:
    """Weight of each row (down) in each replicate (across)."""
    x = ((ids % P) * A % P)[:, None] + (np.arange(1, replicates + 1, dtype=np.int64) * B + seed) % P
    x %= P
    for _ in range(2):
        x = x * ((x * x + C) % P) % P
    return np.searchsorted(np.array(STEPS), x, side="right")


def weight_sql(row: str, rep: str, seed: int) -> str:
    """The same weight as SQL over integer expressions."""
    x = f"((({row}) % {P} * {A} % {P} + ({rep} * {B} + {seed}) % {P}) % {P})"
    for _ in range(2):
        x = f"list_transform([{x}], lambda x: x * ((x * x + {C}) % {P}) % {P})[1]"
    return f"list_sum(list_transform([{x}], lambda x: {' + '.join(f'CAST(x >= {t} AS BIGINT)' for t in STEPS)}))::BIGINT"


class _Range:
    """Sums of one key over a range of its scores in rising order. ``first`` and ``last``: (score, positives, negatives)."""

    def __init__(self):
        self.first = self.last = self.inner = None

    def extend(self, score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> None:
        """The next scores with the weights of their rows; the first may be the last one seen."""
        if self.last is not None:
            s, p, n = self.last
            if s == score[0]:
                pos[0] += p
                neg[0] += n
            else:
                score, pos, neg = np.append(s, score), np.vstack([p, pos]), np.vstack([n, neg])
        self.last = (score[-1], pos[-1], neg[-1])
        score, pos, neg = score[:-1], pos[:-1], neg[:-1]
        if len(score) and self.first is None:
            self.first = (score[0], pos[0], neg[0])
            score, pos, neg = score[1:], pos[1:], neg[1:]
        if len(score):
            at, p, n, wins = self.inner or (score[0], 0.0, 0.0, 0.0)
            below = np.cumsum(neg, axis=0) - neg + n
            self.inner = (at, p + pos.sum(axis=0), n + neg.sum(axis=0), wins + (pos * (2 * below + neg)).sum(axis=0))

    def rows(self) -> Iterator[tuple]:
        """(score, edge, positives, negatives, twice the wins among them)."""
        for e in (self.first, self.last):
            if e is not None:
                yield e[0], True, e[1], e[2], e[1] * e[2]
        if self.inner is not None:
            at, p, n, wins = self.inner
            yield at, False, p, n, wins


def auc_by_replicate(pred: DataFrame, key: str = "model", replicates: int = 1000, seed: int = 42) -> DataFrame:
    """(key, rep, auc) of rows (key, row_id, y_true, proba). Rows without id, class or score take no part; a replicate that
    draws no row of one class has no row."""
    rows = pred.where(F.col("proba").isNotNull() & F.col("row_id").isNotNull() & F.col("y_true").isin(0, 1)).select(
        F.col(key).alias("k"), F.col("proba").cast("double").alias("score"), F.col("row_id").cast("long").alias("row_id"),
        F.col("y_true").cast("int").alias("y"))
    order = ["k", "score", "row_id"]
    parts = int(pred.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, state = None, None

        def out():
            got = [(here, *r) for r in state.rows()] if state else []
            return pd.DataFrame(got, columns=["k", "score", "edge", "pos", "neg", "wins"])

        for batch in batches:
            for i in range(0, len(batch), ROWS):
                part = batch.iloc[i:i + ROWS]
                k = part["k"].to_numpy()
                score, y = part["score"].to_numpy(), part["y"].to_numpy()[:, None]
                w = weights(part["row_id"].to_numpy(), replicates, seed).astype(float)
                new = np.ones(len(k), dtype=bool)
                new[1:] = (k[1:] != k[:-1]) | (score[1:] != score[:-1])
                at = np.flatnonzero(new)
                pos, neg = np.add.reduceat(w * y, at, axis=0), np.add.reduceat(w * (1 - y), at, axis=0)
                runs = np.flatnonzero(np.concatenate(([True], k[at][1:] != k[at][:-1])))
                for a, b in zip(runs, np.append(runs[1:], len(at)), strict=True):
                    if state is None or k[at[a]] != here:
                        yield out()
                        here, state = k[at[a]], _Range()
                    state.extend(score[at[a:b]], pos[a:b], neg[a:b])
        yield out()

    schema = "k string, score double, edge boolean, pos array<double>, neg array<double>, wins array<double>"
    units = ranged.mapInPandas(sums, schema)
    one = units.select("k", "score", "edge", F.posexplode(F.arrays_zip("pos", "neg", "wins")).alias("rep", "x"))
    one = one.select("k", "score", "edge", (F.col("rep") + 1).alias("rep"), "x.*").groupBy("k", "rep", "score", "edge").agg(
        *[F.sum(c).alias(c) for c in ("pos", "neg", "wins")])
    # an edge's rows may come from several ranges
    one = one.withColumn("wins", F.when(F.col("edge"), F.col("pos") * F.col("neg")).otherwise(F.col("wins")))
    below = Window.partitionBy("k", "rep").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    cum = one.withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0.0)))
    got = cum.groupBy("k", "rep").agg(F.sum(F.col("wins") + 2 * F.col("pos") * F.col("below")).alias("w"),
                                      F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return got.where((F.col("p") > 0) & (F.col("n") > 0)).select(F.col("k").alias(key), "rep", (F.col("w") / (2 * F.col("p") * F.col("n"))).alias("auc"))


def auc_interval(aucs: DataFrame, key: str = "model", level: float = 0.95) -> DataFrame:
    """Mean, std and percentile interval over the replicates."""
    tail = (1 - level) / 2
    return aucs.groupBy(key).agg(F.avg("auc").alias("auc_mean"), F.stddev_samp("auc").alias("auc_std"),
                                 F.percentile("auc", tail).alias("ci_lower"), F.percentile("auc", 1 - tail).alias("ci_upper"),
                                 F.count(F.lit(1)).alias("replicates"))
