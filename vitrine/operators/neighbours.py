"""Exact nearest neighbours of every point among all others, as a Spark join.

Points are dealt to the nearest of a bounded number of pivots. Every point gets an upper bound of its k-th distance from
its own block (and, by the triangle inequality, from the pivots); then it is sent only to those cells that, again by the
triangle inequality, may hold a nearer point. Cells are cut into blocks and the points sent to them into chunks of bounded
size, so that no task holds a whole cell, however many points lie around one pivot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.session import cut_lineage

#: Points of a block, and of a chunk that meets it: the larger, the less often a point is sent.
BLOCK = 8192
#: Points and queries that are compared at once.
TILE = 1024
#: Most pivots; their coordinates travel to every task.
PIVOTS = 128


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T), 0.0))


def nearest_in_block(qid: np.ndarray, q: np.ndarray, pid: np.ndarray, p: np.ndarray, k: int, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, points and distances: the k nearest other points of each query, nearest first, ties to the smaller id; of those, with
    ``bound``, at least all that are within a query's bound. Tile by tile, products pick the candidates that may be nearer than the k-th so
    far, with a margin beyond their rounding; differences decide."""
    if not len(p) or not len(q):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    # the middle taken off, products round less
    shift = p.mean(axis=0)
    pc, half = p - shift, 0.5 * ((p - shift) ** 2).sum(axis=1)
    out = []
    for i in range(0, len(q), TILE):
        ids, mine = qid[i : i + TILE], q[i : i + TILE]
        qc = mine - shift
        norm = (qc * qc).sum(axis=1)
        limit = np.full(len(ids), np.inf) if bound is None else bound[i : i + TILE].astype(float)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for j in range(0, len(p), TILE):
            rough = half[None, j : j + TILE] - qc @ pc[j : j + TILE].T  # half of (distance squared - norm)
            margin = 1e-9 * (norm + 2 * half[j : j + TILE].max()) + 1e-300
            if not np.isfinite(limit).all() and rough.shape[1] >= k:  # k others of this tile are within it
                others = np.where(ids[:, None] == pid[None, j : j + TILE], np.inf, rough)
                kth = 2 * np.partition(others, k - 1, axis=1)[:, k - 1] + norm
                most = np.minimum(limit**2 * (1 + 1e-9), np.maximum(kth, 0) + margin)
            else:
                most = limit**2 * (1 + 1e-9)
            a, b = np.nonzero(rough <= ((most - norm) / 2 + margin)[:, None])
            b += j
            other = ids[a] != pid[b]
            a, b = a[other], b[other]
            if not len(a):
                continue
            d = np.sqrt(((p[b] - mine[a]) ** 2).sum(axis=1))
            a, b, d = (np.concatenate(x) for x in zip(best, (a, b, d), strict=True))
            o = np.lexsort((pid[b], d, a))
            a, b, d = a[o], b[o], d[o]
            first = np.searchsorted(a, np.arange(len(ids)))
            rank = np.arange(len(a)) - first[a]
            best = a[rank < k], b[rank < k], d[rank < k]
            full = rank == k - 1
            limit[a[full]] = np.minimum(limit[a[full]], d[full])
        out.append((ids[best[0]], pid[best[1]], best[2]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def knn_join(points: DataFrame, id_col: str, features: str, k: int = 5, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """a, b, dist, r: the k nearest other points b of each point a (r from 1; ties to the smaller id; all others, if they are
    fewer). ``features``: arrays of doubles of one length, without nulls; ``id_col``: distinct longs."""
    spark = points.sparkSession
    pts = cut_lineage(points.select(F.col(id_col).cast("long").alias("id"), F.col(features).alias("x")))
    n = pts.count()
    count = int(max(1, min(pivots, n // block)))
    centres = np.array([r["x"] for r in pts.orderBy(F.xxhash64("id"), "id").limit(count).collect()], dtype=float)
    if n < 2:
        return spark.createDataFrame([], "a long, b long, dist double, r int")
    shared = spark.sparkContext.broadcast(centres)

    def deal(frames):
        for f in frames:
            if len(f):
                d = _distances(np.array(f["x"].tolist(), dtype=float), shared.value)
                yield f.assign(cell=d.argmin(axis=1).astype(np.int32), far=list(d))

    dealt = cut_lineage(pts.mapInPandas(deal, "id long, x array<double>, cell int, far array<double>"))
    own = F.element_at("far", F.col("cell") + 1)
    # a row per pivot
    cells = {r["cell"]: r for r in dealt.groupBy("cell").agg(F.count("*").alias("n"), F.min(own).alias("lo"), F.max(own).alias("hi")).collect()}
    blocks = {c: -(-r["n"] // block) for c, r in cells.items()}
    per_cell = F.create_map(*[F.lit(x) for c, b in blocks.items() for x in (c, b)])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), per_cell[F.col("cell")]).cast("int"))

    def bound(f: pd.DataFrame) -> pd.DataFrame:
        ids, x = f["id"].to_numpy(), np.array(f["x"].tolist(), dtype=float)
        found = pd.DataFrame(dict(zip(("id", "b", "dist"), nearest_in_block(ids, x, ids, x, k), strict=True)))
        kth = found.groupby("id")["dist"].agg(["size", "max"])
        kth = kth["max"].where(kth["size"] >= k, np.inf).reindex(ids).fillna(np.inf).to_numpy()
        return f.assign(bound=kth)

    bounded = cut_lineage(dealt.groupBy("cell", "block").applyInPandas(
        bound, "id long, x array<double>, cell int, far array<double>, block int, bound double"))
    # what a cell's points are away at least: beyond its radius, inside its hollow, or across the plane between the pivots;
    # a little is taken off, as distances are rounded
    ring = F.array(*[F.struct(F.lit(c).alias("cell"), F.lit(float(r["lo"])).alias("lo"), F.lit(float(r["hi"])).alias("hi"), F.lit(blocks[c]).alias("blocks"))
                     for c, r in sorted(cells.items())])
    to = bounded.select("id", "x", "far", "bound", own.alias("own"), F.explode(ring).alias("t"))
    away = F.element_at("far", F.col("t.cell") + 1)
    least = F.greatest(away - F.col("t.hi"), F.col("t.lo") - away, (away - F.col("own")) / 2)
    slack = F.lit(1e-6) * (F.lit(1.0) + away + F.col("own"))
    to = to.where(least - slack <= F.col("bound")).select("id", "x", "bound", F.col("t.cell").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("t.blocks") - 1)).alias("block"))
    sent = {r["cell"]: r["n"] for r in to.where("block = 0").groupBy("cell").agg(F.count("*").alias("n")).collect()}
    chunks = {c: -(-sent.get(c, 1) // block) for c in cells}
    per_cell = F.create_map(*[F.lit(x) for c, b in chunks.items() for x in (c, b)])
    queries = to.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), per_cell[F.col("cell")]).cast("int"))
    there = dealt.select("id", "x", "cell", "block", F.explode(F.sequence(F.lit(0), per_cell[F.col("cell")] - 1)).alias("chunk"))

    def meet(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        at = lambda f: np.array(f["x"].tolist(), dtype=float).reshape(len(f), -1)
        found = nearest_in_block(q["id"].to_numpy(), at(q), p["id"].to_numpy(), at(p), k, q["bound"].to_numpy())
        return pd.DataFrame(dict(zip(("a", "b", "dist"), found, strict=True)))

    key = ["cell", "block", "chunk"]
    pairs = queries.groupBy(*key).cogroup(there.groupBy(*key)).applyInPandas(meet, "a long, b long, dist double")
    # Spark keeps the k first of a point within each task before the shuffle
    rank = F.row_number().over(Window.partitionBy("a").orderBy("dist", "b"))
    return pairs.withColumn("r", rank).where(F.col("r") <= k)
