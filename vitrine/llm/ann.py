"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``TREE_SAMPLE`` rows in hash order, taken only to place the centres); every
row is then put into its leaf. A query walks the tree with a priority queue of bins, nearest first, and visits leaves
until its budget is used. The budget is calibrated: sample queries are answered exactly over the sample and the
number of leaves is widened until their recall reaches the target. Scores are exact double-precision inner products
over the original vectors.

Equal vectors are one class: any query needs only its k + 1 smallest ids, so a class of any size costs k + 1 ids.
Neighbouring small leaves share a block, so that a query's vector is sent once for all of them; large leaves are cut
into several blocks, and visitors into blocks of queries, so no task holds a whole leaf. The blocks on a query's way are
visited in steps, the first with one block and each later one WIDEN times as wide; a step returns only what reaches the
query's k-th score so far (ties included), so what all steps return for a query grows with the logarithm of the blocks,
not with their number. Vectors go to a step only where a query visits their leaves, once for each block of visitors.

Cases: vectors that are null, empty, of another length than most, zero, or that hold null or non-finite
components take no part, neither as query nor as candidate; ties go to the smaller vec_id; rows that repeat
a vec_id with an equal vector count once, with different vectors are candidates of their own; null vec_ids take no
part; fewer candidates than k give them all, in which case every leaf is visited; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import checkpoint

#: Rows that place the tree's centres and calibrate the search: the bound on what the driver holds.
TREE_SAMPLE = 20_000
BRANCH, LEAF_ROWS = 8, 64
CALIBRATION_QUERIES = 200
#: Vectors of a leaf and queries visiting it that meet in one block.
BLOCK_VECTORS, BLOCK_QUERIES = 2048, 2048
#: How many times as many blocks each step of a search visits as the step before.
WIDEN = 4


class KMeansTree:
    """Centres of all nodes by level order; leaves are numbered from 0."""

    def __init__(self, x: np.ndarray, branch: int = BRANCH, leaf_rows: int = LEAF_ROWS, seed: int = 5):
        self.centres, self.children, self.leaf = [], [], []
        self.n_leaves = 0
        self._grow(x, np.random.default_rng(seed), branch, leaf_rows)

    def _grow(self, x, rng, branch, leaf_rows) -> int:
        me = len(self.children)
        self.children.append([])
        self.centres.append(None)
        self.leaf.append(-1)
        part = self._split(x, rng, branch) if len(x) > leaf_rows else None
        if part is None:
            self.leaf[me] = self.n_leaves
            self.n_leaves += 1
            return me
        label, centre = part
        kids = [self._grow(x[label == c], rng, branch, leaf_rows) for c in range(len(centre))]
        self.children[me] = kids
        self.centres[me] = centre
        return me

    @staticmethod
    def _split(x, rng, branch):
        centre = np.unique(x[rng.choice(len(x), size=min(branch, len(x)), replace=False)], axis=0)
        for _ in range(12):
            label = KMeansTree._nearest(x, centre)
            centre = np.array([x[label == c].mean(axis=0) for c in np.unique(label)])
        label = KMeansTree._nearest(x, centre)
        used, label = np.unique(label, return_inverse=True)
        return (label, centre[used]) if len(used) > 1 else None

    @staticmethod
    def _nearest(x, centre):
        return np.argmin((centre * centre).sum(1)[None, :] - 2 * x @ centre.T, axis=1)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: down the nearest centres."""
        out = np.zeros(len(x), dtype=np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            label = self._nearest(x[rows], self.centres[node])
            todo += [(kid, rows[label == c]) for c, kid in enumerate(self.children[node])]
        return out

    def best_bins(self, q: np.ndarray, leaves: int) -> list[int]:
        """The first ``leaves`` leaves for the query; the queue holds bins by inner product of query and centre,
        largest first, so that a bin left behind on one path is taken up when it is the best one open."""
        heap, found = [(0.0, 0)], []
        while heap and len(found) < leaves:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                found.append(self.leaf[node])
                continue
            for kid, s in zip(self.children[node], -(self.centres[node] @ q), strict=True):
                heapq.heappush(heap, (float(s), kid))
        return found


def _dot(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products whose rounding depends on the two vectors alone."""
    return np.multiply(v, q).sum(axis=-1)


def calibrate(tree: KMeansTree, x: np.ndarray, k: int, recall: float, seed: int = 7) -> int:
    """Leaves to visit so that sample queries find ``recall`` of their k nearest among the sample's rows."""
    if len(x) <= k + 1:
        return tree.n_leaves
    rng = np.random.default_rng(seed)
    ids = rng.choice(len(x), size=min(CALIBRATION_QUERIES, len(x)), replace=False)
    leaf = tree.assign(x)
    need = []
    for i in ids:
        s = x @ x[i]
        s[i] = -np.inf
        near = leaf[np.argpartition(-s, k)[:k]]
        order = {v: r for r, v in enumerate(tree.best_bins(x[i], tree.n_leaves))}
        need += [order[v] + 1 for v in near]
    return int(np.quantile(need, recall, method="higher"))


def usable(df: DataFrame) -> DataFrame:
    """vec_id, v array<double> of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    return df.select("vec_id", v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0").where(good)


def nearest(df: DataFrame, k: int = 20, every: int = 20, recall: float = 0.94) -> DataFrame:
    """query_id, rank, vec_id, score for queries vec_id % every = 0 (all rows are candidates).

    ``recall`` is the calibration target on the sample; larger tables have more rows a leaf than the sample, which
    leaves the share of near rows in the visited leaves as it is."""
    spark = df.sparkSession
    rows = usable(df)
    dim = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    out = "query_id long, rank int, vec_id long, score double"
    if dim is None:
        return spark.createDataFrame([], out)
    rows = rows.where(F.size("v") == dim["d"]).dropDuplicates(["vec_id", "v"])
    by = Window.partitionBy("v").orderBy("vec_id")
    # Equal vectors: row_number() <= k + 1 is cut before the shuffle as well, so a class sends k + 1 rows a task.
    kept = rows.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= k + 1)
    classes = checkpoint(kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    sample = classes.select("v").orderBy(F.xxhash64("v")).limit(TREE_SAMPLE).collect()
    x = np.array([r["v"] for r in sample])
    tree = KMeansTree(x)
    visits = calibrate(tree, x, k, recall)
    shared = spark.sparkContext.broadcast(tree)

    def leaves(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            if len(p):
                yield p.assign(leaf=shared.value.assign(np.array(p["v"].tolist())))

    placed = checkpoint(classes.mapInPandas(leaves, "v array<double>, ids array<long>, leaf long"))
    groups, many = pack(tree.n_leaves, placed.groupBy("leaf").count().collect())
    plan = spark.sparkContext.broadcast((groups, many))

    def route(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield p.assign(way=[shared.value.best_bins(np.asarray(v), visits) for v in p["v"]])

    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v")
    queries = checkpoint(asked.mapInPandas(route, "query_id long, v array<double>, way array<long>"))

    def count_visits(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, blocks = plan.value
        for p in parts:
            at = [(step, g) for way in p["way"] for step, g in {(step, g) for step, g, _, _ in blocks_on(way, of, blocks)}]
            yield pd.DataFrame(at, columns=["step", "grp"])

    visitors: dict[int, dict[int, int]] = {}  # at most steps x leaves entries
    for r in queries.mapInPandas(count_visits, "step int, grp long").groupBy("step", "grp").count().collect():
        visitors.setdefault(r["step"], {})[r["grp"]] = -(-r["count"] // BLOCK_QUERIES)
    best = None
    for step in sorted(visitors):
        found = _visit(placed, queries, best, plan, spark.sparkContext.broadcast(visitors[step]), step, k)
        both = found if best is None else best.select("query_id", "vec_id", "score").unionByName(found)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        best = checkpoint(both.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
    return best if best is not None else spark.createDataFrame([], out)


def blocks_on(way, of: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[int, int, int, list[int]]]:
    """(step, group, block of the group, leaves to look at) along a query's way. The steps widen: the first has one
    block, and each later one WIDEN times as many as the one before."""
    seen: dict[int, list[int]] = {}
    for leaf in way:
        seen.setdefault(int(of[leaf]), []).append(int(leaf))
    step, left = 0, 1
    for g, here in seen.items():
        for sv in range(int(blocks[g])):
            if not left:
                step, left = step + 1, WIDEN ** (step + 1)
            left -= 1
            yield step, g, sv, here


def _visit(placed: DataFrame, queries: DataFrame, best: DataFrame | None, plan, salts, step: int, k: int) -> DataFrame:
    """query_id, vec_id, score of what this step's blocks hold at or above each query's k-th score so far (all of a
    block's k best where it has fewer than k)."""

    def seat(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, many = plan.value
        for p in parts:
            g = of[p["leaf"].to_numpy()]
            p = p.assign(grp=g, sv=p["salt"].to_numpy() % many[g], copies=[salts.value.get(int(x), 0) for x in g])
            yield p.loc[p["copies"] > 0, ["v", "ids", "leaf", "grp", "sv", "copies"]]

    def send(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, many = plan.value
        for p in parts:
            found = [(query, v, here, g, sv, int(salt) % salts.value[g], floor)
                     for query, v, way, salt, floor in zip(p["query_id"], p["v"], p["way"], p["salt"], p["floor"], strict=True)
                     for at, g, sv, here in blocks_on(way, of, many) if at == step]
            yield pd.DataFrame(found, columns=["query_id", "v", "leaves", "grp", "sv", "sq", "floor"])

    vs = placed.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(1 << 20))).mapInPandas(
        seat, "v array<double>, ids array<long>, leaf long, grp long, sv long, copies int")
    vs = vs.withColumn("sq", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    if best is None:
        qs = queries.withColumn("floor", F.lit(float("-inf")))
    else:
        floors = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
        qs = queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    qs = qs.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(1 << 20))).mapInPandas(
        send, "query_id long, v array<double>, leaves array<long>, grp long, sv long, sq int, floor double")

    def meet(vecs: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vecs) and len(asks):
            v, q = np.array(vecs["v"].tolist()), np.array(asks["v"].tolist())
            here, leaf = np.unique(vecs["leaf"].to_numpy(), return_inverse=True)
            ids = vecs["ids"].tolist()
            rough = q @ v.T
            for i, (query, seen, floor) in enumerate(zip(asks["query_id"].tolist(), asks["leaves"], asks["floor"].tolist(), strict=True)):
                open_rows = np.flatnonzero(np.isin(here, seen)[leaf])
                if not len(open_rows):
                    continue
                s = rough[i, open_rows]
                m = min(k + 1, len(s))
                edge = max(floor, -np.partition(-s, m - 1)[m - 1])
                near = open_rows[s >= edge - 1e-9 * (1 + abs(edge))]
                exact = _dot(v[near], q[i])
                pairs = sorted((-x, c) for x, j in zip(exact.tolist(), near.tolist(), strict=True) if x >= floor for c in ids[j] if c != query)[:k]
                found += [(query, c, -x) for x, c in pairs]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    keys = ["grp", "sv", "sq"]
    return vs.groupBy(*keys).cogroup(qs.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")


def pack(n_leaves: int, counts) -> tuple[np.ndarray, np.ndarray]:
    """Group of each leaf, and into how many blocks each group is cut. Neighbouring leaves share a group of about
    BLOCK_VECTORS rows; a larger leaf is a group of its own, cut into several blocks."""
    rows = np.zeros(n_leaves, dtype=np.int64)
    for r in counts:
        rows[r["leaf"]] = r["count"]
    group, many, filled = np.zeros(n_leaves, dtype=np.int64), [1], 0
    for i, n in enumerate(rows.tolist()):
        if filled and filled + n > BLOCK_VECTORS:
            many.append(1)
            filled = 0
        group[i] = len(many) - 1
        filled += n
        many[-1] = max(1, -(-filled // BLOCK_VECTORS))
    return group, np.array(many)
