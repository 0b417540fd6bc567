"""Connected components, and linking of sets by overlap, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import bounded_broadcast, checkpoint, forget, scratch, settled

#: Hubs that a key draws in a round, hubs that a node is compared with, and rounds before the rest is compared pair by pair.
HUBS, PICKS, ROUNDS = 3, 3, 8
#: A round that joins less than this part of what the first one joined is the last.
LITTLE = 500


def components(edges: DataFrame) -> DataFrame:
    """node, comp for the nodes of ``edges`` (a, b long; rows with a null end or equal ends are ignored, repeated rows count
    once). ``comp`` is a node of the component.

    Every node hooks to its smallest neighbour. These hooks have no cycles but pairs that hook to each other, whose
    smaller node becomes a root. They are followed to the roots by pointer jumping, and the graph is contracted, until no
    edge is left. A round at least halves the nodes that have edges, and jumps treble the steps they span: O(log n)
    rounds of O(log n) joins, each a row per node or edge."""
    spark = edges.sparkSession
    cur = checkpoint(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    out = None
    while not cur.isEmpty():
        past = [cur] if out is None else [cur, out]
        with scratch(spark) as keep:
            near = checkpoint(cur.union(cur.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")))
            n = near.count()
            hook = near.join(_step(near, "to", "_to", n), "to").select(
                "node", F.when((F.col("_to") == F.col("node")) & (F.col("node") < F.col("to")), F.col("node")).otherwise(F.col("to")).alias("to"))
            hook = _to_roots(checkpoint(hook), n)
            if out is None:
                out = hook.withColumnRenamed("to", "comp")
            else:
                out = out.join(_step(hook, "comp", "_to", n), "comp", "left").select("node", F.coalesce("_to", "comp").alias("comp"))
            out = keep(checkpoint(out))
            ends = cur.join(_step(hook, "a", "_a", n), "a").join(_step(hook, "b", "_b", n), "b").where("_a <> _b")
            cur = keep(checkpoint(ends.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()))
        forget(*past)
    if out is None:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return out


def _step(hook: DataFrame, node: str, to: str, n: int) -> DataFrame:
    """``hook`` (node, to; n rows) under other names, broadcast while that is small."""
    return bounded_broadcast(hook.select(F.col("node").alias(node), F.col("to").alias(to)), n)


def _to_roots(hook: DataFrame, n: int) -> DataFrame:
    """node, to: the pointers of ``hook``, all of whose ``to`` are nodes as well, followed to the nodes that point to themselves."""
    past = None
    while True:
        far = hook.join(_step(hook, "to", "_1", n), "to").join(_step(hook, "_1", "_2", n), "_1")
        far = checkpoint(far.select("node", F.col("_2").alias("to"), (F.col("to") != F.col("_2")).alias("moved")))
        if past is not None:
            forget(past)
        hook, past = far.select("node", "to"), far
        if far.where("moved").isEmpty():
            return hook


def overlapping(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` (a, b and more) whose sets have 100 * intersection >= percent * union. ``segments``: node,
    n (set size), frag, seg: a set's part in each fragment of the global order. Each fragment's partial overlap is
    counted on its own, and the counts are summed per pair."""
    sa = segments.select(F.col("node").alias("a"), F.col("n").alias("na"), "frag", F.col("seg").alias("sa"))
    sb = segments.select(F.col("node").alias("b"), F.col("n").alias("nb"), "frag", F.col("seg").alias("sb"))
    cols = pairs.columns
    # only the sets that pairs name are moved
    sa = sa.join(bounded_broadcast(checkpoint(pairs.select("a").distinct())), "a", "left_semi")
    sb = sb.join(bounded_broadcast(checkpoint(pairs.select("b").distinct())), "b", "left_semi")
    part = pairs.join(sa, "a").join(sb, ["b", "frag"]).select(*cols, "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("o"))
    both = part.groupBy(*cols, "na", "nb").agg(F.sum("o").alias("o"))
    return both.where(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))).select(*cols)


def hooked(found: DataFrame) -> tuple[DataFrame, int]:
    """comp, _to (and their count): the ends of ``found`` (ca, cb) that hook to a smaller neighbour, followed twice."""
    ends = found.union(found.select("cb", "ca")).groupBy(F.col("ca").alias("comp")).agg(F.min("cb").alias("_to"))
    hook = checkpoint(ends.where("_to < comp"))
    nxt = bounded_broadcast(hook.select(F.col("comp").alias("_to"), F.col("_to").alias("_far")))
    far = hook.join(nxt, "_to", "left").select("comp", F.coalesce("_far", "_to").alias("_to"))
    far = far.join(nxt, "_to", "left").select("comp", F.coalesce("_far", "_to").alias("_to"))
    far = checkpoint(far)
    return far, far.count()


def link(postings: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """node, comp: components of the sets that overlap enough, for nodes that share a key with another.

    ``postings``: key, node, n (set size), pos (elements of the set before this one in the global order, 0 where keys are no
    elements), q (the set's parities, see ``words.parities``: pairs that differ in too many are out at once). Any two sets
    that overlap enough share a key after whose ``pos`` either still holds enough elements; other pairs aren't compared. Groups are not expanded into all pairs. In rounds, every
    key draws a few hubs of its own; a node meets the hubs of all its keys, is compared with the ``PICKS`` that differ least in
    parities, and components that link are contracted. Rounds end when one joins little in comparison with the first.
    Then all pairs of different components that share a key are compared, so that no link is lost."""
    # keys, and nodes, count only as long as they hold several components
    several = lambda t: t.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    spark = postings.sparkSession
    with scratch(spark) as keep:
        live = postings.withColumn("comp", F.col("node"))
        live = keep(checkpoint(live.join(bounded_broadcast(checkpoint(several(live))), "key").select("key", "node", "n", "pos", "q", "comp")))
        nodes = keep(checkpoint(live.select("node").distinct().withColumn("comp", F.col("node"))))
    differ = sum((F.bit_count(F.col("q")[i].bitwiseXOR(F.col("qb")[i])) for i in range(4)), F.lit(0))
    fits = (100 * F.least("n", "nb") >= percent * F.greatest("n", "nb")) & (
        (100 + percent) * (F.col("n") - F.col("pos")) >= percent * (F.col("n") + F.col("nb"))) & (
        (100 + percent) * (F.col("nb") - F.col("posb")) >= percent * (F.col("n") + F.col("nb"))) & (
        (100 + percent) * differ <= (100 - percent) * (F.col("n") + F.col("nb")))
    waiting, first = None, 0

    def renamed(at: DataFrame, to: DataFrame, c: str) -> DataFrame:
        """``at`` with the component in column ``c`` contracted."""
        to = to.select(F.col("comp").alias(c), "_to")
        return at.join(to, c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")

    for r in range(ROUNDS):
        past = [nodes, live] if waiting is None else [nodes, live, waiting]
        with scratch(spark) as keep:
            hub = F.struct("node", "n", "pos", "q", "comp")
            hubs = live.groupBy("key").agg(F.array(*[F.min_by(hub, F.xxhash64("node", "key", F.lit(HUBS * r + j))) for j in range(HUBS)]).alias("hubs"))
            to = live.join(hubs, "key").select("node", "n", "pos", "q", "comp", F.explode("hubs").alias("h")).select(
                "node", "n", "pos", "q", "comp", F.col("h.node").alias("b"), F.col("h.n").alias("nb"), F.col("h.pos").alias("posb"), F.col("h.q").alias("qb"), F.col("h.comp").alias("cb")).where(fits & (F.col("comp") != F.col("cb")))
            near = F.struct((differ / (F.col("n") + F.col("nb"))).alias("d"), "b", "cb", F.col("comp").alias("ca"))
            pick = to.groupBy(F.col("node").alias("a"), F.pmod(F.xxhash64("b", "node"), F.lit(PICKS)).alias("slot")).agg(F.min(near).alias("x"))
            pairs = checkpoint(pick.select("a", "x.ca", "x.b", "x.cb"))
            found = overlapping(pairs, segments, percent).select("ca", "cb")
            found = checkpoint((found if waiting is None else found.union(waiting)).distinct())
            to, n = hooked(found)
            first = first or n
            to = bounded_broadcast(to, n)
            waiting = keep(checkpoint(renamed(renamed(found, to, "ca"), to, "cb").where("ca <> cb").select("ca", "cb")))
            nodes = keep(checkpoint(renamed(nodes, to, "comp")))
            live = renamed(live, to, "comp")
            live = keep(checkpoint(live.join(bounded_broadcast(checkpoint(several(live))), "key").select("key", "node", "n", "pos", "q", "comp")))
        forget(*past)
        if n <= first / LITTLE:
            break
    left = live.select("key", F.col("node").alias("a"), "n", "pos", "q", F.col("comp").alias("ca"))
    right = left.select("key", F.col("a").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("posb"), F.col("q").alias("qb"), F.col("ca").alias("cb"))
    pairs = left.join(right, "key").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & fits)

    def merged() -> DataFrame:
        found = overlapping(checkpoint(pairs.select("a", "b", "ca", "cb").distinct()), segments, percent).select("ca", "cb")
        to = components(found.union(waiting).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        to = bounded_broadcast(to.select(F.col("node").alias("comp"), F.col("comp").alias("_to")))
        return renamed(nodes, to, "comp").select("node", "comp")

    out = settled(spark, merged)
    forget(live, nodes, waiting)
    return out
