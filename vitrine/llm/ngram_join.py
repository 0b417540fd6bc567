"""N-gram Jaccard join by vertical partitioning.

A document's set holds its distinct n-word shingles as 64-bit hashes; the hash is the global order of all n-grams, cut
into fragments of equal width. Fragments are worked on separately and their partial overlaps summed per pair:

1. In the first fragments of the order (``FIRST`` times the part of its n-grams that a linked set may lose) it is counted how many of a set's n-grams occur in
   another set as well. A set that loses more n-grams there than a linked set may lose in all cannot be linked and
   goes: for most documents nothing but these fragments is ever shuffled.
2. Of the sets left, n-grams are ordered by how many sets hold them, rarest first. Linked sets share one of the first
   (n - required + 1), so only these become candidates' keys, and common passages make none. With each goes its place in
   the order, as a pair is only compared where either set still holds enough n-grams from there on.
3. Candidates are compared fragment by fragment, and the partial overlaps are summed per pair (see ``graph``).

Equal sets are one class from the beginning, so copies cost nothing beyond step 1's counting, which adds up within
tasks first. Two sets share an identity or two n-grams a hash with a probability of about 2**-64 a pair.

Cases: null and empty texts and texts without words have the empty set (0 shingles) and are linked with nothing, each its own
component; repeated rows keep their own result rows; rows with a null doc_id take part, and a component's id is the
smallest doc_id that is not null (null if none is); texts of any length are read whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import graph
from vitrine.llm import words as W
from vitrine.llm.common import SIEVE_BITS, bounded_broadcast, checkpoint, forget, passes, settled, sieve

#: Part of the global order that is looked at first, as a multiple of the part of its n-grams that a linked set may lose.
#: At 1 nothing would be told apart; more tells more apart, and shuffles more.
FIRST = 1.4
#: Fragments in which candidates are compared.
FRAGMENTS = 4


def _set_id(s: np.ndarray) -> int:
    """64-bit identity of a set from two passes over its sorted hashes."""
    with np.errstate(over="ignore"):
        a = W.mix(s).sum(dtype=np.uint64)
        b = W.mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
        x = W.mix(np.array([a + np.uint64(len(s))], np.uint64) ^ W.mix(np.array([b], np.uint64)))
    return int(x.view(np.int64)[0])


def shingle_rows(df: DataFrame, n: int, first: float = 0) -> DataFrame:
    """doc_id, th (the text's hash), node (identity of the set), n (its size), h: the hashes in the first part of the order
    (``first``: how large a part), or all with q, the set's parities (``first`` 0)."""
    limit = np.uint64(int(first * 2**64)) if first < 1 else None

    def run(batches):
        for b in batches:
            for part in W.slices(b, 1):
                node, size, h = [], [], []
                for s in W.shingle_sets(part.column(1), n):
                    node.append(_set_id(s))
                    size.append(len(s))
                    h.append(s[: np.searchsorted(s, limit)] if limit else s)
                got = {"doc_id": part.column(0), "th": part.column(2), "node": pa.array(node, pa.int64()), "n": pa.array(size, pa.int32())}
                if not first:
                    got["q"] = W.parities(h)
                off = np.concatenate(([0], np.cumsum([len(x) for x in h])))
                flat = np.concatenate(h) if h else np.zeros(0, np.uint64)
                got["h"] = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_pydict(got)

    schema = "doc_id long, th long, node long, n int" + (", h array<long>" if first else ", q array<long>, h array<long>")
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th")).mapInArrow(run, schema)


def possible(first: DataFrame, percent: int) -> DataFrame:
    """node, id: sets that the first fragments leave, each with one doc_id (step 1). ``first``: node, doc_id, n, h."""
    first = first.where("n > 0")
    may_lose = F.col("n") - F.ceil(F.col("n") * percent / 100.0).cast("int")
    posts = first.select("node", F.explode("h").alias("h"))
    shared = posts.groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select(F.col("h").alias("node"))
    shared = checkpoint(shared)
    n_shared = shared.count()
    if n_shared > SIEVE_BITS // 16:
        hit = posts.join(shared.withColumnRenamed("node", "h"), "h").groupBy("node").agg(F.count("*").alias("held"))
        sets = first.groupBy("node").agg(F.min("doc_id").alias("id"), F.max("n").alias("n"), F.max(F.size("h")).alias("in_first"), F.count("*").alias("rows"))
        # the join counts a set's n-grams once for each copy of it
        return sets.join(hit, "node", "left").where(F.coalesce("held", F.lit(0)) / F.col("rows") >= F.col("in_first") - may_lose).select("node", "id")
    bits = first.sparkSession.sparkContext.broadcast(sieve(shared, n_shared))

    def held(batches):
        for b in batches:
            h = b.column(3)
            hit = passes(bits.value, h.flatten().to_numpy().view(np.uint64))
            size = h.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(size)), size)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(size.astype(np.int32)), pa.array(np.bincount(row, hit, len(size)).astype(np.int32))],
                                             ["node", "doc_id", "n", "in_first", "held"])

    # a sieve counts an n-gram too many now and then, and so may let a set through, but never loses one
    counted = first.select("node", "doc_id", "n", "h").mapInArrow(held, "node long, doc_id long, n int, in_first int, held int")
    return counted.where(F.col("held") >= F.col("in_first") - may_lose).groupBy("node").agg(F.min("doc_id").alias("id"))


def rare_first(sets: DataFrame, percent: int) -> DataFrame:
    """key, node, n, pos, q: for each set the n-grams of which linked sets must share one, in the order of rarity (step 2)."""
    posts = sets.select("node", F.explode("h").alias("h"))
    often = posts.groupBy("h").agg(F.count("*").alias("f")).where("f > 1")
    ranked = posts.join(often, "h").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "h"))).alias("live"))
    # n-grams that no other set holds come first in the order and cannot be shared
    lose = F.col("n") - F.ceil(F.col("n") * percent / 100.0).cast("int")
    alone = F.col("n") - F.size("live")
    both = ranked.join(sets.select("node", "n", "q"), "node").withColumn("take", lose + 1 - alone).where("take > 0")
    both = both.select("node", "n", "q", alone.alias("alone"), F.posexplode(F.slice("live", F.lit(1), F.col("take"))).alias("i", "x"))
    return both.select(F.col("x.h").alias("key"), "node", "n", (F.col("alone") + F.col("i")).alias("pos"), "q")


def segments(sets: DataFrame) -> DataFrame:
    """node, n, frag, seg: each set cut at the fragments' borders."""
    def part(f: int):
        return F.filter("h", lambda x: F.pmod(F.shiftright(x, 62), F.lit(FRAGMENTS)) == f)

    cut = F.array(*[F.struct(F.lit(f).alias("frag"), part(f).alias("seg")) for f in range(FRAGMENTS)])
    return sets.select("node", "n", F.explode(cut).alias("x")).select("node", "n", "x.frag", "x.seg")


def _linked(df: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, node, n of every row; node, id, comp of every set: its smallest doc_id and its component)."""
    spark = df.sparkSession
    first = checkpoint(shingle_rows(df, n, FIRST * (100 - percent) / 100))
    keep = settled(spark, lambda: possible(first, percent))
    rows = checkpoint(first.drop("h"))
    forget(first)

    def linked() -> DataFrame:
        ids = bounded_broadcast(keep.select(F.col("id").alias("_id")).distinct())
        # every set by one of its documents (by all that have no doc_id)
        some = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        some = some.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        sets = shingle_rows(some, n).drop("doc_id", "th").join(keep.select("node"), "node", "left_semi").dropDuplicates(["node"])
        sets = checkpoint(sets)
        posts = checkpoint(rare_first(sets, percent))
        parts = checkpoint(segments(sets.join(posts.select("node").distinct(), "node", "left_semi")))
        forget(sets)
        return graph.link(posts, parts, percent)

    comp = settled(spark, linked)
    classes = rows.groupBy("node").agg(F.min("doc_id").alias("id"))
    return rows, classes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def jaccard_components(df: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: documents are linked when 100 * intersection >= percent * union
    of their shingle sets, and a component is what links reach."""
    rows, linked = _linked(df, n, percent)
    smallest = linked.groupBy("comp").agg(F.min("id").alias("component_id"))
    of = linked.join(smallest, "comp").select("node", "component_id")
    out = rows.join(of, "node")
    alone = F.col("n") == 0
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def representatives(df: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, th, n_shingles, copies: one document (doc_id and hash of its text; the smallest doc_id, null last, then
    the smallest hash) of each component, and every document without words. ``copies``: the rows that are this document."""
    rows, linked = _linked(df, n, percent)
    docs = rows.groupBy("doc_id", "th", "node", "n").agg(F.count("*").alias("copies"))
    docs = checkpoint(docs.join(linked.select("node", "comp"), "node"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th", "n", "copies")
    first = docs.where("n > 0").groupBy("comp").agg(F.min(order).alias("x")).select("x.doc_id", "x.th", "x.n", "x.copies")
    return first.union(docs.where("n = 0").select("doc_id", "th", "n", "copies")).withColumnRenamed("n", "n_shingles")
