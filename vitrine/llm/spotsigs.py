"""Document fingerprints: SpotSigs.

A spot is a common word (an anchor); its signature is the anchor with the chain of the next two content words. So
that texts in any language have spots, content words picked by their hash (every other one) are anchors too. A text's signatures form a multiset (repeats count); its fingerprint is the set's size and the smallest
``SKETCH`` signature hashes (the whole set, where it is no larger). The fingerprint is a compact string to store; likeness is the
exact Jaccard similarity of the whole sets, whatever their size. Comparisons are pruned by set length: two sets of
lengths a <= b cannot be more alike than a / b.

Cases: null text is empty and has the empty set; a text without any signature is one element; two empty sets are alike (1), an empty and
another are not (0); equal texts have equal fingerprints; texts of any length are read whole; an empty
table gives an empty result; other columns are ignored. ``edited_neighbours`` orders by doc_id descending, null
last, equal ids by text; a single document is its own next one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import words as W
from vitrine.llm.common import shuffle_partitions

#: Common words of English, French, German and Spanish.
ANCHORS = tuple("""
a an and are as at be by for from has he in is it its of on or she that the this to was were will with
au aux ce ces dans de des du elle en est et il la le les mais ne par pas pour qu que qui se son sur un une
aber als am auch auf aus bei das dem den der die ein eine einen er es für im ist mit nicht sich sie und von zu
al con como del el entre es esta lo los las más no o para pero por sin su y
""".split())
SKETCH = 96
#: One content word in so many is an anchor as well.
PICK = 2
#: A text's first words are elements by themselves as well, so that a text of a few words has some.
OPENING = 12
#: How far after its anchor a chain may reach.
REACH = 8


def signature_sets(col: pa.Array, anchors: tuple = ANCHORS) -> Iterator[np.ndarray]:
    """Each text's sorted signature hashes, repeats told apart by their number."""
    w = W.Words(col, plain=True)
    doc = w.doc()
    common = np.isin(w.h, W.hash_words(list(dict.fromkeys(anchors))))
    start = np.flatnonzero(common | (w.h % np.uint64(PICK) == 0))
    content = np.flatnonzero(~common)
    sig = W.mix(w.h[start])
    at = np.searchsorted(content, start, side="right")
    with np.errstate(over="ignore"):
        for step in range(2):
            nxt = content[np.minimum(at + step, len(content) - 1)] if len(content) else np.full(len(at), -1)
            ok = (at + step < len(content)) & (nxt - start <= REACH)
            ok[ok] = doc[nxt[ok]] == doc[start[ok]]
            sig = W.mix(sig + np.where(ok, w.h[nxt] if len(w.h) else 0, np.uint64(step + 1)) + np.uint64(step + 1))
    alone = np.flatnonzero(np.arange(len(w.h)) - np.repeat(w.first[:-1], w.n) < OPENING)
    sig, start = np.concatenate((sig, W.mix(w.h[alone]))), np.concatenate((start, alone))
    order = np.argsort(start, kind="stable")
    sig, start = sig[order], start[order]
    cut = np.searchsorted(start, w.first)
    for i in range(len(w.n)):
        x = np.sort(sig[cut[i] : cut[i + 1]])
        if not len(x) and w.off[i + 1] > w.off[i]:  # no spot: the text as a whole
            x = np.array([zlib.crc32(w.buf[w.off[i] : w.off[i + 1]].tobytes()) << 32], dtype=np.uint64)
        new = np.concatenate(([True], x[1:] != x[:-1])) if len(x) else np.zeros(0, bool)
        if not new.all():  # the k-th occurrence of a signature is an element of its own
            runs = np.flatnonzero(new)
            k = np.arange(len(x)) - np.repeat(runs, np.diff(np.append(runs, len(x))))
            x = np.sort(np.where(k > 0, W.mix(x ^ W.mix(k.astype(np.uint64))), x))
        yield x


def sketch(sigs: np.ndarray) -> tuple[int, np.ndarray]:
    """(set length, its smallest hashes, 32 bits each)."""
    return len(sigs), (sigs[:SKETCH] >> np.uint64(32)).astype(np.uint32)


def fingerprint(s: tuple[int, np.ndarray]) -> str:
    return f"{s[0]:x}:" + s[1].astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity of two signature sets, or 0 where the lengths alone rule out ``at_least``."""
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    if min(n, m) < at_least * max(n, m):
        return 0.0
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    inter = int(np.count_nonzero(both[1:] == both[:-1]))
    return inter / (n + m - inter)


def fingerprints(df: DataFrame) -> DataFrame:
    """doc_id, n_sigs, fingerprint."""

    def run(batches):
        for b in batches:
            for part in W.slices(b, 1):
                got = [sketch(s) for s in signature_sets(part.column(1))]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "n_sigs": pa.array([g[0] for g in got], pa.int64()),
                                                  "fingerprint": pa.array([fingerprint(g) for g in got], pa.string())})

    return df.select("doc_id", "text").mapInArrow(run, "doc_id long, n_sigs long, fingerprint string")


def _sets(df: DataFrame) -> DataFrame:
    """doc_id, n, sigs, fp: each document's signature set, its size and its identity."""

    def run(batches):
        for b in batches:
            for part in W.slices(b, 1):
                sigs = [s.view(np.int64) for s in signature_sets(part.column(1))]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "n": pa.array([len(s) for s in sigs], pa.int64()),
                                                  "sigs": pa.array(sigs, pa.list_(pa.int64()))})

    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, n long, sigs array<long>").withColumn("fp", F.xxhash64("sigs"))


def members(df: DataFrame) -> DataFrame:
    """fp, doc_id of every document, copies included: which documents a set in ``similar_pairs`` stands for."""
    return _sets(df).select("fp", "doc_id")


def similar_pairs(df: DataFrame, at_least: float = 0.8) -> DataFrame:
    """a, b, similarity over distinct signature sets that are at least so alike. ``a`` and ``b`` are the sets' ``fp`` in
    ``members``, which gives every document's.

    Sets meet only within a partition by length and under a hash that both have among the first
    n - ceil(at_least * n) + 1 of their order; every set goes to its own length partition and the next one, so
    that no pair whose lengths allow the similarity is missed. A set copied many times is one row."""
    import math

    ratio = -math.log(at_least)
    sets = _sets(df).where("n > 0").drop("doc_id").dropDuplicates(["fp"])
    prefix = F.slice("sigs", F.lit(1), (F.col("n") - F.ceil(at_least * F.col("n") - 1e-9) + 1).cast("int"))
    level = F.floor(F.log(F.col("n").cast("double")) / ratio).cast("long")
    rows = sets.select("fp", "n", level.alias("lv"), F.explode(prefix).alias("h"))
    left = rows.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("lv"), "h")
    right = rows.withColumn("lv", F.explode(F.array("lv", F.col("lv") - 1))).select(F.col("fp").alias("b"), F.col("n").alias("nb"), "lv", "h")
    fits = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    pairs = left.join(right, ["lv", "h"]).where(fits & (F.col("na") >= at_least * F.col("nb"))).select("a", "b").distinct()
    both = pairs.join(sets.select(F.col("fp").alias("a"), F.col("sigs").alias("sa")), "a").join(
        sets.select(F.col("fp").alias("b"), F.col("sigs").alias("sb")), "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    return both.withColumn("similarity", inter / (F.size("sa") + F.size("sb") - inter)).where(F.col("similarity") >= at_least).select("a", "b", "similarity")


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def edited_neighbours(df: DataFrame) -> DataFrame:
    """For each document: its fingerprint, that of its edited text (the last third of its code points replaced by the
    beginning of the next document in descending doc_id), and the likeness to the edited text and to that next one.

    Ids are cut into ranges (one column, quantile sketch); each range is read in order by one task and borrows the first
    document of the range after it, so that texts are shuffled once."""
    spark = df.sparkSession
    docs = df.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"))
    n = 4 * shuffle_partitions(spark)
    probs = [i / n for i in range(1, n)]
    cuts = sorted(set(docs.select(F.col("key").cast("double").alias("key")).approxQuantile("key", probs, 1 / (4 * n)))) or [0.0]
    ranges = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_key", outputCol="grp")
    docs = ranges.transform(docs.withColumn("_key", F.col("key").cast("double"))).drop("_key").withColumn("grp", F.col("grp").cast("int"))
    # one row per range: at most 4 times the number of shuffle partitions
    heads = [(r["grp"], r["key"]) for r in docs.groupBy("grp").agg(F.max("key").alias("key")).orderBy("grp").collect()]
    lend = [(heads[i][1], heads[i + 1][0]) for i in range(len(heads) - 1)] + [(heads[-1][1], heads[0][0])] if heads else []
    lend = F.broadcast(spark.createDataFrame(lend, "key long, to int"))
    lent = docs.join(lend, "key").select("doc_id", "text", "key", F.col("to").alias("grp"), F.lit(True).alias("lent"))
    rows = docs.withColumn("lent", F.lit(False)).select("doc_id", "text", "key", "grp", "lent").unionByName(lent)
    rows = rows.repartition(shuffle_partitions(spark), "grp").sortWithinPartitions("grp", "lent", F.desc("key"), "text")

    def run(batches):
        held = None
        for b in batches:
            for part in W.slices(b, "text"):
                part = part.select(["doc_id", "text", "grp", "lent"])
                if held is not None:
                    part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                held = part.slice(part.num_rows - 1)
                if part.num_rows > 1:
                    yield _compare(part)

    return rows.mapInArrow(run, OUT)


def _compare(rows: pa.RecordBatch) -> pa.RecordBatch:
    ids, texts = rows.column("doc_id").to_pylist(), [t or "" for t in rows.column("text").to_pylist()]
    group, lent = rows.column("grp").to_pylist(), rows.column("lent").to_pylist()
    at = [i for i in range(len(ids) - 1) if not lent[i] and group[i] == group[i + 1]]
    edited = []
    for i in at:
        k = len(texts[i]) // 3
        edited.append(texts[i][: len(texts[i]) - k] + texts[i + 1][:k])
    own = list(signature_sets(pa.array(texts, pa.large_string())))
    new = list(signature_sets(pa.array(edited, pa.large_string()))) if edited else []
    sha = [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array([ids[i] for i in at], pa.int64()), "n_chars": pa.array([len(texts[i]) for i in at], pa.int64()),
        "edited_sha256": pa.array(sha, pa.string()), "fingerprint": pa.array([fingerprint(sketch(own[i])) for i in at], pa.string()),
        "edited_fingerprint": pa.array([fingerprint(sketch(s)) for s in new], pa.string()),
        "near_edited": pa.array([likeness(own[i], s) for i, s in zip(at, new, strict=True)], pa.float64()),
        "near_next": pa.array([likeness(own[i], own[i + 1]) for i in at], pa.float64())})
