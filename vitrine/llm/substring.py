"""Substring dedup: paragraph MinHash with banding, exact verification, and removal by components.

Paragraphs are short on purpose, so that a passage inside a longer text has paragraphs of its own: a paragraph ends
at a line break and after a word that ends in closing punctuation. Equal paragraphs (A-Z lowered, white space aside) are
one class. Paragraphs of at least ``LONG_WORDS`` words also get MinHash signatures over 5-word shingles, cut into bands
tuned so that a pair of the wanted similarity collides with the wanted probability; colliding classes are
compared exactly by Jaccard similarity, and classes become groups by connected components. (Fewer than ``LONG_WORDS``
words have at most three shingles, of which any difference leaves less than 0.8: for them only equality counts.)

Passages need not begin or end with a paragraph, nor have punctuation: runs of ``RUN`` words are units as well, at places
that the words themselves choose (of every ``WITHIN`` neighbouring runs the one with the smallest hash), so that two
copies choose alike whatever is around them. Equal runs are one class. In an exact copy the first chosen run begins and
the last one ends at most ``WITHIN`` - 1 words inside of the seams.

A group that occurs in several documents (a document: a doc_id with a text) is kept in the smallest doc_id (null last; of
equal ids in the smallest text hash). In the others its paragraphs and runs are
removable, and a stretch that these cover without a gap is removed when it holds ``MIN_WORDS`` words or more. An exact
passage of over 50 words is covered but for ``WITHIN`` - 1 words at each end at most, hence found wherever its seams
are; those few words stay in the text. A changed sentence between two shorter exact pieces is not bridged: each
piece counts by itself.

Cases: null and empty texts have no paragraphs; repetition inside one document is left alone; repeated rows of a document
are one document, whose span is reported once; different texts without a doc_id or under a repeated one are different
documents; texts of any length are read whole; an empty table gives an empty result; other columns are ignored, and
``remove_spans`` keeps them.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm import graph
from vitrine.llm import words as W
from vitrine.llm.common import SIEVE_BITS, bounded_broadcast, checkpoint, forget, passes, settled, shuffle_partitions, sieve

MIN_WORDS = 40
LONG_WORDS = 8
#: Words of a run, and neighbouring runs of which one is a unit.
RUN, WITHIN = 25, 6
SHINGLE, PERCENT, RECALL = 5, 80, 0.995
#: Bytes after which a paragraph ends (as a word's last).
_CLOSING = np.zeros(256, dtype=bool)
_CLOSING[[ord(c) for c in ".!?|;:*&%$#)]}\""]] = True
_LAST = (1 << 63) - 1
#: Bits of a band's key; the other bits of its 64 tell the paragraphs that have the key apart.
KEY_BITS = 44
#: Hashes that a task collects before it deals them out.
DEALT = 1 << 20
#: Paragraphs with a near copy whose groups tasks look up in an array (16 bytes each); more are joined.
LOOKED_UP = 1_000_000


def tune_bands(similarity: float = PERCENT / 100, recall: float = RECALL, rows: int = 3) -> tuple[int, int]:
    """(bands, rows): the fewest bands of ``rows`` minhashes with which pairs of that similarity collide that surely."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)), rows


class Paragraphs:
    """Paragraphs of a string column: word ranges a, b; hash; words; spans in code points; row."""

    def __init__(self, col: pa.Array):
        self.w = w = W.Words(col)
        if not len(w.h):
            self.a = self.b = self.row = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        line = np.cumsum(w.buf == 10, dtype=np.int32)
        new_line = line[w.s[1:]] != line[w.e[:-1] - 1]
        ends = np.append(_CLOSING[w.buf[w.e[:-1] - 1]] | new_line, True)
        ends[w.first[1:][w.n > 0] - 1] = True
        self.b = np.flatnonzero(ends) + 1
        self.a = np.concatenate(([0], self.b[:-1]))
        self.hash = W.run_hashes(w.h, self.a, self.b)
        self.row = np.searchsorted(w.first, self.a, side="right") - 1


def chosen_runs(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the runs that are units, the runs' hashes and rows (in order of the words)."""
    starts = len(w.h) - RUN + 1
    if starts < WITHIN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(starts)
    g = W.mix(W.run_hashes(w.h, at, at + RUN) ^ np.uint64(RUN))
    row = w.doc()
    least = np.min([g[i : starts - WITHIN + 1 + i] for i in range(WITHIN)], axis=0)
    least[row[: len(least)] != row[RUN + WITHIN - 2 :]] = 0  # these would reach into the next text
    padded = np.concatenate((np.zeros(WITHIN - 1, np.uint64), least, np.zeros(WITHIN - 1, np.uint64)))
    most = np.max([padded[i : starts + i] for i in range(WITHIN)], axis=0)
    a = np.flatnonzero(most == g)
    return a, g[a], row[a]


class Units:
    """Paragraphs and chosen runs, row by row: word ranges a, b (within the text), hash, row, spans s, e in code points,
    and whether it is a paragraph. With ``only`` (see ``shared``) those it lets through, else all, by row and hash alone."""

    def __init__(self, col: pa.Array, only: np.ndarray | None = None):
        p = Paragraphs(col)
        w = p.w
        a, g, row = chosen_runs(w)
        self.row, self.hash = np.concatenate((p.row, row)), np.concatenate((p.hash, g))
        order = np.argsort(self.row, kind="stable")
        if only is not None:
            order = order[_lets(only, self.hash[order])]
        self.row, self.hash = self.row[order], self.hash[order]
        if only is not None:
            first, last = np.concatenate((p.a, a))[order], np.concatenate((p.b, a + RUN))[order]
            chars = np.concatenate(([0], np.cumsum((w.buf & 0xC0) != 0x80, dtype=np.int64)))
            base = chars[w.off[self.row]]
            self.s, self.e = (chars[w.s[first]] - base, chars[w.e[last - 1]] - base) if len(first) else (first, last)
            self.a, self.b = first - w.first[self.row], last - w.first[self.row]
            self.whole = np.repeat((1, 0), (len(p.row), len(row)))[order]


def _parts(df: DataFrame) -> DataFrame:
    """doc, text: a document is its id and its text, so equal rows are one, and rows without an id or with a repeated id
    are told apart by their texts."""
    return df.select(F.xxhash64(F.col("doc_id").cast("long"), "text").alias("doc"), "text")


def _list(values: np.ndarray, counts: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, kind))


def _deal(values: np.ndarray, bits: int, width: int) -> pa.RecordBatch:
    """bucket, v: sorted 64-bit values cut by their first ``bits`` bits; v has of each the next ``width`` bits (32), or all 64."""
    at = np.searchsorted(values, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    some = np.flatnonzero(np.diff(np.append(at, len(values))))
    data = (values >> np.uint64(32 - bits)).astype(np.uint32) if width == 32 else values
    ends = np.append(at[some], len(values)).astype(np.int32) * (width // 8)
    v = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    return pa.RecordBatch.from_pydict({"bucket": pa.array(some.astype(np.int32)), "v": v})


def _bucket_bits(spark: SparkSession) -> int:
    """Buckets (as a power of two) that hashes are dealt to: several for each task."""
    return min(16, max(6, (8 * shuffle_partitions(spark) - 1).bit_length()))


def _dealing(batches, hashes, bits: int, width: int):
    """Batches of ``_deal`` from what ``hashes`` gives for each slice of texts, equal ones twice at most."""
    held, n = [], 0

    def flush():
        v = np.sort(np.concatenate(held))
        return _deal(v[np.concatenate((v[:2] == v[:2], v[2:] != v[:-2]))], bits, width)

    for b in batches:
        for part in W.slices(b, 1):
            held.append(hashes(part))
            n += len(held[-1])
            if n >= DEALT:
                yield flush()
                held, n = [], 0
    if n:
        yield flush()


def _lets(only: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether ``only`` has the bit at the place that each hash's first bits name."""
    at = x >> np.uint64(64 - (8 * len(only) - 1).bit_length())
    return only[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1) > 0


def shared(df: DataFrame, near: DataFrame) -> np.ndarray:
    """Bits that let through all units that several documents have and those in ``near`` (node), and few others.

    Texts' units are dealt to buckets by their hashes' first bits, sorted and without what these bits say, so that one costs
    four bytes; a bucket finds those dealt twice. Repeated rows of a document count as well: only what passes too
    much, never too little, comes of it."""
    spark = df.sparkSession
    bits = _bucket_bits(spark)

    def units(part):
        p = Units(part.column(1))
        order = np.argsort(p.hash, kind="stable")
        h, row = p.hash[order], p.row[order]
        return h[np.concatenate((h[:1] == h[:1], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))]

    def run(batches):
        yield from _dealing(batches, units, bits, 32)

    def run_near(batches):
        for b in batches:
            yield _deal(np.sort(np.repeat(b.column(0).to_numpy().view(np.uint64), 2)), bits, 32)

    dealt = _parts(df).mapInArrow(run, "bucket int, v binary").union(near.select("node").mapInArrow(run_near, "bucket int, v binary"))

    def twice(t: pa.Table) -> pa.Table:
        x = np.sort(np.frombuffer(b"".join(t.column("v").to_pylist()), np.uint32))
        x = x[1:][x[1:] == x[:-1]]
        x = x[np.concatenate((x[:1] == x[:1], x[1:] != x[:-1]))]
        return pa.table({"bucket": t.column("bucket").slice(0, 1).cast(pa.int32()), "n": pa.array([len(x)], pa.int64()), "v": pa.array([x.tobytes()], pa.binary())})

    found = checkpoint(dealt.groupBy("bucket").applyInArrow(twice, "bucket int, n long, v binary"))
    n = found.agg(F.sum("n")).first()[0] or 0
    size = max(bits + 3, min(SIEVE_BITS.bit_length() - 1, max(16, (16 * n).bit_length())))

    def marked(batches):
        for b in batches:
            out = []
            for v in b.column(1).to_pylist():
                mark = np.zeros(1 << (size - bits), np.uint8)
                mark[np.frombuffer(v, np.uint32) >> np.uint32(32 - size + bits)] = 1
                out.append(np.packbits(mark, bitorder="little").tobytes())
            yield pa.RecordBatch.from_pydict({"bucket": b.column(0), "v": pa.array(out, pa.binary())})

    got = found.select("bucket", "v").mapInArrow(marked, "bucket int, v binary").toArrow()
    out = np.zeros((1 << bits, 1 << (size - bits - 3)), np.uint8)
    for i, v in zip(got.column("bucket").to_pylist(), got.column("v").to_pylist(), strict=True):
        out[i] = np.frombuffer(v, np.uint8)
    forget(found)
    return out.reshape(-1)


def _long(p: Paragraphs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Long paragraphs' first occurrences in this slice, all 5-word shingles of the texts, and each one's shingle count."""
    pick = np.flatnonzero(p.b - p.a >= LONG_WORDS)
    pick = pick[np.unique(p.hash[pick], return_index=True)[1]]
    return pick, W.ngrams(p.w.h, SHINGLE), (p.b - p.a)[pick] - SHINGLE + 1


def _band_keys(p: Paragraphs, n_bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of this slice's long paragraphs, their shingle counts, and their bands' keys (a row for each paragraph)."""
    pick, g, size = _long(p)
    keys = np.zeros((n_bands, len(pick)), dtype=np.uint64)
    if len(pick):
        seeds = W.mix(np.arange(1, n_bands * rows + 1, dtype=np.uint64))
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        at = np.arange(size.sum()) - np.repeat(start, size) + np.repeat(p.a[pick], size)
        x = g[at]
        y = np.empty_like(x)
        with np.errstate(over="ignore"):
            for i in range(n_bands):
                for r in range(rows):
                    # multiply-shift on hashes that are mixed already: one product per permutation
                    np.bitwise_xor(x, seeds[i * rows + r], out=y)
                    np.multiply(y, W._M1, out=y)
                    low = np.minimum.reduceat(y, start)
                    keys[i] = W.mix(keys[i] + low)
                keys[i] = W.mix(keys[i] + np.uint64(i + 1))
    return p.hash[pick], size, keys.T >> np.uint64(64 - KEY_BITS)


def live_keys(df: DataFrame, n_bands: int, rows: int) -> DataFrame:
    """key: the bands' keys that several long paragraphs have. They are dealt to buckets by their first bits, each with some
    bits of its paragraph's hash in the same 64."""
    bits = _bucket_bits(df.sparkSession)
    rest = 64 - KEY_BITS

    def keyed(part):
        node, _, keys = _band_keys(Paragraphs(part.column(1)), n_bands, rows)
        return (keys << np.uint64(rest) | (node >> np.uint64(KEY_BITS))[:, None]).reshape(-1)

    def run(batches):
        yield from _dealing(batches, keyed, bits, 64)

    def several(t: pa.Table) -> pa.Table:
        x = np.sort(np.frombuffer(b"".join(t.column("v").to_pylist()), np.uint64))
        key = (x >> np.uint64(rest))[1:][(x[1:] != x[:-1]) & (x[1:] >> np.uint64(rest) == x[:-1] >> np.uint64(rest))]
        return pa.table({"key": pa.array(np.unique(key).view(np.int64))})

    return _parts(df).mapInArrow(run, "bucket int, v binary").groupBy("bucket").applyInArrow(several, "key long")


def bands(df: DataFrame, n_bands: int, rows: int, only: np.ndarray) -> DataFrame:
    """key, node, n: the bands of long paragraphs that ``only`` (see ``sieve``) lets through (n: at most so many shingles)."""
    shared = df.sparkSession.sparkContext.broadcast(only)

    def run(batches):
        for b in batches:
            for part in W.slices(b, 1):
                node, size, keys = _band_keys(Paragraphs(part.column(1)), n_bands, rows)
                at, band = np.nonzero(passes(shared.value, keys))
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(keys[at, band].view(np.int64)), "node": pa.array(node[at].view(np.int64)), "n": pa.array(size[at].astype(np.int32))})

    return _parts(df).mapInArrow(run, "key long, node long, n int")


def shingle_sets(df: DataFrame) -> DataFrame:
    """node, n, q, h: the shingle sets (q: their parities) of long paragraphs."""

    def run(batches):
        for b in batches:
            for part in W.slices(b, 1):
                p = Paragraphs(part.column(1))
                pick, g, size = _long(p)
                sets = [W.distinct_sorted(g[a : a + k]) for a, k in zip(p.a[pick].tolist(), size.tolist(), strict=True)]
                n = np.array([len(s) for s in sets], dtype=np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_pydict({"node": pa.array(p.hash[pick].view(np.int64)), "n": pa.array(n), "q": W.parities(sets), "h": _list(flat, n, pa.int64())})

    return _parts(df).mapInArrow(run, "node long, n int, q array<long>, h array<long>")


def near_classes(df: DataFrame) -> DataFrame:
    """node, comp of the long paragraphs that have a near copy."""
    n_bands, rows = tune_bands()
    live = checkpoint(live_keys(df, n_bands, rows))
    n = live.count()
    post = bands(df, n_bands, rows, sieve(live.withColumnRenamed("key", "node"), n))
    post = checkpoint(post.join(bounded_broadcast(live, n), "key").groupBy("key", "node").agg(F.max("n").alias("n")))
    nodes = checkpoint(post.select("node").distinct())
    sets = shingle_sets(df).join(bounded_broadcast(nodes), "node", "left_semi").dropDuplicates(["node"])
    sets = checkpoint(sets.select("node", "n", "q", F.lit(0).alias("frag"), F.col("h").alias("seg")))
    post = post.drop("n").join(sets.select("node", "n", "q"), "node").select("key", "node", "n", F.lit(0).alias("pos"), "q")
    return graph.link(post, sets, PERCENT)


def duplicate_spans(df: DataFrame) -> DataFrame:
    """doc_id, text_hash, start, end (code points of the text, end excluded), n_words, n_paragraphs, kept_doc_id.

    A group is repeated where one of its units is in another document than the group's smallest: so units need no
    table of what is repeated, only bits that leave out nearly all others (see ``shared``)."""
    spark = df.sparkSession
    near = settled(spark, lambda: near_classes(df))
    look_up = near.count() <= LOOKED_UP
    got = (near if look_up else near.limit(0)).toArrow()
    near_node, near_comp = (got.column(c).to_numpy() for c in ("node", "comp"))
    order = np.argsort(near_node)
    known = spark.sparkContext.broadcast((shared(df, near), near_node[order], near_comp[order]))

    def run(batches):
        for b in batches:
            for part in W.slices(b, 1):
                only, node, comp = known.value
                p = Units(part.column(1), only)
                if not len(p.row):
                    continue
                u = p.hash.view(np.int64)
                if len(node):
                    at = np.minimum(np.searchsorted(node, u), len(node) - 1)
                    u = np.where(node[at] == u, comp[at], u)
                n = np.bincount(p.row, minlength=part.num_rows)
                yield pa.RecordBatch.from_pydict({
                    "doc": part.column(0), "th": part.column(2), "u": _list(u, n, pa.int64()),
                    "w": _list(p.a << 32 | p.b << 1 | p.whole, n, pa.int64()), "c": _list(p.s << 32 | p.e, n, pa.int64())})

    docs = df.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), "text", F.xxhash64("text").alias("th"))
    units = docs.mapInArrow(run, "doc long, th long, u array<long>, w array<long>, c array<long>")
    units = units.select("doc", "th", F.explode(F.arrays_zip("u", "w", "c")).alias("x")).select(
        "doc", "th", F.col("x.u").alias("grp"), F.col("x.w").alias("w"), F.col("x.c").alias("c"))
    if not look_up:
        units = units.join(near.withColumnRenamed("node", "grp"), "grp", "left").withColumn("grp", F.coalesce("comp", "grp")).drop("comp")
    hit = checkpoint(units)
    first = checkpoint(hit.groupBy("grp").agg(F.min(F.struct("doc", "th")).alias("x")).select("grp", F.col("x.doc").alias("keep"), F.col("x.th").alias("keep_th")))
    hit = hit.join(bounded_broadcast(first), "grp").where("doc <> keep or th <> keep_th").select("doc", "th", "w", "c", "keep")
    order = Window.partitionBy("doc", "th").orderBy("w")
    # repeated rows of a document are one document
    hit = hit.withColumn("again", F.coalesce(F.lag("w").over(order) == F.col("w"), F.lit(False)))
    hit = hit.withColumn("a", F.shiftright("w", 32)).withColumn("b", F.shiftright(F.col("w").bitwiseAND(F.lit((1 << 32) - 1)), 1))
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    hit = hit.withColumn("new", F.when(F.col("a") <= reach, 0).otherwise(1))
    hit = hit.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = F.when(~F.col("again"), F.col("w").bitwiseAND(F.lit(1))).otherwise(0)
    spans = hit.groupBy("doc", "th", "run").agg(
        F.min(F.shiftright("c", 32)).cast("int").alias("start"), F.max(F.col("c").bitwiseAND(F.lit((1 << 32) - 1))).cast("int").alias("end"),
        (F.max("b") - F.min("a")).cast("long").alias("n_words"), F.sum(whole).alias("n_paragraphs"), F.min("keep").alias("keep"))
    spans = spans.where(F.col("n_words") >= MIN_WORDS)
    real = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return spans.select(real("doc").alias("doc_id"), F.col("th").alias("text_hash"), "start", "end", "n_words", "n_paragraphs",
                        real("keep").alias("kept_doc_id"))


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans cut out of their texts (and n_chars counted anew, where there is such a column)."""
    cols = docs.columns
    of = spans.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cut")).select(
        F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("th"), "_cut").alias("spans"))
    own, found, new = (f"{x}_{uuid.uuid4().hex}" for x in ("th", "spans", "text"))
    of = of.withColumnRenamed("spans", found)
    at = lambda c: F.col(f"{found}.{c}")
    j = docs.withColumn(own, F.xxhash64("text")).join(of, F.col("doc_id").eqNullSafe(at("id")) & (F.col(own) == at("th")), "left")
    cut = at("_cut")

    def piece(i):
        start = F.when(i == 0, 0).otherwise(cut[i - 1]["end"])
        to = F.when(i == F.size(cut), F.char_length("text")).otherwise(cut[i]["start"])
        return F.substr("text", start + 1, to - start)

    text = F.when(cut.isNull(), F.col("text")).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.size(cut)), piece), ""))
    out = j.withColumn(new, text)
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(cut.isNull(), F.col("n_chars")).otherwise(F.char_length(new).cast("long")))
    return out.withColumn("text", F.col(new)).select(*cols)
