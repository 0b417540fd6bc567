"""Language-model scoring with a weighted backoff automaton.

States are contexts (the empty one, words, word pairs); arcs carry the discounted probability of a word after its
context, and a failure arc leads from each context to its shorter one with the weight left over:
P(w | h) = max(c(hw) - D, 0) / c(h) + D * t(h) / c(h) * P(w | shorter h), t(h) being the distinct words seen after h, which
sums to 1. The state carried along a text is its last two words.

Every training word, pair and triple has its arc, with its exact count; none is left out for being rare, and nothing of the
automaton is broadcast. Texts are dealt to slices by hash. A slice asks for its own n-grams, each once, together with how
often it saw them in training; the questions are dealt by hash to groups of bounded size, summed there and answered
(``_answers``). That is done for triples, pairs and words, in this order: of all that ask for a trained n-gram one is
told to be the first, and says so for the n-gram's context in the next question, so that the sums of these are t(h). With the
answers a slice holds that part of the automaton its texts go through, and adds up log probabilities.

The unigram level is absolute discounting too: (c - D) / N for a known word, D * V / N for all unknown ones together,
D = n1 / (n1 + 2 n2).

Cases: null text is empty and consists of the end token; a null doc_id is a training row; repeated rows are counted
and scored each; an empty table gives an empty result, and without training rows every probability is 1; texts of any length are
read whole; other columns are ignored. Two n-grams share a hash with a probability of about 2**-64 a pair.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import words as W
from vitrine.llm.common import checkpoint

#: Bytes of text in a slice, and in each of the groups that answer.
SLICE, GROUP = 8 << 20, 6 << 20
#: Shares of the training tokens that words and n-grams of the excerpt (``Model.automaton``) make up at least.
WORD_SHARE, STATE_SHARE = 2.0**-20, 2.0**-18
#: Hashes of the end token and of the text start (a context only).
END, START = np.uint64(0x1B873593CC9E2D51), np.uint64(0x38B34AE5A1E38B93)
#: Distinct keys a counting task holds before it passes them on.
HELD = 1_500_000


def _counted(parts: Iterator[np.ndarray], name: str = "g") -> Iterator[pa.RecordBatch]:
    """(key, count) of a stream of key arrays, combined within the task."""
    held_k, held_c, size = [], [], 0

    def merge():
        k, c = np.concatenate(held_k), np.concatenate(held_c)
        o = np.argsort(k, kind="stable")
        k, c = k[o], c[o]
        at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
        return (k[at], np.add.reduceat(c, at)) if len(k) else (k, c)

    for keys in parts:
        k, c = np.unique(keys, return_counts=True)
        held_k.append(k)
        held_c.append(c)
        size += len(k)
        if size > 2 * HELD:
            k, c = merge()
            if len(k) > HELD:
                yield pa.RecordBatch.from_pydict({name: pa.array(k.view(np.int64)), "c": pa.array(c, pa.int64())})
                held_k, held_c, size = [], [], 0
            else:
                held_k, held_c, size = [k], [c], len(k)
    if held_k:
        k, c = merge()
        yield pa.RecordBatch.from_pydict({name: pa.array(k.view(np.int64)), "c": pa.array(c, pa.int64())})


def _tokens(part: pa.RecordBatch, col: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text followed by END; first token of each text; token counts."""
    w = W.Words(part.column(col))
    n = w.n + 1
    first = np.concatenate(([0], np.cumsum(n)))
    t = np.empty(first[-1], dtype=np.uint64)
    t[first[1:] - 1] = END
    at = np.ones(first[-1], dtype=bool)
    at[first[1:] - 1] = False
    t[at] = w.h
    return t, first, n


def _pack(x: np.ndarray) -> bytes:
    """Counts as the smallest integers that hold them all (see ``_unpack``)."""
    return x.astype(np.min_scalar_type(int(x.max()))).tobytes()


def _unpack(col: pa.Array, n: np.ndarray) -> np.ndarray:
    """The counts of all rows, row by row; ``n``: how many a row has."""
    got = [np.frombuffer(x, f"u{len(x) // k}").astype(np.int64) for x, k in zip(col.to_pylist(), n.tolist(), strict=True)]
    return np.concatenate(got) if got else np.zeros(0, np.int64)


def _pack_keys(k: np.ndarray) -> bytes:
    """Ascending keys as their differences, byte by byte, so that the leading zeros compress."""
    return np.diff(k, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack_keys(x: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(np.uint64)[:, 0], dtype=np.uint64)


class Part:
    """The n-grams of some texts: words, pairs and triples by index, ``h``: their hashes, ``of``: index of each token's (that
    of a text's first token has no triple), ``context``: index of a pair's or triple's context."""

    def __init__(self, texts: pa.Array, trained: np.ndarray):
        t, self.first, self.n = _tokens(pa.RecordBatch.from_arrays([texts], ["text"]), 0)
        begin = self.first[:-1]
        words, word = np.unique(t, return_inverse=True)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[begin] = len(words)  # the start is a context
        pairs, pair = np.unique(before << 31 | word, return_inverse=True)
        self.inner = np.ones(len(t), dtype=bool)
        self.inner[begin] = False
        at = np.flatnonzero(self.inner)
        triples, triple = np.unique(pair[at - 1] << 31 | word[at], return_inverse=True)
        low = (1 << 31) - 1
        self.of, self.context = [word, pair, triple], [None, pairs >> 31, triples >> 31]
        with np.errstate(over="ignore"):
            h1 = np.append(words, START)
            h2 = W.mix(W.mix(h1[pairs >> 31] ^ np.uint64(2)) + h1[pairs & low])
            h3 = W.mix(W.mix(h2[triples >> 31] ^ np.uint64(3)) + words[triples & low])
        self.h = [h1, h2, h3]
        often = np.repeat(trained, self.n).astype(np.float64)
        weights = [np.bincount(word, often, len(words)), np.bincount(pair, often), np.bincount(triple, often[at], len(triples))]
        self.c = [w.astype(np.int64) for w in (np.append(weights[0], trained.sum()), *weights[1:])]

    def questions(self, order: int, seen: np.ndarray | None, bits: int) -> dict:
        """b, k, c, f of a row for each group: its n-grams' hashes in ascending order, counts and first sightings after them."""
        h = self.h[order - 1]
        o = np.argsort(h)
        f = np.zeros(len(h), np.int64) if seen is None else np.bincount(self.context[order], seen, len(h)).astype(np.int64)
        k, c, f = h[o], self.c[order - 1][o], f[o]
        b = (k >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1]))) if len(b) else np.zeros(0, np.int64)
        spans = list(zip(cut.tolist(), [*cut[1:].tolist(), len(b)], strict=False))
        return {"b": pa.array(b[cut]), "k": pa.array([_pack_keys(k[i:j]) for i, j in spans], pa.binary()),
                "c": pa.array([_pack(c[i:j]) for i, j in spans], pa.binary()), "f": pa.array([_pack(f[i:j]) for i, j in spans], pa.binary())}

    def answered(self, order: int, rows: pa.Table, *names: str) -> list[np.ndarray]:
        """The answers of an order, by n-gram index. ``rows``: those of this slice."""
        rows = rows.filter(pc.equal(rows.column("o"), order)).sort_by("b").combine_chunks()
        n, o, out = rows.column("n").to_numpy(), np.argsort(self.h[order - 1]), []
        for name in names:
            x = np.empty(len(o), np.int64)
            x[o] = _unpack(rows.column(name), n)
            out.append(x)
        return out

    def walk(self, c: list[np.ndarray], t: list[np.ndarray], n: int, v: int, d: float) -> np.ndarray:
        """Log10 probability of each token. c, t: counts and distinct successors of words (the start last), pairs and triples."""
        arc = lambda c, of: np.where(c > 0, c - d, 0.0) / np.maximum(of, 1)
        left = lambda c, t: np.where(c > 0, d * t / np.maximum(c, 1), 1.0)
        word, pair, triple = self.of
        p = np.where(c[0] > 0, (c[0] - d) / max(n, 1), d * v / n if n else 1.0)[word]
        p = p * left(c[0], t[0])[self.context[1]][pair] + arc(c[1], c[0][self.context[1]])[pair]
        at = np.flatnonzero(self.inner)
        p[at] = p[at] * left(c[1], t[1])[pair[at - 1]] + arc(c[2], c[1][self.context[2]])[triple]
        return np.log10(np.maximum(p, 1e-300))


def _answers(group: pa.Table) -> pa.Table:
    """sid, b, o, n, c, t, g for each question (sid, b, o, k, c, f) of one group: for every n-gram its count in training, its
    distinct successors, and whether this question is the one that stands for it; sums of the words' counts by the way."""
    group = group.combine_chunks()
    keys = [_unpack_keys(x) for x in group.column("k").to_pylist()]
    n = np.array([len(x) for x in keys])
    c, f, keys = _unpack(group.column("c"), n), _unpack(group.column("f"), n), np.concatenate(keys)
    types, of = np.unique(keys, return_inverse=True)
    total, after = (np.bincount(of, x).astype(np.int64) for x in (c, f))
    trained = np.flatnonzero(c > 0)
    which, at = np.unique(of[trained], return_index=True)
    stands = np.zeros(len(keys), np.int64)
    stands[trained[at]] = 1
    words = total[which][types[which] != START]
    sums = [np.where(np.arange(len(n)) == 0, x, 0) for x in (words.sum(), len(words), (words == 1).sum(), (words == 2).sum())]
    cut = np.concatenate(([0], np.cumsum(n)))
    packed = {a: pa.array([_pack(x[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for a, x in (("c", total[of]), ("t", after[of]), ("g", stands))}
    out = {"sid": group.column("sid"), "b": group.column("b"), "o": group.column("o"), "n": pa.array(n, pa.int64())} | packed
    return pa.table(out | {a: pa.array(x, pa.int64()) for a, x in zip(("n0", "v0", "n1", "n2"), sums, strict=True)})


class Automaton:
    """words: sorted hashes of the broadcast words; ``c``: their counts. State words come first in id order of
    ``state`` (bool). pairs and triples: sorted packed ids with counts."""

    BITS = 21

    def __init__(self, n_tokens: int, n_types: int, discount: float, words: np.ndarray, counts: np.ndarray, n_texts: int):
        self.N, self.V, self.D = n_tokens, n_types, discount
        order = np.argsort(words)
        self.words, self.c = words[order], counts[order].astype(np.float64)
        self.start_id = len(words)
        self.end_id = int(np.searchsorted(self.words, END)) if len(words) else -1
        self.state = np.append(self.c >= max(2, STATE_SHARE * n_tokens), True)  # the start is a context
        self.context = np.append(self.c, float(n_texts))
        self.pairs = self.triples = np.zeros(0, np.int64)
        self.unknown = discount * n_types / n_tokens if n_tokens else 1.0

    def ids(self, t: np.ndarray) -> np.ndarray:
        """Word ids; -1 for words outside the broadcast."""
        if not len(self.words):
            return np.full(len(t), -1, dtype=np.int64)
        i = np.minimum(np.searchsorted(self.words, t), len(self.words) - 1)
        return np.where(self.words[i] == t, i, -1)

    def before(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Id of the word before each token (the start at a text's first)."""
        prev = np.empty_like(ids)
        prev[1:] = ids[:-1]
        prev[first[:-1]] = self.start_id
        return prev

    def pair_keys(self, ids, prev):
        ok = (ids >= 0) & (prev >= 0)
        ok[ok] = self.state[ids[ok]] & self.state[prev[ok]]
        return ok, (prev[ok] << self.BITS) | ids[ok]

    @staticmethod
    def _find(keys: np.ndarray, q: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.full(len(q), -1, dtype=np.int64)
        i = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
        return np.where(keys[i] == q, i, -1)

    def pair_ids(self, ids, prev) -> np.ndarray:
        """Arc taken from the word before to each token, -1 where it fails."""
        out = np.full(len(ids), -1, dtype=np.int64)
        ok, keys = self.pair_keys(ids, prev)
        out[ok] = self._find(self.pairs, keys)
        return out

    def triple_keys(self, pair, ids, first):
        """Keys (pair state before, token): the state carried to each token is the pair that ended before it."""
        state = np.empty_like(pair)
        state[1:] = pair[:-1]
        state[first[:-1]] = -1
        ok = (state >= 0) & (pair >= 0)
        return state, ok, (state[ok] << self.BITS) | ids[ok]

    def add_pairs(self, keys, counts):
        o = np.argsort(keys)
        self.pairs, c = keys[o], counts[o].astype(np.float64)
        ctx = self.pairs >> self.BITS
        self.pair_c = c
        self.pair_arc = (c - self.D) / self.context[ctx]
        self.left1 = 1 - np.bincount(ctx, weights=self.pair_arc, minlength=len(self.context))

    def add_triples(self, keys, counts):
        o = np.argsort(keys)
        self.triples, c = keys[o], counts[o].astype(np.float64)
        ctx = self.triples >> self.BITS
        self.triple_arc = (c - self.D) / self.pair_c[ctx]
        self.left2 = 1 - np.bincount(ctx, weights=self.triple_arc, minlength=len(self.pairs))


def held_out(doc_id, folds: int = 7, fold: int = 2):
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def _arrays(df: DataFrame, *cols: str) -> list[np.ndarray]:
    """Columns of a frame whose number of rows is bounded by a share."""
    t = df.select(*cols).toArrow()
    return [t.column(c).to_numpy() for c in cols]


def _count(texts: DataFrame, keys) -> DataFrame:
    """g, c: keys(part) gives the key array of a slice of texts."""

    def run(batches):
        yield from _counted(keys(part) for b in batches for part in W.slices(b, 0))

    return texts.mapInArrow(run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


class Model:
    """A model of training texts (a column ``text``)."""

    def __init__(self, texts: DataFrame):
        self.texts = texts.select("text")

    @functools.cached_property
    def automaton(self) -> Automaton:
        """An excerpt to look at: the words and n-grams with a share of the training tokens (so that it is small at any size), and
        of these the arcs and the weights left. Scores do not use it; they come from all arcs."""
        texts, spark = self.texts, self.texts.sparkSession
        all_words = checkpoint(_count(texts, lambda part: _tokens(part, 0)[0]))
        n, v, n1, n2 = all_words.agg(F.sum("c"), F.count("*"), F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1))).first()
        n, v = int(n or 0), int(v or 0)
        words, counts = _arrays(all_words.where(F.col("c") >= max(2, WORD_SHARE * n)), "g", "c")
        words = words.view(np.uint64)
        ends = counts[words == END]
        auto = Automaton(n, v, discount(n1, n2), words, counts, int(ends[0]) if len(ends) else 0)
        least = max(2, STATE_SHARE * n)
        if n:
            shared = spark.sparkContext.broadcast(auto)

            def pairs(part):
                t, first, _ = _tokens(part, 0)
                ids = shared.value.ids(t)
                return shared.value.pair_keys(ids, shared.value.before(ids, first))[1]

            auto.add_pairs(*_arrays(_count(texts, pairs).where(F.col("c") >= least), "g", "c"))
            shared2 = spark.sparkContext.broadcast(auto)

            def triples(part):
                t, first, _ = _tokens(part, 0)
                a = shared2.value
                ids = a.ids(t)
                return a.triple_keys(a.pair_ids(ids, a.before(ids, first)), ids, first)[2]

            auto.add_triples(*_arrays(_count(texts, triples).where(F.col("c") >= least), "g", "c"))
        return auto

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
        learns = self.texts.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(True).alias("learns"), F.lit(False).alias("wanted"))
        return _scored(learns.union(docs.select(F.col("doc_id").cast("long"), "text", F.lit(False), F.lit(True))))


def discount(n1: int, n2: int) -> float:
    """Taken off every count, by how many words occur once and twice."""
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5


def _scored(rows: DataFrame) -> DataFrame:
    """The scores of the rows that are ``wanted``, by a model of those that ``learns`` names. ``rows``: doc_id, text, learns, wanted."""
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    size = rows.agg(F.sum(F.octet_length("text") + F.lit(8).cast("long"))).first()[0] or 0
    bits = max(0, -(-int(size) // GROUP) - 1).bit_length()
    # equal rows are one that counts as often; they need not come in the same order again
    sid = F.pmod(F.xxhash64("doc_id", "text", "learns"), F.lit(max(1, -(-int(size) // SLICE))))
    sliced = rows.withColumn("sid", sid).repartition("sid").groupBy("sid", "doc_id", "text", "learns", "wanted").agg(F.count("*").alias("copies"))

    def part(texts: pa.Table) -> Part:
        learns, copies = (texts.column(x).to_numpy() for x in ("learns", "copies"))
        return Part(texts.column("text").combine_chunks(), np.where(learns, copies, 0))

    def asking(order: int):
        def ask(texts: pa.Table, found: pa.Table | None = None) -> pa.Table:
            if not texts.num_rows:
                return pa.table({x: pa.array([], y) for x, y in (("sid", pa.int64()), ("b", pa.int64()), ("o", pa.int32()), *((z, pa.binary()) for z in "kcf"))})
            p = part(texts)
            q = p.questions(order, None if found is None else p.answered(order + 1, found, "g")[0], bits)
            k = len(q["b"])
            return pa.table({"sid": pa.array(np.full(k, texts.column("sid")[0].as_py()), pa.int64()), "b": q.pop("b"), "o": pa.array(np.full(k, order), pa.int32())} | q)

        return ask

    asked, answered = "sid long, b long, o int, k binary, c binary, f binary", "sid long, b long, o int, n long, c binary, t binary, g binary, n0 long, v0 long, n1 long, n2 long"
    found = []
    for order in (3, 2, 1):
        texts = sliced.groupBy("sid")
        ask = texts.cogroup(found[-1].groupBy("sid")).applyInArrow(asking(order), asked) if found else texts.applyInArrow(lambda t: asking(3)(t), asked)
        found.append(checkpoint(ask.groupBy("b").applyInArrow(_answers, answered)))
    n, v, n1, n2 = (int(x or 0) for x in found[-1].agg(*[F.sum(x) for x in ("n0", "v0", "n1", "n2")]).first())
    d = discount(n1, n2)

    def finish(texts: pa.Table, rows: pa.Table) -> pa.Table:
        p = part(texts)
        (c1, t1), (c2, t2), (c3,) = p.answered(1, rows, "c", "t"), p.answered(2, rows, "c", "t"), p.answered(3, rows, "c")
        lp = p.walk([c1, c2, c3], [t1, t2], n, v, d)
        known, base = c1 > 0, np.log10((c1 + 1) / (n + v + 1))
        begin, word = p.first[:-1], p.of[0]
        out = np.repeat(np.arange(texts.num_rows), np.where(texts.column("wanted").to_numpy(), texts.column("copies").to_numpy(), 0))
        add = lambda x: pa.array(np.add.reduceat(x, begin)[out])
        return pa.table({"doc_id": texts.column("doc_id").take(pa.array(out)), "n_tokens": pa.array(p.n[out], pa.int64()),
                         "n_known": add(known[word].astype(np.int64)), "base_score": add(base[word]), "score": add(lp)})

    every = found[0].unionByName(found[1]).unionByName(found[2]).select("sid", "b", "o", "n", "c", "t")
    got = sliced.groupBy("sid").cogroup(every.groupBy("sid")).applyInArrow(finish, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def score_documents(docs: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out and scores them all."""
    return _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (~held_out(F.col("doc_id"))).alias("learns"), F.lit(True).alias("wanted")))
