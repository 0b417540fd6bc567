"""Language identification by words first, backing off to shorter and shorter character n-grams.

A text is cut into words (runs of letters, lower-cased). A word that the training texts hold scores, in each language, its
log10 relative frequency there (a fixed penalty in a language that lacks it). For another word the character n-grams of the
word between blanks are looked up, the longest first: of the first length of which any is known, the known ones' log
frequencies are averaged. A word of which not even a character is known says nothing. A text's score in a language is the
mean over its words; the best language wins (ties: by code point).

Fitting reads a bounded sample: of each language about ``SAMPLE`` training texts, chosen by a hash of (doc_id, text). Units
(words and n-grams) that occur ``FLOOR`` times or more are counted in Spark; the ``UNITS`` most frequent ones, a bound that
a sample of ordinary texts doesn't reach, are what the driver holds and broadcasts. Scoring is one pass without a shuffle.

Cases: null texts and texts without a letter are ``und`` with score 0; texts whose words all are unknown, down to the
characters, get the language with the most training texts; without any training text all are ``und``. Rows with a null
doc_id are neither held out nor learnt from. Repeated rows are rows; texts of any length are read whole; an empty table
gives an empty result; columns other than doc_id, text and (for fitting) lang are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm import words as W

SAMPLE, FLOOR, UNITS = 2500, 2, 600_000
LONGEST = 5
#: Minus log10 of the frequency that a unit counts with in a language that lacks it.
PENALTY = 7.0
FOLDS, FOLD = 5, 0
_MARK = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def letter_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, start, end, row): the code points of the lower-cased texts, and each word's range and text."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join(low).encode("utf-32-le"), dtype=np.uint32)
    letter = np.concatenate(([False], _letters()[codes], [False]))
    start, end = np.flatnonzero(letter[1:] & ~letter[:-1]), np.flatnonzero(letter[:-1] & ~letter[1:])
    ends = np.cumsum([len(t) + 1 for t in low])
    return codes, start, end, np.searchsorted(ends, start, side="right")


def _within(length: np.ndarray) -> np.ndarray:
    """0 .. length - 1 for each length, one after the other."""
    first = np.cumsum(length) - length
    return np.arange(length.sum()) - np.repeat(first, length)


def word_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a sum over mixed (character, place) pairs, mixed again with the length."""
    size = end - start
    if not len(size):
        return np.zeros(0, np.uint64)
    place = _within(size)
    at = np.repeat(start, size) + place
    with np.errstate(over="ignore"):
        x = W.mix(codes[at].astype(np.uint64) + ((place.astype(np.uint64) + np.uint64(1)) << np.uint64(32)))
        return W.mix(np.add.reduceat(x, np.cumsum(size) - size) + size.astype(np.uint64) * _MARK)


def gram_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word) of every run of n characters in every word between blanks (a blank alone excluded)."""
    size = end - start + 2
    if not len(size):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place, word = _within(size), np.repeat(np.arange(len(size)), size)
    inner = (place > 0) & (place < size[word] - 1)
    chars = np.full(len(place), 32, dtype=np.uint64)
    chars[inner] = codes[np.repeat(start - 1, size)[inner] + place[inner]]
    h = W.ngrams(W.mix(chars + np.uint64(1)), n)
    full = (place + n <= size[word])[: len(h)]
    if n == 1:
        full &= inner
    with np.errstate(over="ignore"):
        return W.mix(h[full] + np.uint64(n)), word[: len(h)][full]


class LanguageModel:
    """Minus log10 frequency of each unit (by hash) in each language."""

    def __init__(self, langs: list[str], texts: list[int], hashes: np.ndarray, counts: np.ndarray, totals: np.ndarray):
        """``counts``: units by languages; ``totals``: kinds (words, then n-grams by n) by languages; ``hashes`` are sorted."""
        self.langs, self.hashes = langs, hashes
        self.prior = int(np.argmax(texts)) if langs else -1
        kind = counts[:, -1].astype(np.int64) if len(counts) else np.zeros(0, np.int64)
        with np.errstate(divide="ignore"):
            cost = -np.log10(counts[:, :-1] / np.maximum(totals[kind], 1)) if len(counts) else np.zeros((0, len(langs)))
        self.cost = np.minimum(cost, PENALTY).astype(np.float32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where unknown."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)

    def word_costs(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Costs of words by language; nan for words that say nothing."""
        at = self.find(word_hashes(codes, start, end))
        out = np.full((len(start), len(self.langs)), np.nan)
        out[at >= 0] = self.cost[at[at >= 0]]
        left = np.flatnonzero(at < 0)
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            h, word = gram_hashes(codes, start[left], end[left], n)
            at = self.find(h)
            word, at = word[at >= 0], at[at >= 0]
            times = np.bincount(word, minlength=len(left))
            hit = times > 0
            for k in range(len(self.langs)):
                total = np.bincount(word, self.cost[at, k], minlength=len(left))
                out[left[hit], k] = total[hit] / times[hit]
            left = left[~hit]
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        codes, start, end, row = letter_words(texts)
        has = np.bincount(row, minlength=len(texts)) > 0
        if self.prior < 0:
            return ["und"] * len(texts), np.zeros(len(texts))
        # each distinct word is scored once
        _, first, which = np.unique(word_hashes(codes, start, end), return_index=True, return_inverse=True)
        cost = self.word_costs(codes, start[first], end[first])[which]
        known = ~np.isnan(cost[:, 0]) if len(cost) else np.zeros(0, bool)
        n = np.bincount(row[known], minlength=len(texts))
        mean = np.stack([np.bincount(row[known], cost[known, k], minlength=len(texts)) for k in range(len(self.langs))], axis=1) / np.maximum(n, 1)[:, None]
        mean[n == 0] = 0
        mean[n == 0, self.prior] = -1e-9
        best = np.argmin(mean, axis=1)
        score = 1 / (10.0 ** (mean.min(axis=1)[:, None] - mean)).sum(axis=1)
        return [self.langs[b] if h else "und" for b, h in zip(best, has, strict=True)], np.where(has, score, 0.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == FOLD, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    """lang, text, h of the rows that may be learnt from (h: what the sample is chosen by)."""
    ok = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    return docs.where(ok).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))


def unit_counts(sample: DataFrame, langs: list[str]) -> DataFrame:
    """unit, kind (0: word, n: n-gram), c0, c1, ...: counts by language, added up within tasks first."""
    code = {x: i for i, x in enumerate(langs)}

    def run(batches):
        for b in batches:
            for part in W.slices(b, "text", 1 << 20):
                lang = np.array([code[x] for x in part.column("lang").to_pylist()])
                codes, start, end, row = letter_words(part.column("text").to_pylist())
                _, first, which = np.unique(word_hashes(codes, start, end), return_index=True, return_inverse=True)
                by = np.zeros((len(first), len(langs)), dtype=np.int64)
                np.add.at(by, (which, lang[row]), 1)
                start, end = start[first], end[first]
                for n in range(LONGEST + 1):
                    h, word = gram_hashes(codes, start, end, n) if n else (word_hashes(codes, start, end), np.arange(len(start)))
                    u, which = np.unique(h, return_inverse=True)
                    c = np.zeros((len(u), len(langs)), dtype=np.int64)
                    np.add.at(c, which, by[word])
                    yield pa.RecordBatch.from_pydict({"unit": pa.array(u.view(np.int64)), "kind": pa.array(np.full(len(u), n, np.int32))} | {
                        f"c{k}": pa.array(c[:, k]) for k in range(len(langs))})

    cols = [f"c{k}" for k in range(len(langs))]
    parts = sample.select("lang", "text").mapInArrow(run, "unit long, kind int, " + ", ".join(f"{c} long" for c in cols))
    return parts.groupBy("unit", "kind").agg(*[F.sum(c).alias(c) for c in cols])


def fit(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """The model of a bounded sample of the training rows of ``docs`` (doc_id, text, lang)."""
    rows = training_rows(docs)
    texts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(texts)
    if not langs:
        return LanguageModel([], [], np.zeros(0, np.uint64), np.zeros((0, 1)), np.zeros((0, 0)))
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample / texts[lang]))])
    chosen = rows.where((F.col("h").cast("double") / F.lit(2.0**64) + 0.5) <= share[F.col("lang")])
    counts = unit_counts(chosen, langs).persist()
    try:
        cols = [f"c{k}" for k in range(len(langs))]
        sums = {r["kind"]: [r[c] for c in cols] for r in counts.groupBy("kind").agg(*[F.sum(c).alias(c) for c in cols]).collect()}
        total = sum((F.col(c) for c in cols), F.lit(0))
        kept = counts.where(total >= FLOOR)
        if kept.count() > UNITS:
            kept = kept.orderBy(total.desc(), "unit").limit(UNITS)
        got = kept.toArrow()
    finally:
        counts.unpersist()
    h = got.column("unit").to_numpy().view(np.uint64)
    order = np.argsort(h)
    table = np.stack([got.column(c).to_numpy() for c in [*cols, "kind"]], axis=1)[order]
    totals = np.array([sums.get(k, [0] * len(langs)) for k in range(LONGEST + 1)], dtype=float)
    return LanguageModel(langs, [texts[x] for x in langs], h[order], table.astype(float), totals)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for part in W.slices(b, "text", 1 << 20):
                lang, score = shared.value.predict([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                                                  "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
