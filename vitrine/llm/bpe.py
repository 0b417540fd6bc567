"""BPE encoding by dynamic programming over prefixes, and decoding.

For a word of n symbols the greedy merge result is found without merging: an automaton over the vocabulary
gives, for every prefix, the tokens that are its suffixes, and exactly one of them is compatible with the last
token of the prefix before it. That one is stored; following the stored tokens back from the end emits the ids.
Two neighbouring tokens are compatible when no merge across their border comes before the merges that build them.

Cases: null text is empty (no ids); special tokens' strings inside a text become their ids, as in the tokenizers
library; texts of any length are encoded whole; repeated rows keep their own result rows; other columns are kept
(a column that an output column would repeat is replaced); an empty table gives an empty result.

Words repeat, so each Python worker keeps the words it has encoded (a bounded memo that only saves time).
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
#: Words a worker remembers; the memo starts anew when full.
MEMO_WORDS = 700_000
_INF = 1 << 60
_END = "\ue000"
# Unicode White_Space; str.split() also splits at \x1c-\x1f, which are not in it.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def _byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(other)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self._special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self._map = _byte_chars()
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(model["merges"]):
            left, right = vocab[a], vocab[b]
            whole = vocab[a + b]
            self.rank[left, right] = r
            parts.setdefault(whole, (left, right, r))
        self._spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._parts = parts
        self._length: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in vocab.items():
            symbols = t.removesuffix(self.end) if t.endswith(self.end) and t != self.end else t
            key = symbols + _END if symbols is not t else t
            if i in parts or len(symbols) == 1:
                self.automaton.add_word(key, (i, len(key)))
                self._length[i] = len(key)
        self.automaton.make_automaton()
        self._fits: dict[int, bool] = {}
        self._memo: dict[str, tuple[int, str, str]] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(piece, rank of the merge that swallows it) along the token's left (0) or right (1) edge,
        from its outermost symbol to the token itself."""
        got = self._spines.get((token, side))
        if got is None:
            got, limit, t = [], _INF, token
            while True:
                got.append((t, limit))
                if t not in self._parts:
                    break
                left, right, limit = self._parts[t]
                t = (left, right)[side]
            got.reverse()
            self._spines[token, side] = got
        return got

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the symbols of a followed by those of b ends in exactly a, b."""
        key = a << 20 | b
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            known = self._fits[key] = self._no_merge_across(a, b)
        return known

    def _no_merge_across(self, a: int, b: int) -> bool:
        left, right = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            (p, p_next), (q, q_next) = left[i], right[j]
            # the leftmost of equal ranks merges first: p's own merge before the one across, that before q's
            across = self.rank.get((p, q), _INF)
            if across < p_next and across <= q_next and across != _INF:
                return False
            if p_next == _INF and q_next == _INF:
                return True
            if p_next <= q_next:
                i += 1
            else:
                j += 1

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one pre-token (normalised text without white space)."""
        s = "".join([self._map[b] for b in piece.encode("utf-8", "surrogatepass")]) + _END
        n = len(s)
        last = [-1] * (n + 1)
        known = self._fits
        for at, (token, length) in self.automaton.iter(s):
            at += 1
            if last[at] >= 0:
                continue
            if start := at - length:
                if (before := last[start]) < 0:
                    continue
                ok = known.get(before << 20 | token)
                if not (self.fits(before, token) if ok is None else ok):
                    continue
            last[at] = token
        out = []
        while n:
            out.append(last[n])
            n -= self._length[last[n]]
        out.reverse()
        return out

    def _word(self, word: str) -> tuple[int, str, str]:
        low = word.lower() if "Σ" not in word else word.replace("Σ", "σ").lower()
        ids = [t for p in self._pieces.findall(low) for t in self.encode_piece(p)]
        if len(self._memo) >= MEMO_WORDS:
            self._memo.clear()
        got = self._memo[word] = (len(ids), " ".join(map(str, ids)), " ".join([self.tokens[t] for t in ids]))
        return got

    def encode(self, text: str | None) -> tuple[int, str, str]:
        """(number of ids, decimal ids joined by a space, decoded text)."""
        if not text:
            return 0, "", ""
        if self._special_re and "<|" in text and self._special_re.search(text):
            runs = re.split("(" + self._special_re.pattern + ")", text)
        else:
            runs = [text]
        found = []
        memo, word = self._memo, self._word
        for run in runs:
            if run in self.special:
                found.append((1, str(self.special[run]), run))
                continue
            if not run.isascii():
                run = unicodedata.normalize("NFC", run)
            words = run.split() if not _ODD_SPACE.search(run) else [w for w in _SPACE.split(run) if w]
            found += [memo.get(w) or word(w) for w in words]
        found = [x for x in found if x[0]]
        return sum([x[0] for x in found]), " ".join([x[1] for x in found]), " ".join([x[2] for x in found])

    def decode(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids])


@functools.lru_cache(maxsize=4)
def tokenizer(name: str) -> WordBpe:
    """One per worker. ``name``: a file of the public tokenizers package, or a path."""
    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return WordBpe(name)


def _with(df: DataFrame, extra: str, names: list[str]) -> tuple[DataFrame, str]:
    kept = df.select(*[c for c in df.columns if c not in names])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return df, (schema + ", " if schema else "") + extra


def _kept(batch: pa.RecordBatch, names: list[str]) -> dict:
    return {c: batch.column(c) for c in batch.schema.names if c not in names}


def bpe_encode(df: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """All columns and ids array<int>."""
    _, schema = _with(df, "ids array<int>", ["ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(vocabulary)
        for b in batches:
            ids = [[int(i) for i in bpe.encode(t)[1].split()] for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_pydict(_kept(b, ["ids"]) | {"ids": pa.array(ids, pa.list_(pa.int32()))})

    return df.mapInArrow(run, schema)


def bpe_decode(df: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns and decoded, from ids."""
    _, schema = _with(df, "decoded string", ["decoded"])

    def run(batches):
        bpe = tokenizer(vocabulary)
        for b in batches:
            out = [bpe.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict(_kept(b, ["decoded"]) | {"decoded": pa.array(out, pa.string())})

    return df.mapInArrow(run, schema)


def bpe_digests(df: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256: the same encoder and
    decoder, with only digests leaving the task."""

    def run(batches):
        bpe = tokenizer(vocabulary)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for b in batches:
            got = [bpe.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "n_tokens": pa.array([g[0] for g in got], pa.int64()),
                "ids_sha256": pa.array([sha(g[1]) for g in got], pa.string()),
                "decoded_sha256": pa.array([sha(g[2]) for g in got], pa.string())})

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
