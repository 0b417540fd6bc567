"""Vectorised word and n-gram hashing over whole Arrow batches of texts.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lowered; since those
bytes never occur inside a longer UTF-8 sequence, byte-wise work equals character-wise work. A
word's 64-bit hash is a polynomial over its bytes (prefix sums times inverse powers, modulo 2^64)
passed through a mixer, so a batch costs a few numpy passes and no Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes hashed in one go: bounds the scratch arrays (8 bytes each) whatever the text lengths.
BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (a bijection on 64-bit values)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: For words without punctuation: every ASCII byte that is neither letter nor digit separates.
_OTHER = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BYTE_LOWER = _BYTE[_LOWER]
_POW: dict[str, np.ndarray] = {}


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POW or len(_POW["p"]) < n:
        m = max(n, 1 << 16)
        _POW["p"], _POW["i"] = _powers(_P, m), _powers(_PINV, m)
    return _POW["p"], _POW["i"]


def _span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """Hash of buf[start:end] for sorted, disjoint spans; blocks bound the scratch memory."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(start):
            lo = int(start[i])
            j = max(i + 1, int(np.searchsorted(end, lo + BLOCK, side="right")))
            hi = int(end[j - 1])
            pw, inv = _pow_tables(hi - lo + 1)
            c = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum((_BYTE_LOWER if lower else _BYTE)[buf[lo:hi]] * pw[: hi - lo], out=c[1:])
            s, e = start[i:j] - lo, end[i:j] - lo
            out[i:j] = mix((c[e] - c[s]) * inv[s] + (e - s).astype(np.uint64))
            i = j
    return out


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without copying, and the texts' offsets (n + 1 values; null is empty)."""
    if col.null_count:
        col = pc.fill_null(col, "")
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text_col: int | str = "text", max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batch with about ``max_bytes`` of text each (one row at least): bounds scratch memory."""
    if not batch.num_rows:
        return
    _, off = utf8(batch.column(text_col))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def word_spans(buf: np.ndarray, off: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words; texts are cut at ``off``."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~between[buf]
    cut = np.zeros(len(buf) + 1, dtype=bool)
    cut[off] = True
    joined = np.zeros(len(buf) + 1, dtype=bool)  # a word goes on across the position before byte i
    joined[1:-1] = word[:-1] & word[1:] & ~cut[1:-1]
    return np.flatnonzero(word & ~joined[:-1]), np.flatnonzero(word & ~joined[1:]) + 1


class Words:
    """Words of a string column: hashes ``h``, byte spans ``s`` and ``e`` in ``buf``, and ``first``, the index of
    each text's first word (n + 1 values). ``lower``: A-Z count as a-z; ``plain``: words end at punctuation too."""

    def __init__(self, col: pa.Array, lower: bool = True, plain: bool = False):
        self.buf, self.off = utf8(col)
        self.s, self.e = word_spans(self.buf, self.off, _OTHER if plain else _SPACE)
        self.h = _span_hashes(self.buf, self.s, self.e, lower)
        self.first = np.searchsorted(self.s, self.off)
        self.n = np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.n)), self.n)


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of h[i:i+n] for each i (len(h) - n + 1 values)."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(h) - n + 1, dtype=np.uint64)
        for k in range(n):
            out = mix(out + h[k : len(h) - n + 1 + k] + np.uint64(k + 1))
    return out


def sequence_hash(h: np.ndarray) -> np.uint64:
    """Order-dependent hash of a whole short sequence of hashes."""
    x = np.zeros(1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for v in h:
            x = mix(x + v + np.uint64(0x51ED270B))
    return x[0]


def hash_words(words: list[str]) -> np.ndarray:
    """The hashes these (lower-case) words have in texts."""
    return np.array([Words(pa.array([w]), lower=False).h[0] for w in words], dtype=np.uint64)


def distinct_sorted(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def shingle_sets(col: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct n-word shingle hashes (the whole sequence as one when it
    has 1 to n - 1 words; empty without words)."""
    w = Words(col)
    g = ngrams(w.h, n)
    for i in range(len(w.n)):
        a, b = int(w.first[i]), int(w.first[i + 1])
        if b - a >= n:
            yield distinct_sorted(g[a : b - n + 1])
        elif b > a:
            yield np.array([sequence_hash(w.h[a:b])], dtype=np.uint64)
        else:
            yield np.zeros(0, dtype=np.uint64)


def run_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Order-dependent hash of each run h[start:end] of word hashes."""
    with np.errstate(over="ignore"):
        pw, inv = _pow_tables(len(h) + 1)
        c = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(mix(h) * pw[: len(h)], out=c[1:])
        return mix((c[end] - c[start]) * inv[start] + (end - start).astype(np.uint64))


def parities(sets: list[np.ndarray]) -> pa.ListArray:
    """For each set, 256 parities: how many of its hashes end in each byte, modulo 2, as four longs. The number of
    parities in which two sets differ is at most the size of their symmetric difference."""
    if not sets:
        return pa.array([], pa.list_(pa.int64()))
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    flat = np.concatenate(sets)
    odd = np.bincount(row * 256 + (flat & np.uint64(255)).astype(np.int64), minlength=256 * len(sets)) & 1
    bits = np.packbits(odd.astype(bool).reshape(len(sets), 256), axis=1).view(np.int64).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, 4 * len(sets) + 1, 4), pa.int32()), pa.array(bits))
