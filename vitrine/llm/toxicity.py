"""Toxicity by weak supervision.

Many voters look at a text: words and word stems of a lexicon (a fixed seed, and entries found by how much more often
they occur in texts labelled toxic), and patterns over them (how many hits, how many different ones, how dense, none in a
long text). A generative label model learns from the votes of a bounded sample how often each voter fires on
toxic and on clean texts; voters that still agree given the class share one vote (estimated correlations). Labels
take part as one more voter, on training rows only. A linear classifier over the votes and hit densities is
fitted to the posterior labels and scores every text.

Cases: null text is empty and scored as such; repeated label rows of a document count as toxic if any is; null labels and
null doc_ids are not learned from; without any label the seed lexicon votes alone; an empty table gives an empty
result; other columns are ignored; texts are read whole.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import words as W

#: Labelled training documents the models are fitted on, in hash order: the bound on what the driver reads.
SAMPLE_ROWS = 6_000
SEED_LEXICON = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "imbecile", "dumbass")
#: Lexicon entries found by label, the least of them per class size, and stem lengths tried.
MINED, MIN_SHARE, STEMS = 120, 0.004, (4, 5, 6, 7)
#: An entry marks a text when it makes up one word in so many, so that a stray hit in a long text says nothing.
EVERY = 150
_WORD = re.compile(r"[^\W\d_]+")
DENSITY = (0.3, 0.6, 1.2, 2.5)
DISTINCT = (1, 2, 3, 5)


def held_out(doc_id, folds: int = 5, fold: int = 0):
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def _entries(text: str) -> set[str]:
    """Words, and stems marked by a star, that occur at least once in EVERY words."""
    count = Counter(_WORD.findall(text.lower()))
    least = sum(count.values()) / EVERY
    stems: Counter = Counter()
    for w, c in count.items():
        for k in STEMS:
            if len(w) >= k:
                stems[w[:k] + "*"] += c
    return {w for c in (count, stems) for w, n in c.items() if n >= least}


def _copies(entries: list[set[str]]) -> list[bool]:
    """Whether a text shares two of its four minhashes with one before it."""
    seen: set[tuple] = set()
    out = []
    for es in entries:
        if not es:
            out.append(bool(out))
            continue
        h = W.mix(np.array([zlib.crc32(e.encode()) for e in es], dtype=np.uint64)[None, :] + np.arange(1, 5, dtype=np.uint64)[:, None] * np.uint64(1 << 40))
        low = h.min(axis=1).tolist()
        keys = {(i, low[i], j, low[j]) for i in range(4) for j in range(i)}
        out.append(bool(keys & seen))
        seen |= keys
    return out


def mine_lexicon(texts: list[str], toxic: np.ndarray, size: int = MINED) -> list[str]:
    """Entries that mark toxic texts, best first; a stem stands for the words under it. Copies of a text count
    once, and an entry must stand out by more than chance gives the best of all entries tried."""
    entries = [_entries(t) for t in texts]
    single = ~np.array(_copies(entries), dtype=bool)
    n1, n0 = int((toxic & single).sum()), int((~toxic & single).sum())
    if not n1 or not n0:
        return []
    df: tuple[Counter, Counter] = (Counter(), Counter())
    for es, y, one in zip(entries, toxic.tolist(), single.tolist(), strict=True):
        if one:
            df[y].update(es)
    least = max(3, MIN_SHARE * n1)
    tried = {e: c for e, c in df[1].items() if c >= least}
    share = n1 / (n1 + n0)
    score = {}
    for e, c in tried.items():
        d = df[0][e]
        gain = c * math.log(c / ((c + d) * share)) + (d * math.log(d / ((c + d) * (1 - share))) if d else 0.0)
        odds = math.log((c + 0.5) / (n1 + 1)) - math.log((d + 0.5) / (n0 + 1))
        if d <= 0.3 * c and gain > math.log(10 * len(df[1])):
            # hits gained count more than purity, shorter stems less than the words they repeat
            score[e] = odds * math.sqrt(c)
    out: list[str] = []
    for e in sorted(score, key=lambda e: (-score[e], e)):
        word = e.rstrip("*")
        if not any(o.endswith("*") and word.startswith(o[:-1]) for o in out):
            out.append(e)
        if len(out) == size:
            break
    return out


class Voters:
    def __init__(self, lexicon: list[str]):
        self.lexicon = list(dict.fromkeys(lexicon))

    @functools.cached_property
    def _automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for i, e in enumerate(self.lexicon):
            w = e.rstrip("*")
            a.add_word(w, (i, len(w), e.endswith("*")))
        a.make_automaton()
        return a

    def __getstate__(self):
        return {"lexicon": self.lexicon}

    def hits(self, text: str) -> dict[int, int]:
        """Lexicon entry -> occurrences at word starts."""
        low, found = text.lower(), {}
        last = len(low) - 1
        for end, (i, n, stem) in self._automaton.iter(low):
            s = end - n
            if (s < 0 or not low[s].isalpha()) and (stem or end == last or not low[end + 1].isalpha()):
                found[i] = found.get(i, 0) + 1
        return found

    def names(self) -> list[str]:
        return ([f"lexicon:{e}" for e in self.lexicon] + [f"density>={d}" for d in DENSITY] + [f"distinct>={d}" for d in DISTINCT]
                + ["none in a long text", "shouting", "few in a long text"])

    def votes(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(which voters fire, the classifier's real-valued features)."""
        hit = self.hits(text) if self.lexicon else {}
        n = len(text.split())
        total, distinct = sum(hit.values()), len(hit)
        density = 100.0 * total / max(n, 20)
        v = np.zeros(len(self.lexicon) + len(DENSITY) + len(DISTINCT) + 3, dtype=np.float32)
        v[[i for i, c in hit.items() if c * EVERY >= n]] = 1
        k = len(self.lexicon)
        v[k : k + 4] = [density >= d for d in DENSITY]
        v[k + 4 : k + 8] = [distinct >= d for d in DISTINCT]
        v[k + 8 :] = [not total and n >= 30, sum(map(text.count, ("!!!", "!?"))) > 2, total <= 1 and n >= 200]
        return v, np.array([density, math.log1p(total), math.log1p(distinct), math.sqrt(density), float(total == 0)])


class LabelModel:
    """P(voter fires | class) and the class share by EM, with voters' weights lowered by their conditional correlation."""

    def fit(self, votes: np.ndarray, labels: np.ndarray, rounds: int = 30, trust: float = 0.995):
        """``labels``: 1, 0 or -1 (none)."""
        n, m = votes.shape
        gold = np.where(labels < 0, 0.0, np.where(labels == 1, 1, -1) * math.log(trust / (1 - trust)))
        post = np.where(labels >= 0, np.where(labels == 1, trust, 1 - trust), np.clip(votes[:, :-3].mean(1) * 4, 0.05, 0.95))
        self.weight = np.ones(m)
        for i in range(rounds):
            self.share = float(np.clip(post.mean(), 1e-3, 1 - 1e-3))
            self.p1 = (votes.T @ post + 0.5) / (post.sum() + 1)
            self.p0 = (votes.T @ (1 - post) + 0.5) / ((1 - post).sum() + 1)
            if i in (3, 10):
                self.weight = 1 / self._agreeing(votes, post)
            post = 1 / (1 + np.exp(-np.clip(self.log_odds(votes) + gold, -30, 30)))
        self.posterior = post
        return self

    def _agreeing(self, votes, post) -> np.ndarray:
        """1 + the sum of squared correlations of each voter with the others, within the classes."""
        total = np.zeros((votes.shape[1],) * 2)
        for w in (post, 1 - post):
            mean = (votes * w[:, None]).sum(0) / max(w.sum(), 1e-9)
            x = (votes - mean) * np.sqrt(w)[:, None]
            total += x.T @ x
        sd = np.sqrt(np.maximum(np.diag(total), 1e-9))
        self.correlation = total / sd[:, None] / sd[None, :]
        c = np.clip(self.correlation, -1, 1) ** 2
        np.fill_diagonal(c, 0)
        return 1 + c.sum(1)

    def log_odds(self, votes):
        fire = np.log(self.p1 / self.p0) * self.weight
        rest = np.log((1 - self.p1) / (1 - self.p0)) * self.weight
        return math.log(self.share / (1 - self.share)) + votes @ fire + (1 - votes) @ rest


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.full(x1.shape[1], penalty * len(x))
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        g = x1.T @ (p - y) + ridge * w
        h = (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


class ToxicityModel:
    def __init__(self, texts: list[str], labels: np.ndarray, seed_lexicon=SEED_LEXICON):
        toxic = labels == 1
        known = labels >= 0
        mined = mine_lexicon([t for t, k in zip(texts, known, strict=True) if k], toxic[known])
        self.voters = Voters([*seed_lexicon, *mined])
        got = [self.voters.votes(t) for t in texts]
        k = len(self.voters.lexicon)
        if got and known.any() and toxic.any() and not toxic[known].all():
            votes, dense = np.array([g[0] for g in got], dtype=float), np.array([g[1] for g in got])
            self.label_model = LabelModel().fit(votes, labels)
            y = self.label_model.posterior
            self.mean, self.scale = dense.mean(0), dense.std(0) + 1e-9
            x = np.hstack([votes, (dense - self.mean) / self.scale])
            self.w, self.b = fit_linear(x, y)
        else:  # nothing to learn from: the seed lexicon's density decides
            self.mean, self.scale = np.zeros(5), np.ones(5)
            self.w = np.zeros(k + 11 + 5)
            self.w[-5], self.b = 4.0, -2.5
        self.used = np.flatnonzero(np.abs(self.w) > 0)

    def score(self, text: str | None) -> float:
        v, dense = self.voters.votes(text or "")
        z = float(np.dot(self.w[: len(v)], v) + np.dot(self.w[len(v) :], (dense - self.mean) / self.scale) + self.b)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fitted on a bounded sample of labelled training rows (held-out rows never)."""
    train = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    train = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` rows, so broadcast
    sample = docs.select("doc_id", "text").join(F.broadcast(train), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).collect()
    return ToxicityModel([r["text"] or "" for r in sample], np.array([int(r["toxic"] == 1) for r in sample]))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in (part for b in batches for part in W.slices(b, 2)):
            s = [m.score(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "held_out": b.column(1), "score": pa.array(s, pa.float64()),
                                              "predicted": pa.array([int(x >= 0.5) for x in s], pa.int32())})

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        m = shared.value
        for b in batches:
            for part in W.slices(b, at):
                yield part.filter(pa.array([m.score(t) < 0.5 for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
