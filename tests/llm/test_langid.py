"""Language identification against a plain version, and held-out accuracy."""

import collections
import math
import zlib

import pytest

from vitrine.llm import langid as L

SCHEMA = "doc_id long, text string, lang string, source string, kind string, unit string, h string"
SYLLABLES = {"aa": "ka lo mi ren sta".split(), "bb": "ço dué lhá pre ñu".split(), "cc": "öz thü kä mi lo".split(), "дд": "бра кни лет мо ся".split()}


def corpus():
    import random

    r, rows = random.Random(8), []
    for i in range(400):
        lang = sorted(SYLLABLES)[i % 4]
        text = " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(4, 30))).capitalize() + ". 12"
        rows.append((i, text, lang))
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 —。!", "cc"), (1003, "KALOMI kalomi " * 30_000, "aa"), (None, "öz öz thü", "cc"),
             (1004, "öz kä", None), (1005, "漢字", None), rows[7], rows[7]]
    return rows


def plain(rows):
    """The model by dictionaries and string slices."""
    words = lambda t: "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    train = [(t, g) for i, t, g in rows if i is not None and t is not None and g is not None and not out(i)]
    langs = sorted({g for _, g in train})
    counts = [collections.defaultdict(lambda: [0] * len(langs)) for _ in range(L.LONGEST + 1)]

    def grams(w, n):
        w = " " + w + " "
        return [w[i : i + n] for i in range(len(w) - n + 1) if w[i : i + n] != " "]

    for t, g in train:
        for w in words(t):
            counts[0][w][langs.index(g)] += 1
            for n in range(1, L.LONGEST + 1):
                for x in grams(w, n):
                    counts[n][x][langs.index(g)] += 1
    total = [[sum(c[k] for c in counts[n].values()) for k in range(len(langs))] for n in range(L.LONGEST + 1)]
    cost = [{x: [min(L.PENALTY, -math.log10(c[k] / total[n][k])) if c[k] else L.PENALTY for k in range(len(langs))]
             for x, c in counts[n].items() if sum(c) >= L.FLOOR} for n in range(L.LONGEST + 1)]
    prior = max(range(len(langs)), key=lambda k: (sum(g == langs[k] for _, g in train), -k))
    got = []
    for i, t, _ in rows:
        ws, known = words(t), []
        for w in ws:
            if w in cost[0]:
                known.append(cost[0][w])
                continue
            for n in range(L.LONGEST, 0, -1):
                hit = [cost[n][x] for x in grams(w, n) if x in cost[n]]
                if hit:
                    known.append([sum(h[k] for h in hit) / len(hit) for k in range(len(langs))])
                    break
        if not ws:
            got.append((i, out(i), "und", 0.0))
            continue
        mean = [sum(c[k] for c in known) / len(known) for k in range(len(langs))] if known else [-1e-9 * (k == prior) for k in range(len(langs))]
        best = min(range(len(langs)), key=lambda k: mean[k])
        got.append((i, out(i), langs[best], 1 / sum(10 ** (mean[best] - m) for m in mean)))
    return got


@pytest.fixture(scope="module")
def docs(sp):
    return sp.createDataFrame([(i, t, g, "s", "x", "y", "z") for i, t, g in corpus()], SCHEMA).repartition(5)


def test_equals_the_plain_version(docs):
    key = lambda r: (str(r[0]), r[1], r[2], round(r[3], 4))
    got = sorted(key(tuple(r)) for r in L.identify(docs, L.fit(docs)).collect())
    assert got == sorted(map(key, plain(corpus())))


def test_held_out_accuracy(docs):
    want = {i: g for i, t, g in corpus() if t and any(c.isalpha() for c in t)}
    got = [r for r in L.identify(docs, L.fit(docs)).collect() if r.held_out and want.get(r.doc_id)]
    assert len(got) > 40 and sum(r.lang_pred == want[r.doc_id] for r in got) >= 0.97 * len(got)


def test_sample_is_bounded_and_stable(docs):
    a, b = L.fit(docs, 20), L.fit(docs.repartition(3), 20)
    assert len(a.hashes) < len(L.fit(docs).hashes) and (a.hashes == b.hashes).all() and (a.cost == b.cost).all()


def test_nothing_to_learn_from(sp, docs):
    none = L.fit(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in L.identify(docs, none).collect()} == {("und", 0.0)}
    assert L.identify(docs.limit(0), none).collect() == []
