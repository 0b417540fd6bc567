"""The language model against a plain-Python one that holds every n-gram."""

import collections
import math
import zlib

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """Log10 probability of each row's text by a model of the rows that are not held out."""
    texts = [("".join(" " if ch in "\t\n\v\f\r" else ch for ch in (t or "")).translate(LOW).split(" "), i) for i, t in rows]
    texts = [([None, *filter(None, t), "\0"], i is not None and zlib.crc32(str(i).encode()) % 7 == 2) for t, i in texts]
    c, after = collections.Counter(), collections.defaultdict(set)
    for t, out in texts:
        if not out:
            c[(None,)] += 1
            for i in range(1, len(t)):
                for h in ((), (t[i - 1],), tuple(t[i - 2 : i])) if i > 1 else ((), (t[i - 1],)):
                    c[(*h, t[i])] += 1
                    after[h].add(t[i])
    words = {g[0]: k for g, k in c.items() if len(g) == 1 and g[0] is not None}
    n, v = sum(words.values()), len(words)
    n1, n2 = (sum(k == j for k in words.values()) for j in (1, 2))
    d = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5

    def p(h, w):
        if not h:
            return (words[w] - d) / n if w in words else d * v / n
        if not c[h]:
            return p(h[1:], w)
        return max(c[(*h, w)] - d, 0) / c[h] + d * len(after[h]) / c[h] * p(h[1:], w)

    return [sum(math.log10(p(tuple(t[max(0, i - 2) : i]), t[i])) for i in range(1, len(t))) for t, _ in texts]


def test_scores_come_from_every_ngram_however_rare(docs, monkeypatch):
    from vitrine.llm import lm

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted((str(i), round(s, 6)) for (i, _), s in zip(rows, brute(rows), strict=True))
    got = lambda: sorted((str(r["doc_id"]), round(r["score"], 6)) for r in lm.score_documents(docs).collect())
    assert got() == want
    monkeypatch.setattr(lm, "SLICE", 5000)
    monkeypatch.setattr(lm, "GROUP", 5000)  # many slices and groups: the same
    assert got() == want


def test_a_model_scores_other_documents(sp):
    from vitrine.llm.lm import Model

    train, new = [(None, "a b c"), (None, "a b c"), (None, "b c d")], [(16, "A b c"), (16, "A b c"), (None, "x b c e"), (5, None)]
    frame = lambda rows: sp.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), round(r["score"], 9), r["n_known"], r["train_tokens"]) for r in Model(frame(train)).score(frame(new)).collect())
    held = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 7 == 2)
    s = brute([*train, *[(held, t) for _, t in new]])[3:]
    assert got == sorted((str(i), round(x, 9), k, 12) for (i, _), x, k in zip(new, s, (4, 4, 3, 1), strict=True))
    assert [r["score"] for r in Model(frame([])).score(frame(new)).collect()] == [0.0] * 4
