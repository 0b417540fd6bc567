"""Each operator against a brute-force version, and its edge cases."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def toks(t):
    return WORD.findall((t or "").translate(LOW))


def shingles(t, n):
    w = toks(t)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_ngram_join_equals_all_pairs(docs, n, percent):
    from vitrine.llm.ngram_join import jaccard_components

    d = docs.collect()
    sets = [shingles(r.text, n) for r in d]
    par = list(range(len(d)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                par[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, r in enumerate(d):
        ids[find(i)].append(r.doc_id)
    smallest = lambda i: min((x for x in ids[find(i)] if x is not None), default=None)
    want = sorted((str(r.doc_id), len(sets[i]), str(smallest(i))) for i, r in enumerate(d))
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows(jaccard_components(docs, n, percent)))
    assert got == want


def test_near_duplicates_with_null_and_repeated_ids(sp):
    import corpus_pipeline
    from .conftest import words

    def near(seed, word):
        return words(100, seed) + " " + word

    data = [(None, words(60, 300)), (None, near(301, "x")), (None, near(301, "y")), (None, near(302, "x")), (5, near(302, "y")),
            (6, near(303, "x")), (7, near(303, "y")), (7, words(60, 304)), (7, words(60, 304)), (1, near(305, "x")), (9, near(305, "y")),
            (9, near(306, "x")), (10, near(306, "y")), (None, ""), (None, ""), (8, None)]
    out = corpus_pipeline.near_duplicate_stage(sp, sp.createDataFrame(data, "doc_id long, text string"), "")
    got = [(r["doc_id"], r["text"]) for r in rows(out)]
    fixed = [(None, words(60, 300)), (5, near(302, "y")), (6, near(303, "x")), (7, words(60, 304)), (1, near(305, "x")),
             (9, near(306, "x")), (None, ""), (None, ""), (8, None)]
    rest = list(got)
    for x in fixed:
        rest.remove(x)
    assert len(rest) == 1 and rest[0] in [(None, near(301, "x")), (None, near(301, "y"))]


def test_components_of_chains_and_stars(sp):
    from vitrine.llm.graph import components

    edges = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(200, 260)] + [(999, i) for i in range(900, 999)] + [(5, 5), (None, 3), (7, 200)]
    got = collections.defaultdict(set)
    for r in components(sp.createDataFrame(edges, "a long, b long")).collect():
        got[r.comp].add(r.node)
    assert sorted(map(sorted, got.values())) == sorted([list(range(100, 181)), [7, *range(200, 260)], list(range(900, 1000))])
    assert components(sp.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("order", ["rising", "falling", "shuffled"])
def test_components_of_a_long_chain(sp, order):
    import random

    from vitrine.llm.graph import components

    n = 10_000
    at = list(range(n)) if order != "shuffled" else random.Random(3).sample(range(n), n)
    edges = [(at[i], at[i + 1]) for i in range(n - 1)]
    edges = edges[::-1] if order == "falling" else edges
    got = components(sp.createDataFrame(edges, "a long, b long").repartition(4))
    assert (got.count(), got.select("comp").distinct().count()) == (n, 1)


def test_substring_dedup_removes_the_passage_but_in_one_document(docs):
    from vitrine.llm.substring import duplicate_spans, remove_spans
    from .conftest import words

    passage = words(60, 99) + "."
    spans = duplicate_spans(docs)
    out = {r["doc_id"]: r for r in rows(remove_spans(docs, spans))}
    assert passage in out[11]["text"] and passage not in out[12]["text"] and out[12]["text"].endswith("\nend")
    assert words(60, 99)[:40] not in out[13]["text"]
    assert out[10]["text"] == words(20000, 10) and out[4]["text"] is None and out[2]["text"] == ""
    assert {r["doc_id"] for r in rows(spans)}.isdisjoint({1, 10, 11, 20, None})
    assert out[12]["n_chars"] == len(out[12]["text"])


def test_substring_dedup_finds_passages_with_seams_inside_sentences(sp):
    import random

    from vitrine.llm.substring import WITHIN, duplicate_spans
    from .conftest import words

    r, data, want = random.Random(5), [], {}
    for k in range(12):
        stops = k % 3  # none, ASCII ones, others
        w = [x + ("" if not stops or r.random() < 0.9 else "." if stops == 1 else "\u3002") for x in words(140, 700 + k).split()]
        a = r.randrange(1, 70)
        passage = " ".join(w[a : a + 51])
        head = words(r.randrange(3, 60), 800 + k)
        data += [(2 * k, " ".join(w)), (2 * k + 1, f"{head} {passage} {words(r.randrange(3, 60), 900 + k)}")]
        want[2 * k + 1] = (head, passage)
    got = rows(duplicate_spans(sp.createDataFrame(data, "doc_id long, text string")))
    assert sorted(s["doc_id"] for s in got) == sorted(want)
    for s in got:
        head, passage = want[s["doc_id"]]
        at = len(head) + 1
        assert at <= s["start"] and s["end"] <= at + len(passage)
        assert s["n_words"] >= 51 - 2 * (WITHIN - 1) and s["kept_doc_id"] == s["doc_id"] - 1


def test_stages_leave_only_the_tables_they_read(sp, docs):
    import os

    import corpus_pipeline

    from vitrine.session import checkpoint_dir

    folder = checkpoint_dir(sp).removeprefix("file:") + "/tables"
    for stage in (corpus_pipeline.near_duplicate_stage, corpus_pipeline.substring_stage):
        before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
        assert stage(sp, docs, "").count()
        assert len(set(os.listdir(folder)) - before) == 1


def test_scratch_keeps_what_it_is_told_to(sp):
    from vitrine.llm.common import checkpoint, scratch, settled

    def build():
        with scratch(sp) as keep:
            a = keep(checkpoint(sp.range(3)))
            checkpoint(sp.range(4))
        return a.union(checkpoint(sp.range(2)))

    assert settled(sp, build).count() == 5


def test_substring_units_cost_four_bytes_and_none_is_lost(sp, docs):
    import pyarrow as pa

    from vitrine.llm import substring

    v = np.sort(np.random.default_rng(3).integers(0, 1 << 64, 5000, dtype=np.uint64))
    b = substring._deal(v, 6, 32)
    back = [(i, x) for i, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in np.frombuffer(d, np.uint32).tolist()]
    assert back == [(int(x) >> 58, int(x) >> 26 & 0xFFFFFFFF) for x in v] and sum(map(len, b.column(1).to_pylist())) == 4 * len(v)
    near = sp.createDataFrame([(5, 5), (-7, 5)], "node long, comp long")
    bits = substring.shared(docs, near)
    assert substring._lets(bits, np.array([5, -7], np.int64).view(np.uint64)).all()
    held = collections.defaultdict(set)
    for i, r in enumerate(rows(docs.select("text"))):
        for h in substring.Units(pa.array([r["text"]], pa.string())).hash.tolist():
            held[h].add(i)
    several = np.array([h for h, x in held.items() if len(x) > 1], np.uint64)
    single = np.array([h for h, x in held.items() if len(x) == 1], np.uint64)
    assert len(several) and substring._lets(bits, several).all() and substring._lets(bits, single).mean() < 0.2


def test_substring_groups_are_joined_where_there_are_many(sp, docs, monkeypatch):
    from vitrine.llm import substring

    want = sorted(map(str, rows(substring.duplicate_spans(docs))))
    monkeypatch.setattr(substring, "LOOKED_UP", -1)
    assert want and sorted(map(str, rows(substring.duplicate_spans(docs)))) == want


def test_substring_dedup_compares_paragraphs_of_nine_words(sp):
    from vitrine.llm.substring import duplicate_spans
    from .conftest import words

    nine = [words(9, 500 + k).split() for k in range(8)]
    text = lambda cut: " ".join(" ".join(w[:cut]) + "." for w in nine)
    near = [" ".join("zz %s." % " ".join(w) for w in nine)]
    got = rows(duplicate_spans(sp.createDataFrame([(1, text(9)), (2, near[0])], "doc_id long, text string")))
    assert [(s["doc_id"], s["kept_doc_id"]) for s in got] == [(2, 1)] and got[0]["n_words"] >= 40


def test_bands_reach_their_recall():
    from vitrine.llm.substring import tune_bands

    b, r = tune_bands(0.8, 0.995)
    assert 1 - (1 - 0.8**r) ** b >= 0.995


def test_mixing_targets_and_totals(docs):
    from vitrine.llm.mixing import mix, mixed_documents

    got = rows(mix(docs))
    again = rows(mix(docs.repartition(2)))
    key = lambda r: (str(r["doc_id"]), r["_tie"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    by = collections.defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    total = sum(r["size"] for r in got)
    targets = {s: rs[0]["target"] for s, rs in by.items()}
    assert math.isclose(sum(targets.values()), total, rel_tol=1e-9)
    w = dict(zip(sorted(by, key=lambda s: (s is None, s or "")), [5, 2, 1] * 9))
    size = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    full, share = set(), {}
    while True:
        left, open_w = total - sum(3 * size[s] for s in full), sum(w[s] for s in by if s not in full)
        share = {s: 3 * size[s] if s in full else w[s] * left / open_w for s in by}
        above = {s for s in by if share[s] > 3 * size[s]}
        if not above:
            break
        full |= above
    for s, rs in by.items():
        assert math.isclose(targets[s], share[s], rel_tol=1e-9)
        assert abs(sum(r["taken"] for r in rs) - targets[s]) <= 1
    made = mixed_documents(docs, mix(docs))
    assert made.columns == docs.columns
    n = sum(len(WORD.findall(r["text"] or "")) for r in rows(made))
    assert abs(n - sum(r["taken"] for r in got)) <= 2


def test_url_rules_and_propagation(sp):
    from vitrine.llm.urls import judge_urls

    link = lambda *u: "".join(f'<a href="{x}">' for x in u)
    pages = [(1, "http://A.net/x", link("http://far.io/")), (2, "http://x.example.net/en/1?q", ""), (3, "http://example.com/de/x", ""),
             (4, "https://b.org/fr/1#t", link("//good.io/a")), (5, "http://good.io/a", link("http://better.io/x")), (6, "http://better.io", None),
             (7, "http://spam.io/", link("http://a.net/x", "http://example.com/de/")), (8, None, None), (9, "nothing", ""), (10, "http://far.io/", ""),
             (11, "http://b.org", "")]
    got = {r["page_id"]: r for r in rows(judge_urls(sp.createDataFrame(pages, "page_id long, url string, html string")))}
    assert [got[i]["rule"] for i in range(1, 5)] == ["net/", "example.net/en/", "example.com/de/", "org/fr/"]
    assert [got[i]["verdict"] for i in range(1, 12)] == ["block", "allow", "block", "allow", "allow", "allow", "block", "allow", "allow", "allow", "allow"]
    assert got[6]["trust"] > 0 and got[7]["distrust"] > 0 and got[8]["host"] == "" and got[6]["path"] == "" and got[1]["host"] == "a.net"


def test_fingerprints(docs):
    from vitrine.llm.spotsigs import edited_neighbours

    d = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda x: (-(x[0] if x[0] is not None else -(1 << 63)), x[1]))
    want = []
    for k, (i, t) in enumerate(d):
        nxt, n = d[(k + 1) % len(d)][1], len(t) // 3
        want.append((str(i), len(t), hashlib.sha256((t[: len(t) - n] + nxt[:n]).encode()).hexdigest()))
    out = rows(edited_neighbours(docs))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in out) == sorted(want)
    f = {r["doc_id"]: r for r in out}
    assert f[1]["fingerprint"] == f[2]["fingerprint"] and f[10]["near_edited"] > 0.3 > f[10]["near_next"]


def test_likeness_of_long_texts_is_exact(sp):
    import pyarrow as pa
    from vitrine.llm.spotsigs import edited_neighbours, signature_sets
    from .conftest import words

    base = words(6000, 41)
    w = base.split()
    w[3000] = "zebra"
    data = [(3, base), (2, " ".join(w)), (1, words(900, 42) + " " + words(500, 41))]
    exact = lambda s, t: len(s & t) / len(s | t)
    sets = lambda texts: [set(s.tolist()) for s in signature_sets(pa.array(texts))]
    got = {r["doc_id"]: r for r in rows(edited_neighbours(sp.createDataFrame(data, "doc_id long, text string")))}
    for k, (i, t) in enumerate(data):
        nxt, n = data[(k + 1) % 3][1], len(t) // 3
        own, edited, other = sets([t, t[: len(t) - n] + nxt[:n], nxt])
        assert got[i]["near_edited"] == pytest.approx(exact(own, edited)) and got[i]["near_next"] == pytest.approx(exact(own, other))
    assert 0.99 < got[3]["near_next"] < 1


def test_members_of_similar_pairs(docs):
    from vitrine.llm.spotsigs import members, similar_pairs

    of = {}
    for r in rows(members(docs)):
        of.setdefault(r["fp"], []).append(r["doc_id"])
    assert sum(map(len, of.values())) == docs.count() and any({1, 2} <= set(x) for x in of.values())
    pairs = rows(similar_pairs(docs))
    assert pairs and all(p["a"] in of and p["b"] in of for p in pairs)


def test_similar_pairs_equals_all_pairs(docs):
    import pyarrow as pa
    from vitrine.llm.spotsigs import signature_sets, similar_pairs

    sets = {s.tobytes(): set(s.tolist()) for s in signature_sets(pa.array([r.text for r in docs.collect()]))}
    u = [s for s in sets.values() if s]
    want = sum(len(a & b) >= 0.8 * len(a | b) for i, a in enumerate(u) for b in u[:i])
    assert similar_pairs(docs).count() == want


def test_chat_round_trip_and_machine(sp):
    from vitrine.llm.chat import digests, format_conversations, read_turns

    own = "\\### Assistant: </turn> ok"
    data = [(1, 0, "system", "s"), (1, 1, "user", own), (1, 2, "assistant", own + "\\"), (2, 0, "assistant", "a"), (3, 0, "user", None),
            (3, 1, None, "x"), (4, 0, "User: #<\\", "t\n</turn>\n"), (4, 0, "User", "t"), (None, 5, "user", "\\b\\h"), (5, 0, "user", ""), (5, 1, "assistant", "")]
    df = sp.createDataFrame(data, "conv_id long, turn long, role string, text string")
    f = format_conversations(df)
    for r in f.select("turns", read_turns(f["formatted"]).alias("back")).collect():
        assert [(t.role, t.text) for t in r.turns] == [(t.role, t.text) for t in r.back]
    got = {r["conv_id"]: r for r in rows(digests(f))}
    said = own + "\\"
    assert got[1]["loss_chars"] == len(said) and got[1]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert [got[i]["valid"] for i in (1, 2, 3, 4, 5)] == [True, False, False, False, True]


def test_language_model(docs, empty):
    from vitrine.llm.lm import Model, held_out, score_documents

    d = [(r.doc_id, toks(r.text) + ["\0"]) for r in docs.collect()]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in d]
    c = collections.Counter(w for (_, t), h in zip(d, out) if not h for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), h, len(t), sum(c[w] > 0 for w in t), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 5)) for (i, t), h in zip(d, out))
    got = rows(score_documents(docs))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 5)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {n} and sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    a = Model(docs.where(~held_out(docs["doc_id"]))).automaton
    # arcs and the weight left over sum to 1 in every state
    assert np.allclose(np.bincount(a.pairs >> a.BITS, weights=a.pair_arc, minlength=len(a.left1)) + a.left1, 1)
    assert np.allclose(np.bincount(a.triples >> a.BITS, weights=a.triple_arc, minlength=len(a.left2)) + a.left2, 1)
    assert (a.left1 > 0).all() and (a.left2 > 0).all()
    assert math.isclose(sum(x - a.D for x in c.values()) / n + a.unknown, 1)
    assert rows(score_documents(empty)) == []


def test_toxicity_on_held_out_rows(sp):
    import random
    from vitrine.llm.toxicity import drop_toxic, fit, score_toxicity
    from .conftest import words

    r = random.Random(3)
    data, labels = [], []
    for i in range(400):
        w, y = words(r.randint(30, 120), i).split(), int(i % 5 == 0)
        for _ in range(len(w) // 20 + 1 if y else 0):
            w[r.randrange(len(w))] = r.choice(["idiot", "scum,", "gruxel", "gruxelig", "TRASH!"])
        data.append((i, " ".join(w), "x"))
        labels.append((i, 1, y))
    data += [(1000, None, "x"), (1001, "", "x")]
    docs = sp.createDataFrame(data, "doc_id long, text string, score string")
    lab = sp.createDataFrame(labels, "doc_id long, quality int, toxic int")
    m = fit(docs, lab)
    got = {x["doc_id"]: x for x in rows(score_toxicity(docs, m))}
    held = [i for i in range(400) if got[i]["held_out"]]
    assert held and sum(got[i]["predicted"] == (i % 5 == 0) for i in held) >= 0.97 * len(held)
    assert got[1000]["score"] == got[1001]["score"] < 0.5
    kept = drop_toxic(docs, m)
    assert kept.columns == docs.columns and kept.count() == sum(x["predicted"] == 0 for x in got.values())


def test_bpe_equals_the_library(sp, docs):
    import random

    import public_tokenizers as P
    from tokenizers import Tokenizer
    from vitrine.llm.bpe import VOCABULARY, bpe_decode, bpe_digests, bpe_encode

    t = Tokenizer.from_file(P.path(VOCABULARY))
    t.no_padding(), t.no_truncation()
    r = random.Random(5)
    texts = [x.text for x in docs.collect()] + ["a\x1cb \x85c", "ΑΣΣ ΣΑΣ İstanbul ẞ", "<|endoftext|>hello <|startoftext|>", "it's don't we've",
                                                "é ﬁ ½ 漢字 😀😀!!!", "a" * 500] + ["".join(r.choice("abAé .,!'s\n1😀ñ") for _ in range(80)) for _ in range(300)]
    df = sp.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x for x in rows(bpe_digests(df))}
    back = {x["doc_id"]: x for x in rows(bpe_decode(bpe_encode(df)))}
    for i, x in enumerate(texts):
        ids = t.encode(x or "", add_special_tokens=False).ids
        said = t.decode(ids, skip_special_tokens=False)
        assert back[i]["ids"] == ids and back[i]["decoded"] == said and got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_nearest_neighbours_recall(sp):
    from vitrine.llm.ann import nearest

    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[100:600] = x[100]  # a third of all rows
    data = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    data += [(5000, None, 0), (5020, [0.0] * 16, 0), (5040, [float("nan")] * 16, 0), (5060, [1.0], 0), (None, [1.0] * 16, 0), (20, data[20][1], 1)]
    got = collections.defaultdict(list)
    for r in rows(nearest(sp.createDataFrame(data, "vec_id long, embedding array<float>, label int"))):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 1500, 20))
    hit = 0
    y = x.astype(float)
    for q, found in got.items():
        s = (y * y[q]).sum(1)
        want = [i for _, i in sorted((-s[i], i) for i in range(1500) if i != q)[:20]]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and all(abs(s[i] - z) < 1e-12 * (1 + abs(z)) for _, i, z in found)
        assert [(-z, i) for _, i, z in found] == sorted((-z, i) for _, i, z in found)
        hit += len({f[1] for f in found} & set(want))
    assert hit >= 0.9 * 20 * len(got)


def test_wide_searches_in_steps_find_what_brute_force_finds(sp, monkeypatch):
    """Small blocks, so that a search takes several steps: with all leaves visited nothing may be lost to the score floor."""
    from vitrine.llm import ann

    monkeypatch.setattr(ann, "BLOCK_VECTORS", 16)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 4)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(700, 4)), 1).astype(np.float32)  # ties
    data = [(i, [float(v) for v in r]) for i, r in enumerate(x) if r.any()]
    y = x.astype(float)
    got = collections.defaultdict(list)
    for r in rows(ann.nearest(sp.createDataFrame(data, "vec_id long, embedding array<float>"), k=7, every=50, recall=1.0)):
        got[r["query_id"]].append((r["rank"], r["vec_id"]))
    assert len(got) == 14
    hit = 0
    for q, found in got.items():
        s = (y * y[q]).sum(1)
        want = [i for _, i in sorted((-s[i], i) for i, _ in data if i != q)[:7]]
        hit += len({i for _, i in found} & set(want))
        assert sorted(r for r, _ in found) == list(range(1, 8))
    assert hit >= 0.95 * 7 * len(got)
    ways = list(ann.blocks_on(range(6), np.array([0, 0, 1, 2, 2, 3]), np.array([1, 2, 1, 3])))
    assert [w[0] for w in ways] == [0, 1, 1, 1, 1, 2, 2] and [(w[1], w[2]) for w in ways] == [(0, 0), (1, 0), (1, 1), (2, 0), (3, 0), (3, 1), (3, 2)]


def test_empty_tables(sp, empty):
    from vitrine.llm import ann, bpe, chat, mixing, ngram_join, spotsigs, substring, toxicity, urls

    assert ngram_join.jaccard_components(empty).count() == 0
    assert substring.duplicate_spans(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert spotsigs.edited_neighbours(empty).count() == 0
    assert bpe.bpe_digests(empty).count() == 0
    assert urls.judge_urls(sp.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert chat.digests(chat.format_conversations(sp.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
    assert ann.nearest(sp.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    lab = sp.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(empty, toxicity.fit(empty, lab)).count() == 0


def test_substring_tells_documents_without_ids_apart(sp):
    from vitrine.llm.substring import duplicate_spans, remove_spans
    from .conftest import words

    passage = words(80, 70) + "."
    data = [(None, passage + " " + words(9, 71)), (None, words(9, 72) + ". " + passage), (None, words(9, 73) + ".\n" + passage),
            (7, words(20, 74) + ". " + passage), (7, words(20, 75) + ". " + passage), (7, words(20, 75) + ". " + passage)]
    df = sp.createDataFrame(data, "doc_id long, text string")
    kept = [r["text"] for r in rows(remove_spans(df, duplicate_spans(df))) if passage in r["text"]]
    assert len(set(kept)) == 1 and set(kept) <= {t for i, t in data if i == 7}
    assert len(rows(duplicate_spans(df))) == 4


def test_clashing_columns_come_out_unchanged(sp, docs):
    from vitrine.llm.mixing import mix, mixed_documents
    from vitrine.llm.substring import duplicate_spans, remove_spans
    from pyspark.sql import functions as F

    names = ["_h", "_id", "_th", "_s", "_t", "_size", "_part", "_copies", "_k", "_cut", "_new", "_epochs", "_extra", "_rows", "th", "spans"]
    mine = docs.withColumns({c: F.lit("mine") for c in names})
    none = sp.createDataFrame([], "doc_id long, weight double")
    for out in (remove_spans(mine, duplicate_spans(mine)), mixed_documents(mine, mix(mine, none))):
        assert out.columns == mine.columns
        got = out.select(*names).distinct().collect()
        assert len(got) == 1 and set(got[0]) == {"mine"}
