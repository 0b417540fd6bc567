"""Conversation repair against a left-to-right search over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from vitrine.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit string, _h1 string, kind int"


def brute(rows):
    """conv -> digest columns, by dynamic programming over the target's positions (no grammar, no spans)."""
    convs = {}
    for conv, turn, role, text in rows:
        got = convs.setdefault(conv, [])
        key = "%s:%s" % (" " if conv is None else conv, " " if turn is None else turn)
        role, text, how = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        got += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    out = {}
    for conv, got in convs.items():
        # the order among equal turns is free: take the engine's
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), R_HASH(r[2])))
        seen, faults = set(), []
        for _, role, text in got:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in got if t is not None]
        best = {0: (0, "", [])}  # state -> cost, audit, repaired rows

        def step(best):
            while True:
                new = dict(best)
                for p, (c, a, o) in best.items():
                    w = "a" if p == 2 else "u"
                    q = R.AFTER[p][w]
                    x = (c + 2, a + "I", o + [({"u": "user", "a": "assistant"}[w], "")])
                    if q not in new or x[:2] < new[q][:2]:
                        new[q] = x
                if new == best:
                    return best
                best = new

        best = step(best)
        for (_, role, text), f in zip(got, faults):
            new = {}

            def offer(q, x):
                if q not in new or x[:2] < new[q][:2]:
                    new[q] = x

            for p, (c, a, o) in best.items():
                offer(p, (c + 3, a + "D", o))
                if f not in ("b", "d"):
                    extra = f == "t"
                    for i in "sua":
                        if i in R.AFTER[p]:
                            if role[:1] == i:
                                offer(R.AFTER[p][i], (c + extra, a + "K", o + [(role, text)]))
                            if i != "s":
                                offer(R.AFTER[p][i], (c + 2 + extra, a + "R", o + [({"u": "user", "a": "assistant"}[i], text)]))
            best = step(new)
        c, a, o = min(x for q, x in best.items() if q in (0, 3)) if got else (0, "", [])
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                     sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(got, got[1:])), c, a,
                     hashlib.sha256("\n".join(r + ":" + t for r, t in o).encode()).hexdigest())
    return out


R_HASH = None


def engine(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def rows_of(seed, convs, longest):
    r, out = random.Random(seed), []
    for c in range(convs):
        turn = 0
        for _ in range(r.randint(1, longest)):
            turn += r.choice([0, 1, 1, 1, 1, 2])
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sage"])
            text = r.choice(["a b.", "c!", "no end", " ", "", None, "éè?", "x. \n", "end. y", "d" + str(r.randrange(9)) + "."])
            out.append((c if c else None, turn if r.random() < 0.97 else None, role, text))
    return out


@pytest.fixture()
def hashes(sp):
    from pyspark.sql import functions as F

    def use(rows):
        global R_HASH
        texts = list({x for _, _, _, t in rows for x in ({" "} if t is None else {t, re.sub("[.!?]", "", t)})} | {""})
        got = {r.text: (r.a, r.b) for r in sp.createDataFrame([(t,) for t in texts], "text string").select(
            "text", F.xxhash64("text").alias("a"), F.xxhash64(F.lit("again"), "text").alias("b")).collect()}
        R_HASH = got.__getitem__

    return use


@pytest.mark.parametrize("seed,convs,longest", [(1, 120, 9), (2, 4, 250)])
def test_repair_equals_a_search(sp, hashes, seed, convs, longest):
    rows = rows_of(seed, convs, longest)
    hashes(rows)
    df = sp.createDataFrame([(*r, "x", "y", "z", 7) for r in rows], SCHEMA).repartition(5)
    assert engine(R.repair(R.damaged(df))) == brute(rows)


def test_a_conversation_over_many_tasks_with_many_repeats(sp, hashes):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", "t%d." % (t % 50)) for t in range(600)] + [(7, 3, "user", "same.")] * 40
    rows += [(8, 1, "user", "w " * 50_000 + "end.")]
    hashes(rows)
    df = sp.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    assert engine(R.repair(R.damaged(df))) == brute(rows)


def test_dropped_and_empty(sp):
    gone = next(t for t in range(999) if zlib.crc32(b"5:%d" % t) % 20 == 0)
    df = sp.createDataFrame([(5, gone, "user", "a.")], "conv_id long, turn long, role string, text string")
    assert engine(R.repair(R.damaged(df))) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert R.repair(R.damaged(df.limit(0))).collect() == []


def test_any_split_gives_the_same_cell():
    r = random.Random(4)
    for _ in range(200):
        rows = [(r.choice("suax"), r.choice(["", "t", "d"])) for _ in range(r.randint(2, 14))]
        cells = [R.row_cell(*x) for x in rows]
        k = r.randrange(1, len(cells))
        p = R.Parser()
        for x in rows:
            p.add(*x)
        assert R.fold(cells) == R.combine(R.fold(cells[:k]), R.fold(cells[k:])) == p.cell()
    assert R.power(R.row_cell("u", "d"), 13) == R.fold([R.row_cell("u", "d")] * 13)
