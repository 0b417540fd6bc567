import pytest

from vitrine.session import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, h string, key string"


@pytest.fixture(scope="session")
def sp(spark):
    ship_package(spark)
    return spark


def words(n, seed=0):
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def docs(sp):
    """Copies, near copies, a shared passage, nulls, empty and very long texts, repeated rows; columns that clash."""
    import random

    passage = words(60, 99) + "."
    rows = [(1, words(200, 1)), (2, words(200, 1)), (4, None), (5, ""), (6, " \n "), (7, "one"), (8, "One"), (9, "a b c"),
            (10, words(20000, 10)), (11, words(80, 11) + ". " + passage), (12, words(90, 12) + ".\n" + passage + "\nend"),
            (13, passage + " " + words(30, 13)), (None, words(50, 14)), (20, words(40, 20)), (20, words(40, 20))]
    base = words(200, 1).split()
    for i in range(30, 60):
        w = list(base)
        r = random.Random(i)
        for _ in range(r.randint(1, 6)):
            w[r.randrange(len(w))] = "edit%d" % r.randrange(50)
        rows.append((i, " ".join(w)))
    data = [(i, t, "en", "src%d" % (k % 5) if k % 7 else None, len(t or ""), "x", "y", "z") for k, (i, t) in enumerate(rows)]
    return sp.createDataFrame(data, DOCS).repartition(5)


@pytest.fixture(scope="session")
def empty(sp):
    return sp.createDataFrame([], DOCS)
