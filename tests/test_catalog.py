"""The catalogue loads without touching any file, and again after a failed import."""

import glob
import importlib
import sys


def test_loads_without_files_and_twice(monkeypatch):
    for m in [m for m in sys.modules if m.startswith("vitrine.plans")]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setattr(glob, "glob", lambda *a, **k: [])
    import __spark_entry__ as E
    cat = importlib.import_module("vitrine.plans.catalog")
    n = len(cat.load_all())
    assert n >= 200 and len(cat.load_all()) == n
    assert len(E.queries()) >= n and len(E.queries()) == len(E.queries())


def test_registering_the_same_query_again_is_allowed_but_a_clash_is_not():
    import pytest

    from vitrine.plans.catalog import REGISTRY, register

    def q(spark, d):
        return None

    register("_again")(q)
    register("_again")(q)

    def other(spark, d):
        return None

    with pytest.raises(ValueError):
        register("_again")(other)
    del REGISTRY["_again"]
