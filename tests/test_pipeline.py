"""Split, balance, streaming and a sample of oracle checks at sf0.001."""

import duckdb
from pyspark.sql import functions as F

from tests.conftest import SF
from vitrine.operators import ml as ML
from vitrine.sources import fixtures as FX
from vitrine.sources.tables import TABLES


def test_split_sizes_and_stability(spark):
    lab = FX.labelled(spark, SF)
    a = ML.stratified_split(lab, "target", "doc_id")
    b = ML.stratified_split(lab.repartition(7), "target", "doc_id")
    sa = {(r.doc_id, r.side) for r in a.collect()}
    assert sa == {(r.doc_id, r.side) for r in b.collect()}
    n = {r.target: r.n for r in lab.groupBy("target").agg(F.count(F.lit(1)).alias("n")).collect()}
    t = {r.target: r.n for r in a.where("side = 'test'").groupBy("target").agg(F.count(F.lit(1)).alias("n")).collect()}
    import math
    assert all(t[k] == math.ceil(0.2 * n[k]) for k in n)


def test_stream_equals_batch(spark):
    import __spark_entry__ as E
    got = E.queries()["stream_ingest"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_latest_batch_keeps_all_part_files(spark, tmp_path):
    import os
    from vitrine.sources.files import latest_batch
    for k, name in enumerate(("b1", "b2")):
        spark.range(100 * k, 100 * k + 90).repartition(3).write.parquet(f"{tmp_path}/{name}")
        parts = sorted((tmp_path / name).glob("part-*.parquet"))
        assert len(parts) == 3
        for i, f in enumerate(parts):
            os.utime(f, (1_700_000_000 + 100 * k + i,) * 2)
    got = latest_batch(spark, f"{tmp_path}/*/*.parquet", "id long", fmt="parquet")
    assert sorted(r.id for r in got.collect()) == list(range(100, 190))
    for k, name in enumerate(("old", "new")):
        (tmp_path / f"{name}.csv").write_text(f"id\n{k}\n")
        os.utime(tmp_path / f"{name}.csv", (1_700_000_000 + k,) * 2)
    got = latest_batch(spark, f"{tmp_path}/*.csv", "id long")
    assert [r.id for r in got.collect()] == [1]


def _duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_oracle_sample(spark):
    import __spark_entry__ as E
    from tools.oracle_check import rows_of
    qs, sqls = E.queries(), E.oracle_sql()
    con = _duck(SF)
    for k in ["label_summary", "listing_clean", "dedup_subset", "join_latest_detail", "roc_auc", "cv_stats",
              "page_record", "tfidf_terms", "stream_tumbling", "numeric_features"]:
        df = qs[k](spark, SF)
        cur = con.execute(sqls[k])
        dcols = [d[0] for d in cur.description]
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, cur.fetchall()), k


def test_entry_smoke(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_search_is_chosen_by_the_space():
    from vitrine.plans.ml_queries import search_plan

    space = lambda *n: {str(i): list(range(k)) for i, k in enumerate(n)}
    assert search_plan(space(2, 2)) == ("grid", 4) and search_plan(space(10, 10)) == ("grid", 100)
    assert search_plan(space(101)) == ("random", 50) and search_plan(space(20, 25)) == ("random", 100)
    assert search_plan(space(501)) == ("random", 60) and search_plan(space(40, 40), minutes=120) == ("random", 200)
    assert search_plan(space(501), minutes=500) == ("random", 100)
