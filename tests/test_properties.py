"""Property tests and plan-shape tests."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from vitrine.functions.text import price_locale


def py_price(s):
    """The stated rule: the last separator followed by one or two digits is
    the decimal mark, every other separator a thousands mark."""
    t = re.sub(r"[^0-9,.]", "", s)
    m = re.match(r"^(.*)[.,]([0-9]{1,2})$", t)
    txt = (re.sub(r"[.,]", "", m.group(1)) + "." + m.group(2)) if m else re.sub(r"[.,]", "", t)
    try:
        return float(txt)
    except ValueError:
        return None


price_text = st.one_of(
    st.text(alphabet="0123456789.,R$ ", max_size=12),
    st.builds(lambda a, sep, b: f"R$ {a}{sep}{b}", st.integers(0, 99999), st.sampled_from([",", "."]),
              st.integers(0, 999).map(str)),
)


@settings(max_examples=150, deadline=None)
@given(st.lists(price_text, min_size=1, max_size=40))
def test_price_locale_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "p string")
    got = [r[0] for r in df.select(price_locale("p")).collect()]
    assert got == [py_price(v) for v in values]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_and_aggregates_partially(spark):
    import __spark_entry__ as E
    df = E.queries()["label_summary"](spark, SF)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in plan      # only two columns read
    assert "partial_count" in plan and "partial_avg" in plan           # map-side combine


def test_first_per_key_is_a_partial_aggregate(spark):
    import __spark_entry__ as E
    plan = E.queries()["dedup_subset"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_roc_uses_range_partitioned_prefix_sums(spark):
    import __spark_entry__ as E
    df = E.queries()["roc_curve"](spark, SF)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan           # per-range offsets joined back
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_cartesian_products_in_sql_keys(spark):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    for k in ["integrity_counts", "retention_jobs", "profile_table", "scoring_stats", "importance_compare", "metrics_unpivot"]:
        plan = qs[k](spark, SF)._jdf.queryExecution().sparkPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, k


def test_durations_ignore_session_time_zone(spark):
    from vitrine.functions.partitioning import seconds_between_ntz
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")   # DST began 1996-10-06 00:00
        r = spark.sql("SELECT timestamp_ntz'1996-10-06 00:00:00' AS a, timestamp_ntz'1996-10-06 01:30:00' AS b") \
            .select(seconds_between_ntz(F.col("a"), F.col("b")).alias("s")).first()
        assert r.s == 5400.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
