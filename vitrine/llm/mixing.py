"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target in words is its share by weight of all words, at most ``max_epochs`` times its size; what a
capped source cannot take is shared out among the others by weight until none is above. A source takes whole
epochs of all its documents first. The rest of its budget goes to documents in order of the exponential key
-ln(u) / quality with u drawn from a hash of doc_id, so better documents come first more often and reruns agree;
the document that crosses the budget gives only its leading words.

No task holds a whole source: keys are cut into ranges, words are summed per (source, range), the running sum
goes over the ranges, and only rows of one range are put in order together.

Cases: null text has size 0; a null source is a source of its own, ordered last; a null doc_id draws as the text
"null"; equal keys are ordered by doc_id and then text, and equal rows by an arbitrary but fixed order; a source
of size 0 has target 0; an empty table gives an empty result. Sources are taken to be metadata (a table of
thousands at most); documents are unlimited.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import bounded_broadcast, checkpoint

WEIGHTS = (5.0, 2.0, 1.0)
#: Rows of one range that are put in order together, on average.
RANGE_ROWS = 2000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: int) -> Column:
    """(0, 1) from 52 bits of an md5, the same in any SQL engine."""
    h = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """source, source_size, target. ``sizes``: source, source_size."""
    n = len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("_i") - 1) % n + 1).cast("int"))
    s = sizes.withColumn("_i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("_w", w).withColumn(
        "_cap", (max_epochs * F.col("source_size")).cast("double")).withColumn("_full", F.col("source_size") == 0)
    s = checkpoint(s)
    total = s.agg(F.sum("source_size")).first()[0] or 0
    while True:
        full, open_w = s.agg(F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)), F.sum(F.when(~F.col("_full"), F.col("_w")).otherwise(0.0))).first()
        if not open_w:
            share = F.lit(0.0)
            break
        share = F.col("_w") * F.lit((total - full) / open_w)
        above = s.where(~F.col("_full") & (share > F.col("_cap")))
        if above.isEmpty():
            break
        s = checkpoint(s.withColumn("_full", F.col("_full") | (share > F.col("_cap"))))
    return s.select("source", "source_size", F.when(F.col("_full"), F.col("_cap")).otherwise(share).alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: Sequence[float] = WEIGHTS, max_epochs: int = 3, seed: int = 11) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, epochs (whole copies), extra (leading words of one more).

    ``quality``: doc_id, weight > 0 (1 where absent; the largest of repeated rows)."""
    d = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_tie"))
    if quality is not None:
        q = quality.groupBy("doc_id").agg(F.max("weight").alias("_q"))
        d = d.join(q, "doc_id", "left")
    else:
        d = d.withColumn("_q", F.lit(1.0))
    d = checkpoint(d.withColumn("_e", -F.log(uniform(F.col("doc_id"), seed)) / F.coalesce("_q", F.lit(1.0))).drop("_q"))
    sizes = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    sizes = checkpoint(sizes)
    budget = source_targets(sizes.drop("_n"), weights, max_epochs)
    budget = budget.join(sizes.select(F.col("source").alias("_s"), "_n"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).cast("long")
    budget = budget.withColumn("epochs", F.least(epochs, F.lit(max_epochs).cast("long"))).withColumn(
        "_rest", (F.round("target") - F.col("epochs") * F.col("source_size")).cast("long")).withColumn(
        "_b", F.ceil(F.col("_n") / RANGE_ROWS).cast("long"))
    budget = checkpoint(budget)
    budget_b = bounded_broadcast(budget.withColumnRenamed("source", "_s"))
    d = d.join(budget_b, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # a monotone map of the key to (0, 1): ranges of about equal row counts whatever the weights' scale
    d = d.withColumn("_range", F.floor((1 - F.exp(-F.col("_e"))) * F.col("_b")).cast("long"))
    per = d.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    run = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = checkpoint(per.withColumn("_before", F.coalesce(F.sum("_sum").over(run), F.lit(0)))).select(
        F.col("source").alias("_s"), F.col("_range").alias("_r"), "_before")
    d = d.join(bounded_broadcast(per), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    within = Window.partitionBy("source", "_range").orderBy("_e", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    d = d.withColumn("_at", before)
    extra = F.greatest(F.lit(0), F.least("size", F.col("_rest") - F.col("_at"))).cast("long")
    return d.select("doc_id", "source", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken"), "epochs", extra.alias("extra"), "_tie")


def mixed_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents of the mix: a row per whole copy, and one with the leading words where only part is taken.
    Columns are those of ``docs``; documents with nothing taken go. A document without words stays once."""
    plan = mixed.groupBy("doc_id", "source", "_tie").agg(F.first("size").alias("size"), F.max("epochs").alias("epochs"),
                                                         F.sum("extra").alias("extra"), F.count("*").alias("rows"))
    # the rows of repeated equal documents share their extra words evenly; helper columns have names no caller's column has
    part = F.when(F.col("size") > 0, F.floor(F.col("extra") / F.col("rows"))).otherwise(0)
    whole = F.when(F.col("size") > 0, F.col("epochs")).otherwise(1)
    mine, own, nth = (f"{x}_{uuid.uuid4().hex}" for x in ("plan", "hash", "copy"))
    plan = plan.select(F.struct("doc_id", "source", "_tie", "size", whole.alias("whole"), part.alias("part"),
                                (whole + (part > 0).cast("long")).cast("int").alias("copies")).alias(mine))
    at = lambda c: F.col(f"{mine}.{c}")
    cols = docs.columns
    j = docs.withColumn(own, F.xxhash64("text")).join(plan, F.col("doc_id").eqNullSafe(at("doc_id")) & F.col("source").eqNullSafe(at("source")) & (
        F.col(own) == at("_tie")))
    j = j.where(at("copies") > 0).withColumn(nth, F.explode(F.sequence(F.lit(1), at("copies"))))
    cut = (F.col(nth) > at("whole")) & (at("part") < at("size"))
    spaces = F.regexp_extract_all("text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    text = F.when(cut, F.array_join(F.slice(spaces, 1, at("part").cast("int")), "")).otherwise(F.col("text"))
    out = j.withColumn("text", text)
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    return out.select(*cols)
