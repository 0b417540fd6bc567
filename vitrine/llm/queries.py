"""Registered queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import ann, bpe, chat, langid, lm, mixing, ngram_join, repair, spotsigs, substring, toxicity, urls, whitening
from vitrine.llm.common import settled, table


def label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, weight: 2 for documents labelled good, 1/2 for those labelled bad."""
    return table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


def op1_substring_dedup(spark, sf_dir):
    return settled(spark, lambda: substring.duplicate_spans(table(spark, sf_dir, "documents"))).drop("text_hash")


def op2_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), label_quality(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op4_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_spotsigs(spark, sf_dir):
    return spotsigs.edited_neighbours(table(spark, sf_dir, "documents"))


def op6_chat_format(spark, sf_dir):
    own = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(own).alias("text"))
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.format_conversations(conv))


def op7_lm_score(spark, sf_dir):
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_bpe(spark, sf_dir):
    return bpe.bpe_digests(table(spark, sf_dir, "documents"))


def op10_ann_tree(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op11_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_repair(spark, sf_dir):
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations"))).drop("repaired_rows")


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_mixing, op3_url_filter, op4_ngram_join, op5_spotsigs, op6_chat_format, op7_lm_score, op8_toxicity, op9_bpe, op10_ann_tree,
                                   op11_language_id, op12_whitening, op13_repair, pipeline)}

SQL = {
    "op2_mixing": r"""
WITH q AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END)::DOUBLE AS weight FROM labels GROUP BY doc_id),
d AS (SELECT t.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        -ln((('0x' || substr(md5(coalesce(t.doc_id::VARCHAR, 'null') || ':11'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
          / coalesce(weight, 1.0::DOUBLE) AS e
      FROM documents t LEFT JOIN q ON t.doc_id = q.doc_id),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ([5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w
      FROM d GROUP BY source),
r AS (SELECT *, 3.0::DOUBLE * source_size AS cap,
        coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
        sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_open,
        sum(source_size) OVER () AS total FROM s),
c AS (SELECT *, w * ((total - full_before) / w_open) > cap AS capped_here, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS i FROM r),
f AS (SELECT coalesce(min(i) FILTER (NOT capped_here), 1 << 40) AS first_open FROM c),
o AS (SELECT (total - full_before) / w_open AS share FROM c, f WHERE i = first_open),
g AS (SELECT source, source_size, CASE WHEN i < first_open THEN cap ELSE w * (SELECT share FROM o) END::DOUBLE AS target FROM c, f),
b AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(round(target) / source_size), 3) ELSE 0 END::BIGINT AS epochs FROM g),
p AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, round(target)::BIGINT - epochs * source_size AS rest,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY e, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM p""",
    "op6_chat_format": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
x AS (SELECT *, length(replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l')) AS text_chars,
    CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
      ELSE 2 + length(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c')) END AS role_chars,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS prev, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(text_chars + role_chars) + count(*) * 14)::BIGINT AS formatted_chars,
  bool_and(CASE WHEN i = 1 THEN role IN ('system', 'user') WHEN prev IN ('system', 'assistant') THEN role = 'user'
    WHEN prev = 'user' THEN role = 'assistant' ELSE false END AND (i < n OR role = 'assistant')) AS valid
FROM x GROUP BY conv_id""",
}
