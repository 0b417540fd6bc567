"""URL filters: rules on hosts and paths, and for the rest personalised PageRank over host links.

Trust starts at hosts whose pages the rules allow and flows along links; distrust starts at hosts whose
pages the rules block and flows against links (a host that links to a bad one is suspect). A host whose
distrust exceeds its trust is blocked.

Cases: a null url or one without "://" has empty host and path, fits no rule and is allowed; null html has
no links; a page without evidence about its host is allowed; repeated rows keep their own result rows; an
empty table gives an empty result; other columns are ignored. Links inside one host say nothing and are
dropped before the shuffle; walks that reach a host without outward links end there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import ascii_lower, checkpoint

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    return F.coalesce(ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules: Sequence = RULES) -> Column:
    """The longest rule that fits, as struct(len, rule, verdict); null where none fits."""
    by_host: dict[str, list] = {}
    for verdict, h, p in rules:
        by_host.setdefault(h, []).append((h + p, p, verdict))
    lookup = F.create_map(*[x for h, rs in by_host.items() for x in (
        F.lit(h), F.array(*[F.struct(F.lit(len(r)).alias("len"), F.lit(r).alias("rule"), F.lit(p).alias("path"),
                                     F.lit(v).alias("verdict")) for r, p, v in rs]))])
    labels = F.split(host, "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.try_element_at(lookup, s), F.array().cast(
        "array<struct<len:int,rule:string,path:string,verdict:string>>"))))
    return F.array_max(F.filter(fits, lambda r: F.startswith(path, r["path"])))


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts, from columns host and html."""
    found = F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""), F.lit(1))
    to = F.transform(found, lambda u: host_of(F.when(F.startswith(u, F.lit("//")), F.concat(F.lit("x:"), u)).otherwise(u)))
    away = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(to)).alias("dst"))
    return away.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = 0.85, rounds: int = 40, tol: float = 1e-9) -> DataFrame:
    """host, trust, distrust from seeds (host, trust, distrust, each column summing to 1 or 0).

    Both walks run in one frame with a ``kind`` column. ``rounds`` bounds the error by damping**rounds;
    it stops earlier once no score moves by more than ``tol``."""
    both = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n"))
    out = both.groupBy("kind", "host").agg(F.sum("n").alias("out"))
    arcs = checkpoint(both.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("out")).alias("w")))
    nodes = seeds.select("host").union(arcs.select("host")).union(arcs.select("to")).distinct().join(seeds, "host", "left")
    start = checkpoint(nodes.select("host", F.explode(F.create_map(
        F.lit("trust"), F.coalesce("trust", F.lit(0.0)), F.lit("distrust"), F.coalesce("distrust", F.lit(0.0)))).alias("kind", "seed")))
    rank = start.select("kind", "host", (F.col("seed") * (1 - damping)).alias("r"))
    for i in range(1, rounds + 1 if not arcs.isEmpty() else 1):
        got = rank.join(arcs, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(F.sum(F.col("r") * F.col("w")).alias("in"))
        new = start.join(got, ["kind", "host"], "left").select(
            "kind", "host", (F.col("seed") * (1 - damping) + damping * F.coalesce("in", F.lit(0.0))).alias("r"))
        if i % 5 == 0:
            new = checkpoint(new)
            moved = new.join(rank.withColumnRenamed("r", "_o"), ["kind", "host"]).agg(F.max(F.abs(F.col("r") - F.col("_o")))).first()[0]
            rank = new
            if moved is None or moved <= tol:
                break
        rank = new
    return rank.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("r"))).alias("trust"),
                                    F.sum(F.when(F.col("kind") == "distrust", F.col("r"))).alias("distrust"))


def judge_urls(pages: DataFrame, rules: Sequence = RULES, damping: float = 0.85, rounds: int = 40, margin: float = 0.0) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust (the host's scores). A page without a rule is
    blocked when its host's distrust exceeds its trust by more than ``margin``."""
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    p = p.withColumn("_m", match_rule(F.col("host"), F.col("path"), rules))
    by_host = checkpoint(p.where("host <> ''").groupBy("host").agg(
        F.count(F.when(F.col("_m.verdict") == "allow", 1)).alias("allow"), F.count(F.when(F.col("_m.verdict") == "block", 1)).alias("block")))
    allow, block = by_host.agg(F.sum("allow"), F.sum("block")).first()
    seeds = by_host.select("host", (F.col("allow") / F.lit(float(allow or 1))).alias("trust"), (F.col("block") / F.lit(float(block or 1))).alias("distrust"))
    score = propagate(seeds, host_links(p), damping, rounds)
    out = p.drop("html").join(score, "host", "left")
    method = F.when(F.coalesce("distrust", F.lit(0.0)) > F.coalesce("trust", F.lit(0.0)) + margin, "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("_m.rule").alias("rule"),
                      F.coalesce(F.col("_m.verdict"), method).alias("verdict"),
                      F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
