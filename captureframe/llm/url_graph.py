"""URL rules, and trust spread over the host graph for pages that no rule judges.

Rules: a rule has a host and a path prefix; it fits its host and all subdomains. Hosts are taken apart once per distinct host and
joined with rules on equal host suffixes; of the rules that also fit the path the longest decides.

Graph: hosts are nodes; a page that links to another host is an edge between the two. Trust starts at hosts by the share of
their ruled pages that are allowed and flows along edges; distrust starts by the share that is blocked and flows along reversed edges
(who links to blocked hosts is suspect). Both are personalised PageRank with mass ``1 - damping`` kept at each visit, summed as a
power series: only the mass that still moves takes part in a round, and a host's moving mass under ``tolerance`` of all seeds stays where it is, so
the rounds end by themselves, however long a chain of hosts is. Each is scaled to a sum of one: that is the PageRank whose seeds are a distribution and
whose mass at hosts without links goes back to the seeds, so the number of allowed and blocked hosts has no say. A host whose
distrust is more than ``threshold`` times its trust is blocked, others are allowed. Each round is written to the shared folder.

Pages never move by host while the table of hosts is under a checked size, which is then broadcast; beyond it, adaptive execution splits hot hosts.

DataFrame operations only. Defined results: a null url, or one without ``://``, has empty host and path, fits no rule, and is allowed;
hosts that nothing reaches are allowed, and so are ties; null html has no links; a very long text is searched whole; repeated rows keep their number;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captureframe.llm.shared import ascii_lower, bounded, drop_table, written

#: Hosts that a page's markup refers to, with or without a scheme.
LINK = r"""(?i)\bhref\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""
RULES = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def by_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` (with host and path) and the longest rule that fits: rule (like ``net/``) and ruled (its verdict), or nulls."""
    hosts = pages.select("host").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    ends = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("end"))
    named = rules.select(F.col("host").alias("end"), F.struct((F.length("host") + F.length("path")).alias("n"), F.concat("host", "path").alias("rule"), F.col("path").alias("prefix"), "verdict").alias("r"))
    per_host = ends.join(named, "end").groupBy("host").agg(F.sort_array(F.collect_list("r"), asc=False).alias("rs"))
    fits = F.filter("rs", lambda r: F.startswith(F.col("path"), r["prefix"]))
    joined = pages.join(bounded(written(per_host, "rules"), F.lit(64) + F.length("host") + 64 * F.size("rs")), "host", "left").withColumn("hit", F.get(fits, F.lit(0)))
    return joined.withColumns({"rule": F.col("hit.rule"), "ruled": F.col("hit.verdict")}).drop("rs", "hit")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst): distinct links between different hosts."""
    linked = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    return linked.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> '' AND src <> dst").distinct()


def spread(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-12, max_rounds: int = 400, fold: int = 8) -> DataFrame:
    """(host, mass): personalised PageRank of ``seeds`` (host, mass) over ``edges`` (src, dst), in all 1."""
    out = edges.groupBy("src").agg(F.count("*").alias("n"))
    weighted = written(edges.join(out, "src").select("src", "dst", (F.lit(damping) / F.col("n")).alias("w")), "weights")
    seeded = seeds.agg(F.sum("mass")).first()[0] or 1.0
    moving = written(seeds.select("host", (F.col("mass") / seeded).alias("mass")), "mass")
    total, parts = written(moving, "total"), [moving]
    for k in range(max_rounds):
        moved = moving.join(weighted, F.col("host") == F.col("src")).groupBy("dst").agg(F.sum(F.col("mass") * F.col("w")).alias("mass"))
        moving = written(moved.select(F.col("dst").alias("host"), "mass").where(F.col("mass") > tolerance), "mass")
        total = total.unionByName(moving)
        parts.append(moving)
        last = moving.isEmpty()
        if last or k % fold == fold - 1:
            total = written(total.groupBy("host").agg(F.sum("mass").alias("mass")), "total")
            for part in parts[:-1]:
                drop_table(part)
            parts = parts[-1:]
        if last:
            break
    else:
        raise RuntimeError("mass did not settle")
    drop_table(weighted)
    whole = total.agg(F.sum("mass")).first()[0] or 1.0
    return total.select("host", (F.col("mass") / whole).alias("mass"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], damping: float = 0.85, threshold: float = 1.0) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust)."""
    spark = pages.sparkSession
    url = F.col("url").cast("string")
    base = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = written(by_rules(base, spark.createDataFrame(rules, RULES)), "ruled")
    seeds = ruled.where("host <> '' AND ruled IS NOT NULL").groupBy("host").agg(F.avg((F.col("ruled") == "allow").cast("double")).alias("good"), F.avg((F.col("ruled") == "block").cast("double")).alias("bad"))
    seeds = written(seeds, "seeds")
    edges = written(host_edges(pages.select(host_of(url).alias("host"), F.col("html").cast("string").alias("html"))), "edges")
    trust = spread(edges, seeds.where("good > 0").select("host", F.col("good").alias("mass")), damping)
    distrust = spread(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), seeds.where("bad > 0").select("host", F.col("bad").alias("mass")), damping)
    scores = written(trust.withColumnRenamed("mass", "trust").join(distrust.withColumnRenamed("mass", "distrust"), "host", "full"), "scores")
    scored = ruled.join(bounded(scores, F.lit(64) + F.length("host")), "host", "left").withColumns({"trust": F.coalesce("trust", F.lit(0.0)), "distrust": F.coalesce("distrust", F.lit(0.0))})
    spread_verdict = F.when(F.col("distrust") > F.lit(threshold * (1 + 1e-9)) * F.col("trust"), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", spread_verdict).alias("verdict"), "trust", "distrust")
