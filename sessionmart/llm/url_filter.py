"""URL filters: rules by host and path, and link-graph trust for the hosts that no rule settles.

A rule such as ``example.org/es/`` fits urls of its host and all subdomains whose path
starts with its path; the longest rule that fits decides. Hosts with allowed pages are
trusted seeds, hosts with blocked pages are distrusted ones, each weighted by the share
of its pages; a linked host without own pages is judged by the paths that are linked. Trust follows the links
between hosts (personalised PageRank); distrust follows them backwards, from a blocked host to those that link to it. A
page without a rule is blocked if its host's distrust exceeds its trust and a threshold, or if the mean distrust of the hosts it
links to exceeds the mean trust of those that link to it and the threshold, each taken as a share of the
score that seeds everywhere would give. The shares do not depend on how many other hosts link to the same target.

All steps are DataFrame operations. Links are pre-aggregated to host edges before any
join; rules are matched once a host, by an equality join on the host's suffixes, and pages
join their host's row (skewed hosts are split by adaptive execution).

Null url, or one without ``://``: empty host and path, no rule, allowed. Null html: no links. Null
``page_id`` and repeated rows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
ROUNDS = 12
MIN_DISTRUST = 0.05
LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""

TARGET = LINK.replace("([^/?#", "([^?#")  # host and path


def host_and_path(url):
    """Columns host and path of a url column."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit("")))


def _host_rules(hosts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Per host the rules of its own and its parents, longest first: host, rules."""
    spark = hosts.sparkSession
    listed = spark.createDataFrame([(r.partition("/")[0].translate(str.maketrans(UPPER, LOWER)), "/" + r.partition("/")[2], r, v)
                                    for v, r in rules], "rule_host string, rule_path string, rule string, verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (hosts.select("host", F.explode(suffixes).alias("rule_host")).join(listed, "rule_host")
            .select("host", F.struct((-F.length("rule")).alias("order"), "rule", "rule_path", "verdict").alias("r")))
    return fits.groupBy("host").agg(F.sort_array(F.collect_list("r")).alias("rules"))


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """Trust along and distrust against ``edges`` (src, dst): columns host, trust, distrust.

    ``seeds``: host, good, bad (each host once). A score is (1 - damping) times the seed
    plus damping times what flows in; a host hands its trust on in equal shares to the hosts it links to, its
    distrust to those that link to it. The lineage is cut every four rounds.
    """
    out_n = edges.groupBy("src").agg(F.count("*").alias("out_n"))
    in_n = edges.groupBy("dst").agg(F.count("*").alias("in_n"))
    edges = written(edges.join(out_n, "src").join(in_n, "dst"), "host-edges")
    start = seeds.select("host", ((1 - damping) * F.col("good")).alias("g0"), ((1 - damping) * F.col("bad")).alias("b0"))
    score = start.select("host", F.col("g0").alias("trust"), F.col("b0").alias("distrust"))
    if edges.isEmpty():
        return score
    for k in range(1, rounds + 1):
        forward = (edges.join(score, edges["src"] == score["host"])
                   .select(F.col("dst").alias("host"), (F.col("trust") / F.col("out_n")).alias("t"), F.lit(0.0).alias("d")))
        backward = (edges.join(score, edges["dst"] == score["host"])
                    .select(F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") / F.col("in_n")).alias("d")))
        flow = forward.union(backward).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        score = (start.join(flow, "host", "left")
                 .select("host", (F.col("g0") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
                         (F.col("b0") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust")))
        if k % 4 == 0 and k < rounds:
            score = written(score, "trust")
    return score


def _seeds(verdict: DataFrame) -> DataFrame:
    """Shares of allowed and of blocked rows a host."""
    return verdict.groupBy("host").agg(
        F.avg(F.when(F.col("verdict") == "allow", 1.0).otherwise(0.0)).alias("good"),
        F.avg(F.when(F.col("verdict") == "block", 1.0).otherwise(0.0)).alias("bad"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], rounds: int = ROUNDS, damping: float = DAMPING,
                min_distrust: float = MIN_DISTRUST) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, trust, distrust.

    ``rules``: (``allow`` or ``block``, host and path prefix) pairs.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = parsed.select("host").distinct()
    ruled = written(hosts.join(_host_rules(hosts, rules), "host", "left"), "host-rules")
    decided = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])), F.lit(0))
    verdict = (parsed.join(ruled, "host", "left")
               .select("host", decided["verdict"].alias("verdict")))
    seeds = _seeds(verdict)
    targets = F.explode(F.array_distinct(F.regexp_extract_all(F.col("html").cast("string"), F.lit(TARGET), F.lit(1))))
    link_host, link_path = host_and_path(F.concat(F.lit("://"), "target"))
    linked = written(pages.select(host.alias("src"), targets.alias("target")).select("src", link_host.alias("host"), link_path.alias("path"))
                     .where("src <> host and src <> '' and host <> ''").distinct(), "host-links")
    far = linked.select("host", "path").distinct().join(hosts, "host", "left_anti")
    far_hosts = far.select("host").distinct()
    seeds = written(seeds.union(_seeds(far.join(far_hosts.join(_host_rules(far_hosts, rules), "host"), "host", "left")
                                       .select("host", decided["verdict"].alias("verdict")))), "host-seeds")
    edges = linked.select("src", F.col("host").alias("dst")).distinct()
    scores = propagate(seeds, edges, rounds, damping)
    most = (propagate(seeds.select("host", F.lit(1.0).alias("good"), F.lit(1.0).alias("bad")), edges, rounds, damping)
            .select("host", F.col("trust").alias("t1"), F.col("distrust").alias("d1")))
    scores = written(scores.join(most, "host").select("host", "trust", "distrust", (F.col("trust") / F.col("t1")).alias("good"),
                                                      (F.col("distrust") / F.col("d1")).alias("bad")), "host-scores")
    bad_out = edges.join(scores, edges["dst"] == scores["host"]).groupBy(F.col("src").alias("host")).agg(F.avg("bad").alias("bad_out"))
    good_in = edges.join(scores, edges["src"] == scores["host"]).groupBy(F.col("dst").alias("host")).agg(F.avg("good").alias("good_in"))
    scores = scores.join(bad_out, "host", "left").join(good_in, "host", "left").fillna(0.0, ["bad_out", "good_in"])
    strong = (F.col("distrust") >= min_distrust) & (F.col("distrust") > F.col("trust"))
    share = (F.col("bad_out") >= min_distrust) & (F.col("bad_out") > F.col("good_in"))
    spread = F.when(strong | share, "block").otherwise("allow")
    judged = written(ruled.join(scores, "host").select("host", "rules", "trust", "distrust", spread.alias("spread")), "hosts")
    return (parsed.join(judged, "host", "left").withColumn("hit", decided)
            .select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                    F.coalesce("hit.verdict", F.when(F.col("host") == "", "allow").otherwise(F.col("spread"))).alias("verdict"),
                    "trust", "distrust"))
