"""URL filter by link-graph propagation, with DataFrame functions only.

Rules of a short list (configuration, compiled into the plan) decide first; the longest fitting rule wins.  Pages without a
rule are judged by their host: trust is a personalised PageRank from the hosts of allowed pages along host edges, and
distrust is one from the hosts of blocked pages against the edges.  Both restart in proportion to the host's allowed or
blocked pages.  A host is blocked when ``threshold`` of its trust and distrust is distrust; a host neither reaches is allowed.

Edges: links of the pages' HTML (href or src values with a host of their own; the others stay on the host), summed per pair
of hosts before they are shuffled; the share of an edge is its part of all links of its source.  What reaches a host
without outgoing edges goes no further.  The rank tables have one row per host; they are joined
by host and written every few rounds to the shared folder, so that a lost executor costs no more than those rounds.  Rounds
end when the ranks have changed by less than ``TOLERANCE`` in sum since the table written last and no other host was reached:
the ranks are then within TOLERANCE in sum of their limits, and every host that can be reached has a rank, however long the way.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path: from there up to ``?``, ``#`` or the
end.  Null urls and those without ``://`` have an empty host and path, no rule, and are allowed.  Extra columns that clash
with the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauseloom.session import written

from .registry import discard, free_name

TOLERANCE, DAMPING, THRESHOLD, ROUNDS_PER_WRITE = 1e-6, 0.85, 0.5, 5
ROUNDS = 10  # of the SQL beside the query, which cannot run until nothing changes
LINK = r"(?i)(?:href|src)\s*=\s*[\"']?([^\"'\s>]+)"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; null where there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(rest_of(url), r"^([^/?#]*)", 1), ascii_uppercase, ascii_lowercase)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits as a struct of rule and verdict; null where none does."""
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        fitting = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(fitting)
    return fitting


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, weight: links between hosts, summed up."""
    links = pages.where("host != ''").select("host", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), 1)).alias("link"))
    absolute = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))
    target = F.coalesce(F.nullif(host_of(absolute), F.lit("")), F.col("host"))
    return links.groupBy(F.col("host").alias("src"), target.alias("dst")).agg(F.count("*").cast("double").alias("weight"))


def propagate(hosts: DataFrame, edges: DataFrame, seed: str, rounds: int | None = None, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """host, rank: personalised PageRank with restarts in proportion to the column ``seed`` of ``hosts``.

    ``edges`` (src, dst, share) carry shares that add up to 1 for each source.  All seeds 0: all ranks 0.
    Without ``rounds``, as many as it takes to come within ``tolerance``; ``damping`` must be below 1 for that.
    """
    total = hosts.agg(F.sum(seed)).first()[0] or 0.0  # one number
    nodes = hosts.select("host", (F.col(seed) / total if total else F.lit(0.0)).alias("restart"))
    rank = last = nodes.select("host", F.col("restart").alias("rank"))
    done = 0
    while rounds is None or done < rounds:
        sent = edges.join(rank, edges.src == rank.host).groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("share") * F.col("rank")).alias("got"))
        rank = nodes.join(sent, "host", "left").select(
            "host", (damping * F.coalesce("got", F.lit(0.0)) + (1.0 - damping) * F.col("restart")).alias("rank"))
        done += 1
        if done % ROUNDS_PER_WRITE == 0 or done == rounds:
            rank = written(rank, "host-rank")
            settled = rounds is None and _settled(last, rank, tolerance)
            if done > ROUNDS_PER_WRITE:
                discard(last)
            last = rank
            if settled:
                break
    return rank


def _settled(before: DataFrame, rank: DataFrame, tolerance: float) -> bool:
    """Whether rounds that led from one rank table to the other changed little and reached no other host; one row is read."""
    both = rank.join(before.withColumnRenamed("rank", "before"), "host")
    r = both.agg(F.sum(F.abs(F.col("rank") - F.col("before"))).alias("change"), F.count_if((F.col("rank") > 0) & (F.col("before") == 0)).alias("reached")).first()
    return (r.change or 0.0) < tolerance and not r.reached


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...], rounds: int | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` with host, path, rule, verdict, and the trust and distrust of the host where it has any."""
    own = pages.drop("host", "path", "rule", "verdict", "trust", "distrust")
    url = F.col("url").cast("string")
    parsed = own.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    fit = free_name(parsed, "fit")
    ruled = parsed.withColumn(fit, rule_of(F.col("host"), F.col("path"), rules))
    counted = ruled.where("host != ''").groupBy("host").agg(
        F.coalesce(F.count_if(F.col(f"{fit}.verdict") == "allow"), F.lit(0)).cast("double").alias("trusted"),
        F.coalesce(F.count_if(F.col(f"{fit}.verdict") == "block"), F.lit(0)).cast("double").alias("blocked"))
    edges = written(host_edges(ruled.select("host", F.col("html").cast("string").alias("html"))), "host-edges")
    linked = edges.select(F.col("dst").alias("host"), F.lit(0.0).alias("trusted"), F.lit(0.0).alias("blocked"))
    hosts = written(counted.unionByName(linked).groupBy("host").agg(F.sum("trusted").alias("trusted"), F.sum("blocked").alias("blocked")), "hosts")

    def shares(source: str, target: str) -> DataFrame:
        out = edges.groupBy(F.col(source).alias("node")).agg(F.sum("weight").alias("all_weight"))
        weighed = edges.join(out, F.col(source) == F.col("node"))
        return written(weighed.select(F.col(source).alias("src"), F.col(target).alias("dst"), (F.col("weight") / F.col("all_weight")).alias("share")), "shares")

    trust = propagate(hosts, shares("src", "dst"), "trusted", rounds).withColumnRenamed("rank", "trust")
    distrust = propagate(hosts, shares("dst", "src"), "blocked", rounds).withColumnRenamed("rank", "distrust")
    scores = trust.join(distrust, "host")
    judged = ruled.join(scores, "host", "left")
    bad = (F.col("distrust") > 0) & (F.col("distrust") >= threshold * (F.col("trust") + F.col("distrust")))
    verdict = F.coalesce(F.col(f"{fit}.verdict"), F.when(bad, F.lit("block")).otherwise(F.lit("allow")))
    return judged.withColumn("rule", F.col(f"{fit}.rule")).withColumn("verdict", verdict).drop(fit).select(*own.columns, "host", "path", "rule", "verdict", "trust", "distrust")
