"""URL filtering: prefix rules, and trust spread over the link graph of hosts.

Rules decide the pages they fit. For all other pages the verdict is that of their host: personalised
PageRank from hosts with allowed pages gives trust along links; the same from hosts with blocked pages gives
distrust against the direction of links, since who links to bad hosts is suspect. The seed of a host are the
shares of allowed and blocked pages among its pages with a rule, whatever its size. A host takes trust from
others only as far as its own pages are not blocked, and distrust as far as they are not allowed. Whatever
is not taken, or reaches a host without links, goes back to the seeds, so no rank is lost. A host is blocked
where its distrust passes its trust by a factor, and a part of what a wholly blocked host is given each round.

Ranks are whole numbers (`MASS` for a whole share), so sums do not depend on the partitioning. Links are counted
per pair of hosts before anything else, so a host with a third of all pages is a few rows; a
host that very many hosts link to is summed before the shuffle.

Defined results: a null url, or one without `://`, has an empty host and path, fits no rule and is
allowed; repeated rows are judged once each; a null html has no links; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.session import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the contract, as host and path.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
LINK = r"(?is)<a\s[^>]*?href\s*=\s*[\"']?\s*([^\"'\s>]+)"
MASS = 2**30


@dataclass(frozen=True)
class Spread:
    """damping: share that follows links; rounds of propagation; limit: least distrust, in parts of what
    a wholly blocked host is given each round; factor: how often distrust must hold trust."""

    damping: float = 0.85
    rounds: int = 12
    limit: float = 0.25
    factor: float = 1.5


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    rest = F.coalesce(after_scheme(url), F.lit(""))
    return host_of(rest), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits, as a struct of its length, text and verdict."""
    fits = []
    for rule, verdict in rules:
        name, _, rest = rule.partition("/")
        on_host = (host == name) | host.endswith("." + name)
        fits.append(F.when(on_host & path.startswith("/" + rest), F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links from one host to another; relative links stay on their host."""
    found = pages.filter(F.col("html").contains("//")).select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to"))
    found = found.filter(F.col("to").rlike("^(?i:https?:)?//"))
    found = found.select(F.col("host").alias("src"), host_of(F.regexp_replace("to", "^(?i:https?:)?//", "")).alias("dst"))
    return found.filter("src != '' AND dst != '' AND src != dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def seeds(judged: DataFrame) -> DataFrame:
    """(host, trust, distrust): shares of allowed and blocked pages among those with a rule, 0 without any."""
    verdict = F.col("rule.verdict")
    shares = (F.coalesce(F.avg(F.when(verdict.isNotNull(), (verdict == v).cast("int"))), F.lit(0.0)).alias(c) for v, c in (("allow", "trust"), ("block", "distrust")))
    return judged.filter("host != ''").groupBy("host").agg(*shares)


def propagate(start: DataFrame, edges: DataFrame, spread: Spread) -> DataFrame:
    """(host, trust, distrust) after the rounds of personalised PageRank, with `MASS` for a whole share.

    Both ranks move in one pass: trust along the edges, distrust against them. What hosts take is stored
    every round; its two sums, all that the driver sees, tell how much goes back to the seeds. Without
    edges the seeds are the ranks.
    """
    ways = ("trust", "distrust")
    known = start.select("host", *(F.floor(F.col(c) * F.lit(float(MASS))).cast("long").alias(c) for c in ways))
    linked = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct().join(known, "host", "left_anti")
    base = store(known.unionByName(linked.select("host", *(F.lit(0).cast("long").alias(c) for c in ways))), "seeds")
    both = edges.select(F.col("src").alias("host"), F.col("dst").alias("to"), "n", F.lit(True).alias("forward"))
    both = both.union(edges.select(F.col("dst").alias("host"), F.col("src").alias("to"), "n", F.lit(False).alias("forward")))
    totals = both.groupBy("host", "forward").agg(F.sum("n").alias("all"))
    flows = store(both.join(totals, ["host", "forward"]), "flows")
    if flows.isEmpty():
        return base
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ways]
    given = base.agg(*sums).first()
    seeds_of = base.select("host", *(F.col(c).alias(f"seed_{c}") for c in ways))
    now = base
    for _ in range(spread.rounds):
        rank = F.when(F.col("forward"), F.col("trust")).otherwise(F.col("distrust"))
        part = F.floor(rank * F.lit(spread.damping) * (F.col("n") / F.col("all"))).cast("long")
        sent = flows.join(now, "host").select(F.col("to").alias("host"), *(F.when(F.col("forward") == way, part).otherwise(0).alias(c) for c, way in zip(ways, (True, False), strict=True)))
        reached = sent.groupBy("host").agg(*(F.sum(c).alias(c) for c in ways)).join(seeds_of, "host")
        open_to = {c: 1 - F.col(f"seed_{other}") / MASS for c, other in zip(ways, ways[::-1], strict=True)}
        taken = store(reached.select("host", *(F.floor(F.col(c) * open_to[c]).cast("long").alias(c) for c in ways)), "ranks")
        back = [1 - t / g if g else 0.0 for t, g in zip(taken.agg(*sums).first(), given, strict=True)]
        home = [F.floor(F.col(f"seed_{c}") * F.lit(b)).cast("long") for c, b in zip(ways, back, strict=True)]
        now = seeds_of.join(taken, "host", "left").select("host", *((F.coalesce(F.col(c), F.lit(0)) + h).alias(c) for c, h in zip(ways, home, strict=True)))
    return now


def host_verdicts(ranks: DataFrame, spread: Spread) -> DataFrame:
    """(host, distrusted), by the ranks of every host alike."""
    least = spread.limit * (1 - spread.damping) * MASS
    return ranks.select("host", ((F.col("distrust") > F.lit(least)) & (F.col("distrust") > spread.factor * F.col("trust"))).alias("distrusted"))


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, spread: Spread | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page."""
    spread = spread or Spread()
    host, path = parts(F.col("url").cast("string"))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), F.col("html").cast("string").alias("html"))
    ruled = own.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    judged = store(ruled.drop("html"), "judged")
    edges = store(links(own), "links")
    start = store(seeds(judged), "shares")
    verdicts = host_verdicts(propagate(start, edges, spread), spread)
    # A row per host on the right; a host with very many pages is split by adaptive execution.
    found = judged.join(verdicts.filter("distrusted"), "host", "left")
    verdict = F.coalesce(F.col("rule.verdict"), F.when(F.col("distrusted"), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", F.col("rule.rule").alias("rule"), verdict.alias("verdict"))
