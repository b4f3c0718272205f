"""URL rules and link-graph propagation over hosts, with DataFrame functions only.

A page's url is judged by the longest rule that fits its host and path.  Where
none fits, its host is judged from the link graph: trust spreads from hosts
with allowed pages along the links (personalised PageRank), distrust from
hosts blocked as a whole against the links, and a host is blocked when its
distrust exceeds both its trust and a share of what blocked seeds hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
#: Absolute or protocol-relative links of a page; the group is the host.
LINK = r"(?i)\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Production rules.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
         Rule("allow", "org", "/fr/"))


@dataclass(frozen=True)
class Propagation:
    """``damping``: share of a score that moves along the links in a round;
    ``tolerance``: rounds end when no host's score changes by more than this part of
    the least distrust that blocks a host, however large the graph is;
    ``seed_share``: least distrust of a blocked host, as a share of the blocked seeds' mean."""

    damping: float = 0.85
    tolerance: float = 1e-4
    seed_share: float = 0.1


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, HOST, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else NULL; of equally long ones the first by text."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def host_links(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts; ``pages`` has ``host`` and the page's html."""
    found = F.explode(F.regexp_extract_all(F.col(html_col), F.lit(LINK), 1))
    return pages.where(F.col(html_col).contains("//") & (F.col("host") != "")) \
        .select(F.col("host").alias("src"), found.alias("dst")) \
        .select("src", F.translate("dst", UPPER, LOWER).alias("dst")) \
        .where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(spark: SparkSession, links: DataFrame, seeds: DataFrame, how: Propagation = Propagation()) -> DataFrame:
    """(host, trust, distrust) from links (src, dst, n) and seeds (host, good, bad).

    Trust moves from a host to those it links to, in proportion to the links;
    distrust from a host to those that link to it.  The seeds' weights add up
    to 1 on either side.  Hosts that nothing reaches are absent.  Rounds end when the
    largest change of a host is a small part of the level that decides:
    ``seed_share`` of the blocked seeds' mean distrust, or of an even share of trust
    where nothing is blocked.
    """
    total = seeds.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).first()
    g, b = float(total["g"] or 0) or 1.0, float(total["b"] or 0) or 1.0
    seed = staged(spark, seeds.select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), (F.col("good") / g).alias("score")),
        F.struct(F.lit("distrust").alias("kind"), (F.col("bad") / b).alias("score")))).alias("s"))
        .select("host", "s.kind", "s.score").where("score > 0"), "seeds")
    out = links.groupBy("src").agg(F.sum("n").alias("all"))
    into = links.groupBy("dst").agg(F.sum("n").alias("all"))
    moves = staged(spark, links.join(out, "src").select(F.lit("trust").alias("kind"), F.col("src").alias("host"),
                                                        F.col("dst").alias("to"), (F.col("n") / F.col("all")).alias("w"))
                   .unionAll(links.join(into, "dst").select(F.lit("distrust"), F.col("dst"), F.col("src"),
                                                            F.col("n") / F.col("all"))), "moves")
    blocked = seed.where("kind = 'distrust'").select("kind", "host")
    n_seeds = max(seed.where("kind = 'trust'").count(), 1)
    restart = seed.select("kind", "host", (F.col("score") * (1 - how.damping)).alias("score"))
    score = seed.select("kind", "host", "score")
    while True:
        moved = score.join(moves, ["kind", "host"]) \
            .select("kind", F.col("to").alias("host"), (how.damping * F.col("score") * F.col("w")).alias("score"))
        after = staged(spark, restart.unionAll(moved).groupBy("kind", "host").agg(F.sum("score").alias("score")), "rank")
        change = after.withColumnRenamed("score", "now").join(score, ["kind", "host"], "full") \
            .agg(F.max(F.abs(F.coalesce("now", F.lit(0.0)) - F.coalesce("score", F.lit(0.0))))).first()[0] or 0.0
        score = after
        level = score.join(blocked, ["kind", "host"]).agg(F.avg("score")).first()[0] or 1.0 / n_seeds
        if change <= how.tolerance * how.seed_share * level:
            break
    pick = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
    return score.groupBy("host").agg(pick("trust"), pick("distrust"))


def judge(spark: SparkSession, pages: DataFrame, rules=RULES, how: Propagation = Propagation(),
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    A seed of trust is a host with pages that a rule allows, weighted by them;
    a seed of distrust one with pages blocked by a rule without a path (a rule
    with a path speaks for that path only).  A NULL url has an empty host and
    path, fits no rule and is allowed; NULL html has no links.  Repeated rows
    stay, each with the same result; an empty table gives an empty result.
    """
    host = host_of(F.col("__url"))
    read = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).alias("__html")) \
        .select("__id", host.alias("host"), path_of(F.col("__url")).alias("path"), "__html")
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    urls = staged(spark, read.select("__id", "host", "path", text.alias("rule"), verdict.alias("said")), "urls")
    whole = [r.text for r in rules if r.verdict == "block" and r.path in ("", "/")]
    seeds = urls.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("said") == "allow").alias("good"), F.count_if(F.col("rule").isin(whole)).alias("bad")) \
        .where("good + bad > 0")
    links = staged(spark, host_links(read, "__html"), "links")
    seeds = staged(spark, seeds, "seedhosts")
    scores = propagate(spark, links, seeds, how)
    level = scores.join(seeds.where("bad > 0").select("host"), "host").agg(F.avg("distrust")).first()[0] or 0.0
    bad = scores.where((F.col("distrust") > F.col("trust")) & (F.col("distrust") > 0)
                       & (F.col("distrust") >= how.seed_share * level)).select("host", F.lit("block").alias("by_links"))
    return urls.join(bad, "host", "left").select(
        F.col("__id").alias(id_col), "host", "path", "rule",
        F.coalesce("said", "by_links", F.lit("allow")).alias("verdict"))
