"""URL verdicts: rules first, then trust and distrust spread over host links.

A rule names a host and a path; it fits the host and its subdomains where the
path starts with the rule's, and the longest rule wins. For urls without a rule
the host decides. Pages under an allow rule make their host a trusted seed,
pages under a block rule a distrusted one, each by its share of the host's
pages. Trust flows along links between hosts (personalised PageRank), distrust
against them, from a linked host to those that link to it. A host is blocked
where its distrust is above its trust and above what a host without links has
when ``SHARE`` of its pages are under a block rule.

Links are absolute ``href`` targets, counted once per page and host; links
inside a host do not count.

Edge cases: a missing url, or one without ``://``, has an empty host and path,
fits no rule and takes no part in the graph, and is allowed; missing html has
no links; equal rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.words import LOWER, UPPER
from marketloom.session import materialize


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
HREF = r"""[hH][rR][eE][fF][ \t\r\n]*=[ \t\r\n]*["']?(?:[hH][tT][tT][pP][sS]?:)?//([^/?#"'<> \t\r\n]+)"""
DAMPING = 0.85
STEPS = 8
SHARE = 0.5
#: Steps of the propagation between two stored tables.
STORE_EVERY = 4


def host(url: str = "url") -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_number(rules: tuple[Rule, ...]) -> Column:
    """Index of the longest rule that fits ``host`` and ``path``."""
    out = F.lit(None).cast("int")
    for i in sorted(range(len(rules)), key=lambda i: len(rules[i].host + rules[i].path)):
        r = rules[i]
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        out = F.when(fits, F.lit(i)).otherwise(out)
    return out


def parsed(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, ruled, links): all that is needed of a page."""
    number = rule_number(rules)
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("_rule"))
    links = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(HREF), F.lit(1)),
                                         lambda x: F.translate(x, UPPER, LOWER)))
    return (
        pages.select("page_id", host().alias("host"), path().alias("path"), links.alias("links"))
        .withColumn("_rule", number)
        .withColumn("rule", pick([r.host + r.path for r in rules]))
        .withColumn("ruled", pick([r.verdict for r in rules]))
        .drop("_rule")
    )


def seeds(pages: DataFrame) -> DataFrame:
    """(host, trust, distrust): shares of the host's pages under allow and block rules."""
    share = lambda v: F.avg(F.coalesce(F.col("ruled") == v, F.lit(False)).cast("double"))
    return pages.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, forward, backward): link weights, shares of the links out of src and into dst."""
    links = (
        pages.where("host <> ''").select(F.col("host").alias("src"), F.explode("links").alias("dst"))
        .where("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    )
    links = materialize(links, "host-links")
    out = links.groupBy("src").agg(F.sum("n").alias("n_out"))
    into = links.groupBy("dst").agg(F.sum("n").alias("n_in"))
    return links.join(out, "src").join(into, "dst").select(
        "src", "dst", (F.col("n") / F.col("n_out")).alias("forward"), (F.col("n") / F.col("n_in")).alias("backward"))


def scores(pages: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """(host, trust, distrust) after ``steps`` steps over the host links."""
    start = materialize(
        seeds(pages).select("host", ((1 - damping) * F.col("trust")).alias("trust0"),
                            ((1 - damping) * F.col("distrust")).alias("distrust0")), "host-seeds")
    now = start.select("host", F.col("trust0").alias("trust"), F.col("distrust0").alias("distrust"))
    links = materialize(host_links(pages), "host-weights")
    if links.isEmpty():  # nothing to spread over: each step gives the same ranks
        return now
    for step in range(1, steps + 1):
        sent = links.join(now, links["src"] == now["host"]).select(
            F.col("dst").alias("host"), (F.col("forward") * F.col("trust")).alias("t"), F.lit(0.0).alias("d"))
        back = links.join(now, links["dst"] == now["host"]).select(
            F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("backward") * F.col("distrust")).alias("d"))
        got = sent.union(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        value = lambda a, b: F.coalesce(a, F.lit(0.0)) + damping * F.coalesce(b, F.lit(0.0))
        now = start.join(got, "host", "full").select(
            "host", value("trust0", "t").alias("trust"), value("distrust0", "d").alias("distrust"))
        if step % STORE_EVERY == 0 or step == steps:
            now = materialize(now, "host-ranks")
    return now


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, damping: float = DAMPING, steps: int = STEPS,
           share: float = SHARE) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of each page."""
    seen = materialize(parsed(pages, rules), "pages")
    ranks = scores(seen, damping, steps).withColumnRenamed("host", "_host")
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") > (1 - damping) * share)
    method = F.when(blocked, "block").otherwise("allow")
    return seen.join(ranks, seen["host"] == ranks["_host"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")
