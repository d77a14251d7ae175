"""URL filtering by rules, and by trust and distrust that links spread between hosts.

A url that a rule fits has the rule's verdict.  For the others, trust starts at
hosts that the rules mostly allow and follows links (personalised PageRank);
distrust starts at hosts that they mostly block and goes against the links: who
links to blocked hosts is suspect.  A host with more distrust than trust is
blocked, any other host is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.tables import LOWER, UPPER, written

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
ALLOW, BLOCK = "allow", "block"
MAX_RULES = 10_000
#: Below a country's label these are no owner's; a list of fixed size, not the whole public suffix list.
SECOND_LEVEL = ("ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "ne", "net", "nom", "or", "org")


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host and its subdomains if a path starts with ``/path``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; equal length: block first."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.verdict == BLOCK)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        value = F.struct(F.lit(rule.pattern).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits & path.startswith(rule.path), value).otherwise(found)
    return found


def levels(host: Column) -> Column:
    """The steps from a host up to its registered domain, as an array of src and dst.

    The first step takes off user and port.  A registered domain has two labels, or
    three below a country's own second level (``SECOND_LEVEL``).  Addresses have none.
    """
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    labels = F.split(name, r"\.")
    n = F.size(labels)
    country = (F.length(F.get(labels, n - 1)) == 2) & F.get(labels, n - 2).isin(list(SECOND_LEVEL))
    steps = F.greatest(n - F.when(country, 3).otherwise(2), F.lit(0))
    names = F.transform(
        F.sequence(F.lit(0), steps), lambda i: F.array_join(F.slice(labels, i + 1, n), ".")
    )
    chain = F.when(name == host, names).otherwise(F.concat(F.array(host), names))
    pairs = F.transform(
        F.slice(chain, 1, F.size(chain) - 1),
        lambda x, i: F.struct(x.alias("src"), F.get(chain, i + 1).alias("dst")),
    )
    address = name.rlike(r"^[0-9.]*$") | name.contains("[")
    return F.when(~address, pairs)


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Distinct links between different hosts: ``src``, ``dst`` and the number of links.

    Links without a host stay on their own and don't count.  Every host counts as
    linked once in each direction with the domain it hangs under, and so on up
    to the registered domain, as one owner runs them all; these domains are
    nodes whether or not a page is on them.
    """
    links = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), 1)
    absolute = F.filter(links, lambda x: x.contains("//"))
    full = F.transform(absolute, lambda x: F.when(x.startswith("//"), F.concat(F.lit("http:"), x)).otherwise(x))
    found = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(full).alias("link"))
    hosts = found.select("src", host_of(F.col("link")).alias("dst"))
    real = hosts.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    own = pages.select(host_of(F.col(url_col)).alias("src")).distinct()
    family = own.select(F.explode(levels(F.col("src"))).alias("_step")).select("_step.*").distinct()
    real = real.unionByName(family).unionByName(family.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return real.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def spread(seeds: DataFrame, links: DataFrame, rounds: int = 12, damping: float = 0.85) -> DataFrame:
    """Trust along the links and distrust against them: kind, host, score.

    ``seeds`` has kind (allow or block), host and a start that sums to 1 per kind.
    Links with counts are shared out by count.  Each round joins the scores with
    the links and sums per host, partly before the shuffle, so that a host with
    very many links costs a row per task.
    """
    out = links.groupBy("src").agg(F.sum("links").alias("total"))
    into = links.groupBy("dst").agg(F.sum("links").alias("total"))
    share = (F.col("links") / F.col("total")).alias("share")
    ways = links.join(out, "src").select(
        F.lit(ALLOW).alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), share
    ).unionByName(links.join(into, "dst").select(
        F.lit(BLOCK).alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), share
    ))
    ways = written(ways, "link-shares")
    start = seeds.select("kind", "host", (F.col("start") * (1 - damping)).alias("score"))
    scores = start
    for i in range(rounds):
        sent = scores.join(ways, ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), (F.col("score") * F.col("share") * damping).alias("score")
        )
        scores = sent.unionByName(start).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if i % 4 == 3:
            scores = written(scores, "host-scores")
    return scores


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html", rounds: int = 12, damping: float = 0.85, threshold: float = 0.5,
) -> DataFrame:
    """The verdict on every url: page_id, host, path, rule, verdict, trust, distrust.

    Hosts are seeds of both kinds, by the share of their urls that rules allow and
    block.  ``rule`` is null where none fits; then a host is blocked if distrust is more
    than ``threshold`` of its trust and distrust together.  A null url or one
    without ``://`` has empty host and path and is allowed unless a rule fits.
    One row per row of ``pages``, repeated rows included; null html has no links; an empty table gives no rows.
    """
    judged = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    ).withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    hosts = judged.where(F.col("host") != "").groupBy("host").agg(
        F.count(F.lit(1)).alias("urls"),
        F.count_if(F.col("found.verdict") == ALLOW).alias("allowed"),
        F.count_if(F.col("found.verdict") == BLOCK).alias("blocked"),
    )
    kinds = hosts.select("host", F.inline(F.array(
        F.struct(F.lit(ALLOW).alias("kind"), (F.col("allowed") / F.col("urls")).alias("part")),
        F.struct(F.lit(BLOCK).alias("kind"), (F.col("blocked") / F.col("urls")).alias("part")),
    ))).where("part > 0")
    totals = kinds.groupBy("kind").agg(F.sum("part").alias("total"))
    seeds = written(
        kinds.join(F.broadcast(totals), "kind")  # one row per kind
        .select("kind", "host", (F.col("part") / F.col("total")).alias("start")),
        "host-seeds",
    )
    links = written(host_links(pages, url_col, html_col), "host-links")
    scores = spread(seeds, links, rounds, damping)
    by_host = scores.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == ALLOW, F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == BLOCK, F.col("score")).otherwise(0.0)).alias("distrust"),
    )
    known = judged.join(by_host, "host", "left")
    trust, distrust = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust"))
    by_links = F.when(distrust > threshold * (trust + distrust), BLOCK).otherwise(ALLOW)
    return known.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), by_links).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
