"""URL filters: rules of host and path, and trust and distrust that spread over the links between hosts.

A rule such as ``example.net/en/`` fits the urls of its host and all subdomains whose path starts with the rule's; the
longest rule that fits decides. What no rule decides is decided by the host:

1. Hosts more than half of whose pages are allowed by rules are trusted seeds, those with more than half blocked are
   blocked seeds.
2. An edge from host to host is counted once for each page that links to the other host.
3. Trust is a personalised PageRank from the trusted seeds along the edges, distrust one from the blocked seeds against
   them: who links to a distrusted host is distrusted. Both are summed round by round (``ROUNDS``); a round moves only
   what the last one has passed on. Amounts are whole numbers of ``UNITS``, rounded down, so that they don't depend on
   the order of tasks. What reaches a host without edges goes no further: that changes a PageRank by a common factor only.
4. A host is blocked if its share of all distrust is at least ``LIFT`` times that of an average host and more than its
   share of all trust.

Nodes and edges stay in tables; each round is one join and one grouped sum, whose hot keys AQE can split.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import materialised

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
UNITS = 10**15
#: Percent of its amount that a host passes on, and how often (0.85**40 is 0.0015).
DAMPING, ROUNDS = 85, 40
LIFT = 1
#: Comments, scripts and style sheets hold no links; target of each ``<a href``; host of one that leads to another host.
NO_LINKS = r"(?is)<!--.*?-->|<script[^>]*>.*?</script[^>]*>|<style[^>]*>.*?</style[^>]*>"
LINK = r"""(?i)<a[\x09-\x0D\x20](?:[^>]*?[\x09-\x0D\x20"'])?href[\x09-\x0D\x20]*=[\x09-\x0D\x20]*["']?[\x09-\x0D\x20]*([^\x09-\x0D\x20"'>]+)"""
LINK_HOST = "(?i)^(?:https?:)?//([^/?#]*)"
URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty if there is none."""
    return _lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path(url: Column) -> Column:
    """From behind the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _by_length(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Longest first; of equally long ones the longer host, then the earlier in the list."""
    for verdict, rule in rules:
        if verdict not in ("allow", "block") or "/" not in rule or rule.startswith("/"):
            raise ValueError(f"no rule: {verdict} {rule}")
    return sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/")))


def with_rule(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``pages`` (with host and path) and ``rule``, the longest that fits, or null. The list of rules is a constant of the plan."""
    fits = F.lit(None).cast("string")
    for _, rule in reversed(_by_length(rules)):
        own, start = rule.split("/", 1)
        on_host = (F.col("host") == own) | F.col("host").endswith(f".{own}")
        fits = F.when(on_host & F.col("path").startswith(f"/{start}"), rule).otherwise(fits)
    return pages.withColumn("rule", fits)


def _rule_verdict(rules: list[tuple[str, str]]) -> Column:
    verdict = F.lit(None).cast("string")
    for kind, rule in reversed(_by_length(rules)):
        verdict = F.when(F.col("rule") == rule, kind).otherwise(verdict)
    return verdict


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, pages): how many pages of host src link to the other host dst."""
    clean = F.regexp_replace(html_col, NO_LINKS, " ")
    targets = F.transform(F.regexp_extract_all(clean, F.lit(LINK), F.lit(1)), lambda a: _lower(F.regexp_extract(a, LINK_HOST, 1)))
    found = pages.select(host(F.col(url_col)).alias("src"), F.explode(F.array_distinct(targets)).alias("dst"))
    return found.filter("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("pages"))


def spread(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING) -> DataFrame:
    """(host, trust, distrust): amounts that the seeds (side, host, amount) bring to each host; side 0 goes along the edges, 1 against them."""
    arcs = edges.select(F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("src").alias("a"), F.col("dst").alias("b"), "pages"), F.struct(F.lit(1).alias("side"), F.col("dst").alias("a"), F.col("src").alias("b"), "pages"))).alias("e"))
    arcs = materialised(arcs.select("e.*"))
    out = materialised(arcs.groupBy("side", F.col("a").alias("host")).agg(F.sum("pages").alias("total")))
    now = materialised(seeds.select("side", "host", "amount"))
    every = now
    for _ in range(rounds):
        passed = now.join(out, ["side", "host"]).select("side", F.col("host").alias("a"), "total", F.expr(f"amount * {damping} div 100").alias("x"))
        # x * pages div total, without passing 64 bits
        part = F.expr("(x div total) * pages + (x % total) * pages div total")
        moved = passed.join(arcs, ["side", "a"]).select("side", F.col("b").alias("host"), part.alias("amount"))
        now = materialised(moved.groupBy("side", "host").agg(F.sum("amount").alias("amount")).filter("amount > 0"))
        if now.isEmpty():
            break
        every = every.unionAll(now)
    return every.groupBy("host").agg(*(F.sum(F.when(F.col("side") == k, F.col("amount")).otherwise(0)).alias(name) for k, name in enumerate(("trust", "distrust"))))


def judge(
    pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rounds: int = ROUNDS, damping: int = DAMPING, lift: int = LIFT
) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``trust``, ``distrust``.

    Host and path are empty for a null url or one without ``://``; no rule fits an empty host, and an empty path starts
    like no rule's, not even ``net/``. Urls without a host are no part of the link graph and are allowed, as is every
    host that neither trust nor distrust reaches. Null and empty pages have no links; relative links and those within
    a host are no edges. Repeated rows are each returned and each count. Null ids are kept. Other columns are
    ignored. An empty table gives an empty result. The two amounts are those of the host, 0 for none.
    """
    rows = with_rule(pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path")), rules).withColumn("by_rule", _rule_verdict(rules))
    kinds = [F.count(F.when(F.col("by_rule") == kind, 1)).alias(kind) for kind in ("allow", "block")]
    hosts = materialised(rows.filter("host <> ''").groupBy("host").agg(F.count("*").alias("pages"), *kinds))
    sides = F.when(F.col("allow") * 2 > F.col("pages"), 0).when(F.col("block") * 2 > F.col("pages"), 1)
    seeds = hosts.select(sides.alias("side"), "host").filter("side is not null")
    n_hosts, *n_seeds = hosts.agg(F.count("*"), F.count(F.when(sides == 0, 1)), F.count(F.when(sides == 1, 1))).first()
    amount = F.when(F.col("side") == 0, UNITS // max(1, n_seeds[0])).otherwise(UNITS // max(1, n_seeds[1]))
    scores = materialised(spread(links(pages, url_col, html_col), seeds.withColumn("amount", amount.cast("long")), rounds, damping))
    all_trust, all_distrust = (max(1, x or 0) for x in scores.agg(F.sum("trust"), F.sum("distrust")).first())

    def wide(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    def exactly(n: int) -> Column:
        return F.lit(n).cast("decimal(19,0)")

    blocked = (wide("distrust") * exactly(n_hosts) >= exactly(lift) * exactly(all_distrust)) & (wide("distrust") * exactly(all_trust) > wide("trust") * exactly(all_distrust))
    scores = scores.join(hosts.select("host"), "host", "left_semi").select("host", "trust", "distrust", blocked.alias("blocked"))
    verdict = F.coalesce("by_rule", F.when(F.col("blocked"), "block").otherwise("allow"))
    amounts = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("trust", "distrust")]
    return rows.join(scores, "host", "left").select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), *amounts)
