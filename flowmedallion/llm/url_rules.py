"""URL filtering over redirect equivalence.

Addresses are nodes (host and what follows it, without scheme and fragment); a page is tied
to the address that its canonical link names and to the one that its refresh redirects to.
Addresses of one connected component are aliases.  A rule ``(verdict, host, path)`` fits its
host and all subdomains where the address's path starts with the rule's; the longest rule
wins (allow among equals, then the first in order).  An address that a rule fits has that
rule's verdict.  Any other takes its component's: allow if some alias is allowed by a rule,
block if some alias is blocked, and allow if no alias has a rule.

Rules meet addresses in a join on host suffixes, so any number of rules will do.  A null
address, or one without ``://``, has an empty host and path, fits no rule and no alias, and
is allowed.  Repeated rows and ids come back repeated; links without an address count for
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmedallion.llm.components import components, store

Rule = tuple[str, str, str]
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """The address's node; null where it has no host."""
    rest = F.regexp_extract(after_scheme(url), r"^[^/?#]*([^#]*)", 1)
    full = F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(host_of(url) != "", F.concat(host_of(url), full))


def resolved(link: Column, base: Column) -> Column:
    """A link as an absolute address, seen from the page at ``base``; null if it is empty."""
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(base, r"^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    return (
        F.when(link == "", F.lit(None))
        .when(F.contains(link, F.lit("://")), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``url, target``: canonical links and refresh redirects of pages, the first of each kind."""
    base = F.col(f"`{url}`")
    canonical = F.regexp_extract(F.regexp_extract(F.col(f"`{html}`"), CANONICAL, 0), HREF, 1)
    refresh = F.regexp_extract(F.regexp_extract(F.col(f"`{html}`"), REFRESH, 0), TARGET, 1)
    targets = F.array(resolved(canonical, base), resolved(refresh, base))
    return pages.select(base.alias("url"), F.explode(F.array_compact(targets)).alias("target"))


def fitting_rules(addresses: DataFrame, rules: list[Rule]) -> DataFrame:
    """For distinct ``host, path`` that some rule fits: ``rule`` and ``told``, its verdict."""
    spark: SparkSession = addresses.sparkSession
    table = spark.createDataFrame(rules, "told string, rule_host string, rule_path string")
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = (
        addresses.select("host", "path").distinct()
        .withColumn("rule_host", F.explode(tails))
        .join(table, "rule_host")
        .filter(F.startswith("path", "rule_path"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
    )
    order = F.struct(-F.length("rule"), F.col("told"), F.col("rule"))  # allow sorts before block
    return found.groupBy("host", "path").agg(F.min_by(F.struct("rule", "told"), order).alias("r")).select("host", "path", "r.*")


def judge_urls(pages: DataFrame, links: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """``key, host, path, rule, verdict`` for every row of pages; ``links`` has ``url, target``.

    Pages of one host and path share a rule; rows of one address are one node.
    """
    address = F.col(f"`{url}`")
    rows = pages.select(
        F.col(f"`{key}`").alias(key), F.coalesce(host_of(address), F.lit("")).alias("host"),
        F.coalesce(path_of(address), F.lit("")).alias("path"), node_of(address).alias("node"),
    )
    tied, _ = store(
        links.filter("url is not null and target is not null")
        .select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b"), host_of(F.col("target")).alias("host"),
                path_of(F.col("target")).alias("path"))
        .filter("a is not null and b is not null").distinct(),
        "links",
    )
    roots = components(tied)
    places = rows.select("host", "path", "node").unionByName(tied.select("host", "path", F.col("b").alias("node")))
    told = fitting_rules(places, rules)
    named = places.filter("node is not null").distinct().join(roots, "node").join(told, ["host", "path"])
    group = named.groupBy("root").agg(F.min("told").alias("group_told"))  # allow before block
    shared = roots.join(group, "root").select("node", "group_told")
    return (
        rows.join(told, ["host", "path"], "left")
        .join(shared, "node", "left")
        .select(key, "host", "path", "rule", F.coalesce("told", "group_told", F.lit("allow")).alias("verdict"))
    )
