"""URL filters: rules by host and path, carried over to redirect aliases.

A url is judged by its own rule, if one fits.  Otherwise it takes part in the
redirect equivalence: pages name other urls as the same resource by
``<link rel="canonical">`` or a ``<meta http-equiv="refresh">`` redirect, and
urls that differ in their fragment only are one resource.  The connected
components of these links are classes of aliases; a class that holds a blocked
url and no explicitly allowed one blocks its other members.

All of it is DataFrame operations; the links, classes and verdicts stay
distributed tables.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duetto.llm.components import components


class Rule(NamedTuple):
    action: str      # "allow" or "block"
    host: str        # fits this host and its subdomains
    path: str        # fits paths that start so

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    with A-Z lower-cased; empty for null or a url without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest rule that fits, else null.  ``rules`` is a bounded
    list that becomes one expression; equally long rules apply in list order."""
    out = F.lit(None).cast("string")
    for r in reversed(sorted(rules, key=lambda r: -len(r.name))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.name)).otherwise(out)
    return out


def action_of(rule: Column, rules: list[Rule]) -> Column:
    """``allow`` or ``block`` for a rule's name, else null."""
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == r.name, F.lit(r.action)).otherwise(out)
    return out


def resource_of(url: Column) -> Column:
    """The url without its fragment and with its host and scheme in lower case;
    null if it has no ``://``."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    head = F.regexp_extract(bare, r"(?s)^(.*?://[^/?]*)", 1)
    return F.when(url.contains("://"),
                  F.concat(F.translate(head, _UPPER, _LOWER),
                           F.substring(bare, F.length(head) + 1, F.length(bare))))


def absolute(href: Column, base: Column) -> Column:
    """``href`` as it resolves against the page's url ``base``."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?):", 1)
    root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"(?s)[?#].*$", ""),
                              r"(?s)^(.*?://[^/]*(?:/.*)?)/[^/]*$", 1)
    folder = F.when(folder.contains("://"), folder).otherwise(root)
    href = F.replace(href, F.lit("&amp;"), F.lit("&"))
    return (F.when(href.contains("://"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(root, href))
            .when(href.startswith("#") | (href == ""), base)
            .when(href.startswith("?"), F.concat(F.regexp_replace(base, r"(?s)[?#].*$", ""), href))
            .otherwise(F.concat(folder, F.lit("/"), href)))


def alias_links(pages: DataFrame) -> DataFrame:
    """``src, dst``: links between resources that the pages declare, by all of
    their canonical and refresh tags."""
    found = pages.select(F.col("url").alias("u"), F.col("html").alias("h")).filter(
        "u is not null and h is not null").filter(
        F.col("h").rlike(r"(?i)\bcanonical\b|\brefresh\b"))
    target = F.explode(F.concat(F.regexp_extract_all("h", F.lit(_CANONICAL), F.lit(1)),
                                F.regexp_extract_all("h", F.lit(_REFRESH), F.lit(1))))
    return (found.select("u", target.alias("t")).filter("t <> ''")
            .select(resource_of(F.col("u")).alias("src"),
                    resource_of(absolute(F.col("t"), F.col("u"))).alias("dst"))
            .filter("src is not null and dst is not null and src <> dst").distinct())


def blocked_aliases(links: DataFrame, rules: list[Rule]) -> DataFrame:
    """``resource``: unruled members of classes that block their aliases."""
    cc = components(links.select(F.col("src").alias("u"), F.col("dst").alias("v")))
    rule = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)
    nodes = cc.select("node", "component", action_of(rule, rules).alias("act"))
    bad = (nodes.groupBy("component")
           .agg(F.max(F.expr("act = 'block'")).alias("block"),
                F.max(F.expr("act = 'allow'")).alias("allow"))
           .filter("coalesce(block, false) and not coalesce(allow, false)")
           .select("component"))
    return (nodes.filter("act is null").join(bad, "component", "left_semi")
            .select(F.col("node").alias("resource")))


def judge_urls(pages: DataFrame, rules: list[Rule] = RULES,
               links: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, alias_blocked`` for every page.

    ``pages`` has ``page_id, url`` and ``html``; further columns are ignored.
    ``links(src, dst)`` may add known redirects (urls) to those the pages
    declare.  A null url has an empty host and path, no rule and the verdict
    ``allow``.  Repeated rows are each judged; a page's links count however
    often the row occurs; an empty table gives an empty result.
    """
    declared = alias_links(pages)
    if links is not None:
        declared = declared.unionByName(links.select(
            resource_of(F.col("src")).alias("src"), resource_of(F.col("dst")).alias("dst")))
    bad = blocked_aliases(declared, rules).withColumnRenamed("resource", "bad")
    own = pages.select("page_id", host_of(F.col("url")).alias("host"),
                       path_of(F.col("url")).alias("path"),
                       resource_of(F.col("url")).alias("resource"))
    own = own.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    out = own.join(bad, own["resource"] == bad["bad"], "left")
    alias = F.col("rule").isNull() & F.col("bad").isNotNull()
    return out.select(
        "page_id", "host", "path", "rule",
        F.coalesce(action_of(F.col("rule"), rules),
                   F.when(alias, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        alias.alias("alias_blocked"))
