"""URL filters with redirect equivalence (DataFrame functions only).

A url is judged by the longest rule (host, path) that fits.  Pages that declare
a canonical address or redirect by a refresh header are aliases of the address
they name: the edges between them are closed to components (joins and
aggregations, see ``components``), and a url without a rule of its own takes its
component's verdict - allow if any alias is explicitly allowed, else block if
any is blocked, else allow.  An alias need not be a page of the table.

Two urls are one node if they agree in host, path and query; scheme and
fragment do not count.  Only edge ends enter the components; a page meets its
component's verdict by an equi-join on the node, left to AQE.

Defined results: null url or no ``://``: empty host and path, no rule, allow; null html: no
edges; unreadable or empty link targets are ignored; repeated rows are judged
alike; two rules of equal length cannot both fit unless equal; empty table: no
rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import ascii_lower, col, stored

#: (host/path, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

CANONICAL = r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH_URL = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Host of a url, A-Z lower-cased (null or no ``://``: empty)."""
    return ascii_lower(F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """Path of a url, up to its query or fragment."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """Host, path and query: what two addresses of one resource share."""
    tail = F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^#]*)", 1)
    return F.concat(host_of(url), tail)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, at, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(at + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def verdict_of(rule: Column, rules=RULES) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules:
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def _with_absolute(links: DataFrame) -> DataFrame:
    """Adds ``to``: the link ``target`` against the page's own ``url``; null if it names no web address."""
    t = F.col("t")
    parts = links.withColumns({
        "t": F.trim(F.replace("target", F.lit("&amp;"), F.lit("&"))),
        "host": host_of(F.col("url")), "scheme": F.substring_index("url", "://", 1),
        "folder": F.regexp_extract(path_of(F.col("url")), r"^(.*/)?[^/]*$", 1)})
    site = F.concat("scheme", F.lit("://"), "host")
    return parts.withColumn("to", F.when(t.rlike(r"(?i)^https?://[^/?#]"), t)
                            .when(t.startswith("//"), F.concat(F.lit("http:"), t))
                            .when((t == "") | t.startswith("#") | t.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None))
                            .when(t.startswith("/"), F.concat(site, t))
                            .otherwise(F.concat(site, F.when(F.col("folder") == "", "/").otherwise(F.col("folder")), t)))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b) nodes that a page's canonical link or refresh redirect makes equivalent."""
    link = F.regexp_extract(F.regexp_extract("html", CANONICAL, 0), HREF, 1)
    hop = F.regexp_extract(F.regexp_extract("html", REFRESH, 0), REFRESH_URL, 1)
    tagged = (pages.select(col(url).alias("url"), col(html).alias("html"))
              .where("instr(url, '://') > 0").where(F.col("html").rlike(r"(?i)\b(canonical|refresh)\b")))
    targets = tagged.select("url", F.explode(F.array(link, hop)).alias("target")).where("target <> ''")
    targets = stored(_with_absolute(targets).where("`to` is not null").select("url", "to"), "targets")
    return (targets.select(node_of(F.col("url")).alias("a"), node_of(F.col("to")).alias("b"))
            .where("a <> '' and b <> '' and a <> b"))


def alias_verdicts(edges: DataFrame, rules=RULES) -> DataFrame:
    """(node, alias_verdict) of every node with an alias: explicit allow before block."""
    groups = connected_components(edges, "a", "b")
    as_url = F.concat(F.lit("http://"), F.col("node"))
    ruled = stored(groups.withColumn("said", verdict_of(rule_of(host_of(as_url), path_of(as_url), rules), rules)),
                   "aliases")
    said = ruled.groupBy("component").agg(F.max(F.col("said") == "allow").alias("allowed"),
                                          F.max(F.col("said") == "block").alias("blocked"))
    verdict = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").otherwise("allow")
    return ruled.join(said.withColumn("alias_verdict", verdict), "component").select("node", "component", "alias_verdict")


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, component (null: no alias), verdict."""
    judged = pages.select(col(page_id).alias("page_id"), host_of(col(url)).alias("host"), path_of(col(url)).alias("path"),
                          node_of(col(url)).alias("node"))
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    aliases = alias_verdicts(alias_edges(pages, url, html), rules)
    return judged.join(aliases, "node", "left").select(
        "page_id", "host", "path", "rule", "component",
        F.coalesce(verdict_of(F.col("rule"), rules), "alias_verdict", F.lit("allow")).alias("verdict"))
