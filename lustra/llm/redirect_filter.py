"""URL filter with redirect equivalence, in DataFrame operations only.

Rules judge a url by host and path. Pages that redirect to each other, or name each
other as canonical, are aliases of one page: the connected components of these
links. A block reaches all aliases that no rule names; an explicit allow comes first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lustra.llm.components import connected_components
from lustra.llm.stored import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^(?s)(.*?)://([^/?#]*)([^?#]*)([^#]*)"


@dataclass(frozen=True)
class Rule:
    """Fits a host with all its subdomains where the path starts with ``path``."""

    allows: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules every url is judged by.
RULES = (
    Rule(False, "net", "/"),
    Rule(True, "example.net", "/en/"),
    Rule(False, "example.com", "/de/"),
    Rule(True, "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The name of the longest rule that fits, else NULL. Of equally long rules an allow, then the first by name."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), not r.allows, r.name))

    def fits(rule: Rule) -> Column:
        return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)

    return F.coalesce(*(F.when(fits(r), F.lit(r.name)) for r in ordered), F.lit(None).cast("string"))


def _with_parts(df: DataFrame, url: str) -> DataFrame:
    """Columns scheme, host, path and query of a url column."""
    return (
        df.withColumn("scheme", F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER))
        .withColumn("host", host_of(F.col(url)))
        .withColumn("path", path_of(F.col(url)))
        .withColumn("query", F.regexp_extract(url, _PARTS, 4))
    )


def _resolved(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments, to any depth; ``..`` at the root stays there."""
    segments = F.split(F.regexp_replace(path, r"(/\.\.?)\z", "$1/"), "/", -1)

    def step(kept: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", kept)
            .when(segment == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
            .otherwise(F.concat(kept, F.array(segment)))
        )

    kept = F.aggregate(F.slice(segments, F.lit(2), F.size(segments)), F.array().cast("array<string>"), step)
    dotted = path.rlike(r"/\.\.?(/|\z)")
    return F.when(dotted, F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def _node() -> Column:
    """From scheme, host, path and query: the url without fragment and dot segments; an empty path is ``/``.

    NULL without ``://``.
    """
    path = F.when(F.col("path") == "", F.lit("/")).otherwise(_resolved(F.col("path")))
    return F.when(F.col("scheme") != "", F.concat("scheme", F.lit("://"), "host", path, "query"))


def _target() -> Column:
    """The url that href leads to from the page with these parts."""
    href, site = F.col("href"), F.concat("scheme", F.lit("://"), "host")
    return (
        F.when((href == "") | href.startswith("#"), F.lit(None).cast("string"))
        .when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat("scheme", F.lit(":"), href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(href.startswith("?"), F.concat(site, F.col("path"), href))
        .otherwise(F.concat(site, F.lit("/"), F.regexp_replace("path", "^/|[^/]*$", ""), href))
    )


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute, with or without quotes; empty if there is none."""
    return F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*("|'|)(.*?)\1(?=[\s>]|/>)""", 2)


def declared_links(pages: DataFrame) -> DataFrame:
    """``a`` and ``b``: the nodes of each page and of the urls it redirects to or names as canonical.

    Relative links are put behind the page's folder; ``.`` and ``..`` are resolved in all nodes.
    """
    html, tag = F.col("html"), F.col("tag")
    tags = F.regexp_extract_all(html, F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), F.lit(1))
    telling = pages.filter(html.rlike(r"(?i)canonical|refresh") & F.col("url").contains("://")).select(
        "url", F.explode(tags).alias("tag")
    )
    # few rows; stored, as one generated method for all of these steps would be too large
    telling = stored(telling.filter(tag.rlike(r"(?i)canonical|refresh")).distinct(), "tags")
    goal = r"(?is)^\s*[\d.]*\s*[;,]?\s*url\s*=\s*[\"']?([^\"']*)"
    named = telling.select(
        "url",
        F.when(tag.rlike(r"(?is)^<link\b"), F.lower(_attribute(tag, "rel"))).alias("rel"),
        F.when(tag.rlike(r"(?is)^<meta\b"), F.lower(F.trim(_attribute(tag, "http-equiv")))).alias("equiv"),
        _attribute(tag, "href").alias("link"),
        F.regexp_extract(_attribute(tag, "content"), goal, 1).alias("goal"),
    )
    href = F.when(F.col("rel").rlike(r"(^|\s)canonical(\s|$)"), F.col("link")).when(
        F.col("equiv") == "refresh", F.col("goal")
    )
    leading = named.withColumn("href", F.trim(F.replace(href, F.lit("&amp;"), F.lit("&")))).filter("href IS NOT NULL")
    leading = stored(leading.select("url", "href"), "targets")
    ends = stored(_with_parts(leading, "url").select(_node().alias("a"), _target().alias("target")), "ends")
    pairs = _with_parts(ends, "target").select("a", _node().alias("b"))
    return pairs.filter(F.col("a") != F.col("b")).distinct()


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """Per row: page_id, host, path, rule (NULL if none fits), verdict and component (NULL without links).

    Needs ``page_id``, ``url`` and ``html``; further columns are ignored. Links are the
    canonical links and redirects that pages declare, and ``redirects`` (columns source
    and target, urls) if given. The verdict is the rule's; without a rule it is the
    component's: allow if a rule allows any of its urls, else block if one blocks any;
    else allow. Urls without a page count too. A component has the least of its urls as name.

    A NULL url or one without ``://`` has empty host and path, no rule and no links, and is
    allowed. Repeated rows get equal results. An empty table gives an empty result.
    """
    links = declared_links(pages)
    if redirects is not None:
        given = _with_parts(redirects.select("source", "target"), "source").select(_node().alias("a"), "target")
        links = links.unionByName(_with_parts(given, "target").select("a", _node().alias("b")).dropna())
    nodes = connected_components(links)
    allowing, blocking = ([r.name for r in rules if r.allows is x] for x in (True, False))
    rule = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)
    known = stored(nodes.withColumn("rule", rule), "nodes")

    def names(column: Column, of: list[str]) -> Column:
        return F.coalesce(column.isin(of), F.lit(False)) if of else F.lit(False)

    decided = known.groupBy("component").agg(
        F.max(names(F.col("rule"), allowing)).alias("allows"), F.max(names(F.col("rule"), blocking)).alias("blocks")
    )
    aliases = known.select("node", "component").join(decided, "component")
    judged = (
        _with_parts(pages.select("page_id", "url"), "url")
        .withColumn("node", _node())
        .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
        .join(aliases, "node", "left")
    )
    blocked = F.when(F.col("rule").isNotNull(), names(F.col("rule"), blocking)).otherwise(
        F.coalesce(F.col("blocks") & ~F.col("allows"), F.lit(False))
    )
    verdict = F.when(blocked, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "component")
