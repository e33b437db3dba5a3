"""URL filters that follow redirects: block decisions spread over the aliases of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailprep.llm.common import components

CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # verdict, host, path


def _cut(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(_cut(url, r"(?s)^.*?://([^/?#]*)"), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return _cut(url, r"(?s)^.*?://[^/?#]*([^?#]*)")


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule (host plus path) that fits, as a struct (rule, verdict), or null. Of equals, allow goes first."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0]))
    return F.coalesce(*[
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in order], F.lit(None).cast("struct<rule:string,verdict:string>"))


def _node(url: Column) -> Column:
    """A page's identity: scheme and host in lower case, no fragment. Null stays null."""
    bare = F.regexp_replace(url, r"(?s)#.*", "")
    return F.when(bare.contains("://"),
                  F.concat(F.translate(_cut(bare, r"(?s)^(.*?://[^/?#]*)"), UPPER, LOWER),
                           _cut(bare, r"(?s)^.*?://[^/?#]*(.*)"))).otherwise(bare)


def _resolved(link: Column, base: Column) -> Column:
    """A link as a full URL: with a scheme, with a host only, from the root, or beside the page."""
    scheme, root = _cut(base, r"(?s)^(.*?:)//"), _cut(base, r"(?s)^(.*?://[^/?#]*)")
    folder = _cut(base, r"(?s)^(.*?://[^/?#]*/(?:[^?#]*/)?)")
    return (F.when(link.contains("://"), link).when(link.startswith("//"), F.concat(scheme, link))
            .when(link.startswith("/"), F.concat(root, link))
            .otherwise(F.concat(F.when(folder == "", F.concat(root, F.lit("/"))).otherwise(folder), link)))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (a, b) from a page to the target of its canonical link and of its refresh redirect, without self-links.

    Pages without a URL or HTML have none.
    """
    links = F.array_union(F.regexp_extract_all(F.col(html), F.lit(CANONICAL), F.lit(1)),
                          F.regexp_extract_all(F.col(html), F.lit(REFRESH), F.lit(1)))
    a, b = _node(F.col(url)), _node(_resolved(F.replace(F.col("link"), F.lit("&amp;"), F.lit("&")), F.col(url)))
    return (pages.select(F.col(url), F.explode(links).alias("link")).select(a.alias("a"), b.alias("b"))
            .filter("a is not null and b is not null and a != b").distinct())


def judge_urls(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None, key: str = "page_id",
               url: str = "url", html: str = "html") -> DataFrame:
    """Verdict of every page: its own rule's; else its aliases', where an explicit allow goes before a block; else allow.

    Aliases are the connected component over canonical links, refresh redirects and ``redirects`` (a, b), if given.
    Targets that are no pages count with the rule that fits their URL. Returns (key, host, path, rule, verdict,
    component, alias_verdict), one row per input row; repeated rows stay, null or odd URLs have empty host and path.
    Empty tables give no rows. Only rows of linked URLs meet in a join; the rest keep a null component.
    """
    edges = alias_edges(pages, url, html)
    if redirects is not None:
        edges = edges.union(redirects.select(_node(F.col("a")), _node(F.col("b"))))
    groups = components(edges, "aliases")
    judged = groups.select("node", "component", rule_of(host(F.col("node")), path(F.col("node")), rules)["verdict"]
                           .alias("own"))
    verdicts = judged.groupBy("component").agg(
        F.when(F.max(F.col("own") == "allow"), "allow").when(F.max(F.col("own") == "block"), "block")
        .alias("alias_verdict"))
    aliases = groups.join(verdicts, "component")
    out = pages.select(F.col(key), F.col(url).alias("_url"), _node(F.col(url)).alias("_node"))
    out = out.join(aliases, out["_node"] == aliases["node"], "left")
    h, p = host(F.col("_url")), path(F.col("_url"))
    return (out.select(F.col(key), h.alias("host"), p.alias("path"), "component", "alias_verdict")
            .withColumn("_r", rule_of(F.col("host"), F.col("path"), rules))
            .select(key, "host", "path", F.col("_r.rule").alias("rule"),
                    F.coalesce(F.col("_r.verdict"), "alias_verdict", F.lit("allow")).alias("verdict"),
                    "component", "alias_verdict"))
