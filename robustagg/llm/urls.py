"""URL filter with redirect equivalence.

Rules (host, path, verdict) judge a url directly: a rule fits its host and all
subdomains if the url's path starts with the rule's; the longest host + path
wins (ties: the longer host, then allow before block). Urls without a rule take
the verdict of their redirect class: redirects (``<meta http-equiv=refresh>`` in
the page, or a given table of (src, dst) urls) and canonical links are edges
between urls, connected components are the classes, and a class with an
explicitly allowed url is allowed, else one with a blocked url is blocked.
A url in no class, or in a class without a ruled url, is allowed.

Urls are compared by host (A-Z lower-cased), path and query; scheme and
fragment do not count. Links that are relative resolve against the page's url.

Defined cases: null url or one without ``://`` has empty host and path, is
linked with nothing and is allowed; null or empty html has no links; repeated
rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from robustagg.sources.store import free_name

from .common import ascii_lower, components

_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_META = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_TO = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_key(url: Column) -> Column:
    """What urls are compared by; null without ``://``."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)?", 1)
    path = F.when(url_path(url) == "", F.lit("/")).otherwise(url_path(url))
    return F.when(url.contains("://"), F.concat(url_host(url), path, query))


def _resolve(link: Column, base: Column) -> Column:
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    return (F.when(link == "", None).when(link.contains("://"), link)
            .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), link))
            .when(link.startswith("/"), F.concat(site, link))
            .otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), link)))


def page_links(pages: DataFrame) -> DataFrame:
    """Redirect and canonical edges (a, b) between url keys found in the html."""
    canonical = F.regexp_extract(F.regexp_extract("html", _LINK, 0), _HREF, 1)
    refresh = F.regexp_extract(F.regexp_extract("html", _META, 0), _TO, 1)
    return (pages.where("url is not null and html is not null")
            .select("url", F.explode(F.array(canonical, refresh)).alias("link")).where("link <> ''")
            .select(url_key(F.col("url")).alias("a"), url_key(_resolve(F.col("link"), F.col("url"))).alias("b")))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null."""
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2]))
    fits = [F.when(((host == r[0]) | host.endswith("." + r[0])) & path.startswith(r[1]),
                   F.struct(F.lit(r[0] + r[1]).alias("rule"), F.lit(r[2]).alias("verdict"))) for r in order]
    return F.coalesce(*fits)


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """pages + host, path, rule, verdict, url_class (null outside any class).

    Other columns stay, whatever their names; those called like a result are
    replaced. ``rules`` is a short list written into the plan. ``redirects``: (src, dst).
    """
    for r in rules:
        if r[2] not in ("allow", "block"):
            raise ValueError(f"verdict of {r} is neither allow nor block")
    edges = page_links(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(url_key(F.col("src")).alias("a"), url_key(F.col("dst")).alias("b")))
    classes = components(edges)
    own = host, path, key, m = [free_name(pages, x) for x in ("host", "path", "key", "match")]
    found, verdict = (free_name(pages, x) for x in ("class", "class_verdict"))
    judged = (pages.withColumn(host, url_host(F.col("url"))).withColumn(path, url_path(F.col("url")))
              .withColumn(key, url_key(F.col("url")))
              .withColumn(m, matched_rule(F.col(host), F.col(path), rules)))
    # A class member need not be a page: rules are matched on the class's urls themselves.
    key_host, key_path = F.substring_index("id", "/", 1), F.regexp_extract("id", r"(?s)^[^/]*([^?]*)", 1)
    ruled = (classes.withColumn("v", matched_rule(key_host, key_path, rules)["verdict"])
             .groupBy("component").agg(F.min("v").alias(verdict)))  # allow < block
    member = (classes.join(ruled, "component")
              .select(F.col("id").alias(key), F.col("component").alias(found), verdict))
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "url_class")]
    return judged.select(*keep, *own).join(member, key, "left").select(
        *keep, F.col(host).alias("host"), F.col(path).alias("path"), F.col(m)["rule"].alias("rule"),
        F.coalesce(F.col(m)["verdict"], F.col(verdict), F.lit("allow")).alias("verdict"),
        F.col(found).alias("url_class"))
