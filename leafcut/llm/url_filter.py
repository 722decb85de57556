"""Web address rules with redirect equivalence.

A page's address, its redirect targets and its canonical address are aliases: connected components over these links,
computed distributed, carry a block to every alias. A rule on the page itself decides first. Otherwise a component that
holds an explicitly allowed address is allowed, else one that holds a blocked address is blocked, else the page is allowed.

Targets may be relative in any form: they are resolved against the page's own address, after character references are
decoded. Dot segments go from targets without a host; addresses with one name their node as they stand.

Defined results: a null address or one without :// has empty host and path, is an alias of nothing and is allowed; null
html has no links, nor have comments; of several base addresses the first counts; a tag whose quote is not closed is not read; long html is read whole; rows that repeat an address share its verdict; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from leafcut.llm.common import attach, components, stage, unstage

#: (verdict, host, path prefix). A rule fits its host and all subdomains; the longest rule wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

#: A comment, or a tag up to its end, which no quoted value can hold. Each part is matched once and not again, so malformed pages take no longer.
_TAG = r"""(?is)<!--.*?(?:-->|\z)|<(?:link|meta|base)\b[^<>"']*+(?:(?:"[^"]*"|'[^']*')[^<>"']*+)*+>"""
#: A rel attribute that has canonical among its tokens.
_CANONICAL = r"""(?i)[\s"'/]rel\s*=\s*(?:"(?:[^"]*\s)?canonical(?:\s[^"]*)?"|'(?:[^']*\s)?canonical(?:\s[^']*)?'|canonical[\s/>])"""
#: What a refresh's content says after its delay.
_REFRESH = r"""(?is)^\s*[0-9.]*\s*(?:[;,]|\s)\s*(?:url\s*=\s*)?["']?([^"']*)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host followed by path, and its verdict; null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def address(url: Column) -> Column:
    """What names a node: the address without its fragment, host in lower case; null without ://."""
    whole = F.regexp_extract(url, r"(?s)^(.*?)://[^/?#]*", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(F.translate(whole, _UPPER, _LOWER), F.lit("://"), host_of(url), F.when(rest == "", "/").otherwise(rest)))


@F.pandas_udf(StringType())
def decoded(values: pd.Series) -> pd.Series:
    """Character references of an attribute value decoded; only values with an ampersand arrive here not null."""
    return values.map(lambda x: html.unescape(x).strip() if x is not None else None)


def without_dots(path: Column) -> Column:
    """A path that starts with / without its . and .. segments."""
    parts = F.split(path, "/", -1)
    step = lambda done, x: F.when(x == ".", done).when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.concat(done, F.array(x)))
    kept = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")), step)
    ends = path.rlike(r"/\.\.?$")
    out = F.concat(F.array_join(kept, "/"), F.when(ends, "/").otherwise(""))
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.when(out == "", "/").otherwise(out)).otherwise(path)


def resolved(url: Column, t: Column) -> Column:
    """A target made absolute against the address of its page; null for targets of schemes without //."""
    scheme, site = F.regexp_extract(url, r"(?s)^(.*?:)//", 1), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    path = F.when(path == "", "/").otherwise(path)
    own, more = F.regexp_extract(t, r"(?s)^([^?#]*)", 1), F.regexp_extract(t, r"(?s)^[^?#]*(.*)$", 1)
    return (
        F.when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t)
        .when(t.startswith("//"), F.concat(scheme, t))
        .when(t.startswith("/"), F.concat(site, without_dots(own), more))
        .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(t.startswith("#"), F.concat(site, rest, t))
        .when(t.startswith("?"), F.concat(site, path, t))
        .otherwise(F.concat(site, without_dots(F.concat(F.regexp_extract(path, r"(?s)^(.*/)", 1), own)), more))
    )


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value as it stands, without quotes and the white space around it; empty if there is none."""
    at = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>]+))"""
    return F.regexp_replace(F.concat(*(F.regexp_extract(tag, at, k) for k in (1, 2, 3))), r"^\s+|\s+$|[\t\r\n]", "")


def _plain(name: str) -> Column:
    """A column with its character references decoded."""
    coded = F.contains(name, F.lit("&"))
    return F.when(coded, decoded(F.when(coded, F.col(name)))).otherwise(F.col(name))


def alias_links(pages: DataFrame) -> DataFrame:
    """(url, target): canonical links and immediate redirects that a page's html declares, made absolute against its base address if it names one, else against its own."""
    tags = F.filter(F.regexp_extract_all(F.col("html"), F.lit(_TAG), F.lit(0)), lambda t: ~F.startswith(t, F.lit("<!")))
    found = pages.filter(F.col("html").rlike("(?i)canonical|refresh") & (F.instr("url", "://") > 0)).select("url", tags.alias("_tags"))
    found = found.filter(F.size("_tags") > 0).withColumn("_base", F.get(F.filter("_tags", lambda t: t.rlike(r"(?i)^<base\b.*?\bhref")), F.lit(0)))
    links = found.select("url", "_base", F.explode("_tags").alias("_tag")).filter(F.col("_tag").rlike("(?i)canonical|refresh"))
    tag = F.col("_tag")
    # Each step is a column of its own, so that no later one holds it several times over.
    links = links.select("url", "_base", F.when(tag.rlike(_CANONICAL), attribute(tag, "href")).alias("_href"), F.when(tag.rlike(r"""(?i)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""), attribute(tag, "content")).alias("_content"))
    links = links.select("url", attribute(F.coalesce("_base", F.lit("")), "href").alias("_base"), F.coalesce("_href", F.trim(F.regexp_extract("_content", _REFRESH, 1))).alias("_t")).filter("_t <> ''")
    links = stage(links.select("url", _plain("_base").alias("_base"), _plain("_t").alias("_t")), "declared")
    if links.filter("_base <> ''").isEmpty():
        return links.select("url", resolved(F.col("url"), F.col("_t")).alias("target")).filter("target IS NOT NULL AND instr(target, '://') > 0")
    links = links.select("url", F.when(F.col("_base") == "", F.col("url")).otherwise(F.coalesce(resolved(F.col("url"), F.col("_base")), F.col("url"))).alias("_from"), "_t")
    return links.select("url", resolved(F.col("_from"), F.col("_t")).alias("target")).filter("target IS NOT NULL AND instr(target, '://') > 0")


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. redirects: further links (url, target), such as a crawler's log."""
    p = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = p.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumns({"rule": rule, "own": verdict})
    links = alias_links(p)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    links = stage(links.select(address(F.col("url")).alias("a"), address(F.col("target")).alias("b")).filter("a <> b").distinct(), "links")
    if links.isEmpty():
        return ruled.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict"))
    node = stage(components(links, "a", "b"), "aliases")
    # Rules are judged for every alias, targets that are not pages included.
    _, by = rule_for(host_of(F.col("node")), path_of(F.col("node")), rules)
    told = node.withColumn("by", by).groupBy("component").agg(F.max(F.col("by") == "allow").alias("allowed"), F.max(F.col("by") == "block").alias("blocked"))
    sized = node.join(told, "component").select(F.col("node").alias("_node"), F.when(F.coalesce("allowed", F.lit(False)), "allow").when(F.col("blocked"), "block").otherwise("allow").alias("_alias"))
    rows = ruled.withColumn("_node", address(F.col("url")))
    open_, rest = rows.filter("own IS NULL AND _node IS NOT NULL"), rows.filter("own IS NOT NULL OR _node IS NULL")
    sized = stage(sized.join(open_.groupBy("_node").agg(F.count("*").alias("_n")), "_node"), "verdicts")
    met = attach(open_, sized, "_node", "_n", max(1, p.count()))
    return met.select("page_id", "host", "path", "rule", F.coalesce("_alias", F.lit("allow")).alias("verdict")).unionByName(rest.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict")))


SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, coalesce(html, '') AS html,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(kind, h, pre) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*>')) AS tag FROM p),
aims AS (SELECT url, CASE WHEN regexp_matches(tag, '(?i)\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1) END AS t FROM tags),
full_ AS (SELECT url, CASE WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || t WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || t ELSE t END AS target FROM aims WHERE t <> ''),
ends AS (SELECT url AS x, target AS y FROM full_ WHERE contains(target, '://') AND contains(url, '://')),
urls AS (SELECT url FROM p WHERE contains(url, '://') UNION SELECT y FROM ends),
named AS (SELECT url, lower(regexp_extract(url, '(?s)^(.*?)://[^/?#]*', 1)) || '://' || translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || CASE regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) WHEN '' THEN '/' ELSE regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS node FROM urls),
edges AS (SELECT a.node AS u, b.node AS v FROM ends JOIN named a ON a.url = x JOIN named b ON b.url = y WHERE a.node <> b.node),
both_ AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
reach(u, v) AS (SELECT u, v FROM both_ UNION SELECT r.u, b.v FROM reach r JOIN both_ b ON r.v = b.u),
best AS (SELECT q.host, q.path, arg_max(h || pre, length(h || pre)) AS rule, arg_max(kind, length(h || pre)) AS kind
    FROM (SELECT host, path FROM p UNION SELECT translate(regexp_extract(v, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), regexp_extract(v, '(?s)^.*?://[^/?#]*([^?#]*)', 1) FROM reach) q
    JOIN rules ON (q.host = h OR ends_with(q.host, '.' || h)) AND starts_with(q.path, pre) GROUP BY q.host, q.path),
told AS (SELECT r.u, bool_or(b.kind = 'allow') AS allowed, bool_or(b.kind = 'block') AS blocked FROM reach r
    JOIN best b ON b.host = translate(regexp_extract(r.v, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AND b.path = regexp_extract(r.v, '(?s)^.*?://[^/?#]*([^?#]*)', 1) GROUP BY r.u)
SELECT page_id, p.host, p.path, b.rule, CASE WHEN b.kind IS NOT NULL THEN b.kind WHEN t.allowed THEN 'allow' WHEN t.blocked THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN best b ON b.host = p.host AND b.path = p.path LEFT JOIN (SELECT DISTINCT url, node FROM named) n ON n.url = p.url LEFT JOIN told t ON t.u = n.node
"""
