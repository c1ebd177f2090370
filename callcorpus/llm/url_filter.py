"""URL filters with redirect equivalence (operator 8). DataFrame functions only.

* Rules (host, path, action): a rule fits its host and all subdomains if the url's path
  starts with the rule's; the longest fitting rule wins (of equal length: allow).
* Aliases: pages are tied to their ``<link rel="canonical">`` target and their
  ``<meta http-equiv="refresh">`` target, and further redirects may be given as a table
  (from_url, to_url). Two urls that differ only in their fragment are one resource.
* Connected components over those ties propagate decisions: a url without a rule is blocked
  when its component holds a url that a rule blocks, unless the component also holds one
  that a rule allows explicitly (allow takes precedence). A url with a rule keeps its rule's
  verdict. Everything else is allowed.

Rules meet urls by an equi-join on the host's suffixes, so a long rule list is joined, not
looped over; a host with a third of all pages is only a repeated join key of the large side.

Defined results: a null url or one without ``://`` has an empty host and path, no rule and
no alias, and is allowed. A null html has no tie. Repeated rows are judged alike. Relative
targets are resolved against the page's url by RFC 3986 (dot segments, lone queries).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import common as C
from .components import components

#: (host, path, action) of the registered query.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def resource(url: Column) -> Column:
    """The url without its fragment: what a link or a redirect names."""
    return F.regexp_replace(url, r"(?s)#.*$", "")


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("rule_host"), F.lit(p).alias("rule_path"), F.lit(a).alias("action")) for h, p, a in rules]
    if not rows:
        return spark.range(0).selectExpr("'' AS rule_host", "'' AS rule_path", "'' AS action")
    return spark.range(1).select(F.inline(F.array(*rows)))


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, host, path) -> the same with rule and action of the longest fitting rule, or null.

    ``urls`` holds distinct urls."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = urls.select("url", "path", F.explode(F.array_distinct(suffixes)).alias("rule_host")).filter("rule_host != ''")
    fits = each.join(rules, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    name = F.concat("rule_host", "rule_path")
    best = fits.groupBy("url").agg(F.max(F.struct(F.length(name).alias("n"), (F.col("action") == "allow").alias("first"), name.alias("rule"), F.col("action").alias("action"))).alias("r"))
    return urls.join(best, "url", "left").select("url", "host", "path", "r.rule", "r.action")


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*[\"']([^\"']*)[\"']", 1)
    bare = F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*([^\s\"'>]+)", 1)
    return F.trim(F.regexp_replace(F.when(quoted != "", quoted).otherwise(bare), "(?i)&amp;", "&"))


def _without_dots(path: Column) -> Column:
    """An absolute path with its ``.`` and ``..`` segments carried out; a last one leaves its slash."""
    parts = F.slice(F.split(path, "/"), 2, F.length(path) + 1)
    step = lambda done, x: F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(x)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    open_end = F.when(path.rlike(r"(?s)/\.{1,2}$"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.concat(F.lit("/"), F.array_join(open_end, "/"))


def _resolved(page: Column, target: Column) -> Column:
    """An absolute url for a link target on a page (RFC 3986, 5.2); null if there is none."""
    scheme = F.regexp_extract(page, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(page, r"(?s)^(.*?://[^/?#]*)", 1)
    own = F.regexp_extract(page, r"(?s)^(.*?://[^?#]*)", 1)
    query = F.regexp_extract(page, r"(?s)^[^?#]*(\?[^#]*)", 1)
    folder = F.regexp_extract(page, r"(?s)^.*?://[^/?#]*((?:/[^?#]*)?/)", 1)
    path, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    whole = F.when(path.startswith("/"), path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), path))
    return (
        F.when(target == "", None)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(target.startswith("?"), F.concat(own, target))
        .when(target.startswith("#"), F.concat(own, query, target))
        .otherwise(F.concat(site, _without_dots(whole), rest))
    )


def ties(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(from_url, to_url): canonical links and refresh redirects found in the html."""
    tags = F.regexp_extract_all(F.col(html_col), F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    each = pages.filter(F.col(url_col).contains("://") & F.col(html_col).isNotNull()).select(F.col(url_col).alias("url"), F.explode(tags).alias("tag"))
    rel, kind = F.lower(_attribute(F.col("tag"), "rel")), F.lower(_attribute(F.col("tag"), "http-equiv"))
    jump = F.trim(F.regexp_extract(_attribute(F.col("tag"), "content"), r"(?is)^\s*[0-9.]+\s*[;,]\s*url\s*=\s*(.*)$", 1))
    target = F.when(F.array_contains(F.split(rel, r"\s+"), "canonical"), _attribute(F.col("tag"), "href")).when(kind == "refresh", jump)
    return each.select("url", target.alias("target")).filter("target IS NOT NULL AND target != ''").select(F.col("url").alias("from_url"), _resolved(F.col("url"), F.col("target")).alias("to_url")).filter("to_url IS NOT NULL")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, host, path, rule, verdict, component (or null)."""
    links = ties(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select(F.col("from_url").cast("string").alias("from_url"), F.col("to_url").cast("string").alias("to_url")))
    links = C.store(links.select(resource(F.col("from_url")).alias("a"), resource(F.col("to_url")).alias("b")).distinct(), "ties")
    url = F.col("url")
    own = pages.select(F.col(url_col).cast("string").alias("url")).filter("url IS NOT NULL")
    ends = links.select(F.col("a").alias("url")).unionByName(links.select(F.col("b").alias("url")))
    urls = own.unionByName(ends).distinct().select("url", host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = C.store(apply_rules(urls, rules), "ruled").withColumn("node", resource(url))
    member = C.store(components(links), "aliases").select(F.col("node").alias("alias"), F.col("root").alias("component"))
    placed = ruled.join(member, F.col("node") == F.col("alias"), "left")
    known = placed.filter("component IS NOT NULL AND action IS NOT NULL")
    decided = known.groupBy(F.col("component").alias("c")).agg(F.max(F.when(F.col("action") == "block", 1).otherwise(0)).alias("blocks"), F.max(F.when(F.col("action") == "allow", 1).otherwise(0)).alias("allows"))
    judged = placed.join(decided, F.col("component") == F.col("c"), "left")
    method = F.when((F.coalesce("blocks", F.lit(0)) == 1) & (F.coalesce("allows", F.lit(0)) == 0), "block").otherwise("allow")
    per_url = judged.select(F.col("url").alias("u"), "rule", F.coalesce("action", method).alias("verdict"), "component")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    out = rows.join(per_url, F.col("url") == F.col("u"), "left")
    return out.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"), "component")
