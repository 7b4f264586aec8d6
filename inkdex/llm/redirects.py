"""URL rules with redirect equivalence: aliases of a blocked address are blocked. DataFrame code only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkdex.llm.common import components
from inkdex.operators.joins import join_by_weight
from inkdex.session import settle

ALLOW, BLOCK = "allow", "block"

# Rules are settings, written into the plan as one expression.
MAX_RULES = 1000

_LINK = r"(?is)<link\b[^>]*>"
_CANONICAL = r"(?is)\brel\s*=\s*[\"']?canonical[\"'\s/>]"
_HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
_META = r"(?is)<meta\b[^>]*>"
_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh[\"'\s/>]"
_TARGET = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>;]+)"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without one."""
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.when(F.instr(url, "://") > 0, after), F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does.

    A rule ``host/path`` fits the host and its subdomains where the path starts with the rule's. Of
    rules of one length that fit, an allow comes first, then the first in order of text.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == ALLOW, [-ord(c) for c in r[1]])):
        domain, slash, rest = text.partition("/")
        if decision not in (ALLOW, BLOCK) or not domain:
            raise ValueError(f"not a rule: {decision} {text}")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def address(url: Column) -> Column:
    """The resource that a url names: no fragment, host in lower case; null without ``://``."""
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    tail = F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host_of(url), tail))


def _resolved(pages: DataFrame) -> DataFrame:
    """``pages`` (url, link) with the column ``target``, the link as an absolute address; null if it is none."""
    link = F.col("link")
    parts = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    parts = parts.withColumn("scheme", F.regexp_extract("url", r"(?s)^(.*?)://", 1))
    parts = parts.withColumn("folder", F.regexp_extract("path", r"(?s)^(.*/)", 1))
    root = F.concat("scheme", F.lit("://"), "host")
    target = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat("scheme", F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | link.startswith("#"), F.lit(None))
        .otherwise(F.concat(root, F.when(F.col("folder") == "", "/").otherwise(F.col("folder")), link))
    )
    return parts.withColumn("target", target)


def page_links(pages: DataFrame) -> DataFrame:
    """Edges (a, b) from a page's address to its canonical address and to where it refreshes to."""
    html = F.coalesce(F.col("html"), F.lit(""))
    href = F.concat(*(F.coalesce(F.regexp_extract("tag", _HREF, i), F.lit("")) for i in (1, 2, 3)))
    canonical = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(_LINK), 0), lambda t: t.rlike(_CANONICAL)),
        lambda t: F.struct(t.alias("tag"), F.lit(True).alias("link")),
    )
    refresh = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(_META), 0), lambda t: t.rlike(_REFRESH)),
        lambda t: F.struct(t.alias("tag"), F.lit(False).alias("link")),
    )
    tags = pages.select("url", F.explode(F.concat(canonical, refresh)).alias("found")).select("url", "found.*")
    target = F.trim(F.when(F.col("link"), href).otherwise(F.regexp_extract("tag", _TARGET, 1)))
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    links = tags.where(F.instr("url", "://") > 0).select("url", target.alias("link")).where("link <> ''")
    # Steps of their own keep long expressions from being written out within each other.
    links = _resolved(links).select(address(F.col("url")).alias("a"), address(F.col("target")).alias("b"))
    return links.where("a IS NOT NULL AND b IS NOT NULL")


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, verdict) per row of ``pages`` (page_id, url, html).

    A url that a rule fits gets the rule's verdict. Any other gets that of its component under
    redirects (``redirects`` has the columns from_url, to_url, besides what the pages refresh to) and
    canonical links: allow if a rule allows any address there, else block if a rule blocks one, else
    allow. Addresses that only links name count as well. Null urls and urls without ``://`` have an
    empty host and path, fit no rule and are allowed; null pages have no links; repeated rows stay;
    further columns are not read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"), address(F.col("url")).alias("node"))
    rows = settle(rows.withColumns({"rule": rule, "own": verdict}), "urls")
    edges = page_links(pages.select("url", "html"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(address(F.col("from_url")).alias("a"), address(F.col("to_url")).alias("b")))
    aliases = components(edges)
    groups = aliases.withColumns({"host": host_of(F.col("node")), "path": path_of(F.col("node"))})
    groups = groups.withColumn("decided", rule_of(F.col("host"), F.col("path"), rules)[1])
    groups = settle(groups.select("node", "component", "decided"), "aliases")
    ruled = groups.groupBy("component").agg(
        F.min("decided").alias("group_verdict"), F.count(F.lit(1)).alias("nodes")
    )  # allow sorts before block
    known = join_by_weight(groups, settle(ruled, "verdicts"), "component", "nodes").select("node", "group_verdict")
    asked = rows.where("own IS NULL AND node IS NOT NULL")
    keys = asked.groupBy("node").agg(F.count(F.lit(1)).alias("rows")).join(known, "node", "left")
    spread = join_by_weight(asked, settle(keys, "addresses"), "node", "rows").drop("rows")
    rest = rows.where("own IS NOT NULL OR node IS NULL").withColumn("group_verdict", F.lit(None).cast("string"))
    final = F.coalesce("own", "group_verdict", F.lit(ALLOW)).alias("verdict")
    return rest.unionByName(spread).select("page_id", "url", "host", "path", "rule", final)
