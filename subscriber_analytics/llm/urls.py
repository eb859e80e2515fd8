"""URL filters: host and path rules, and block decisions that follow redirects and canonical links."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscriber_analytics.llm.arrow import stored, without
from subscriber_analytics.llm.components import components

# (rule, action): a host, which stands for its subdomains too, and the begin of a path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
OWN = ("host", "path", "_address", "_blocked", "rule", "verdict")

# Tags that name another address of the same page.
TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
CANONICAL = r"(?is)\brel\s*=\s*[\"']?\s*canonical\b"
REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
TARGET = r"(?is)\bcontent\s*=\s*[\"']?[^\"'>]*?\burl\s*=\s*[\"']?\s*([^\"'>\s]+)"


def _host(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _address(url: Column) -> Column:
    """Host, path and query; a host holds no slash and a path begins with one, so the text names one address."""
    return F.concat(_host(url), _path(url), F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1))


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """pages with host, path and _address, the path with its query; all empty for a null url or one without "://"."""
    full = F.coalesce(F.col(url), F.lit(""))
    return pages.select(*[f"`{c}`" for c in without(pages, OWN)], _host(full).alias("host"), _path(full).alias("path"),
                        _address(full).alias("_address"))


def alias_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """(host, path, address, to_host, to_path, to_address): pages and what their canonical links and redirects name.

    A link may be absolute, or relative to the page's scheme, host, folder or path (with a query of its own);
    one that begins with # names the page itself and is no alias.
    """
    tags = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(TAGS), F.lit(0))
    tagged = pages.where(F.col("host") != "").select("host", "path", F.col("_address").alias("address"), F.explode(tags).alias("tag"))
    href = F.concat(*[F.regexp_extract("tag", HREF, k) for k in (1, 2, 3)])
    target = F.when(F.col("tag").rlike(CANONICAL), href).when(F.col("tag").rlike(REFRESH), F.regexp_extract("tag", TARGET, 1))
    found = tagged.withColumn("to", F.trim(target)).where("to <> '' AND NOT startswith(to, '#')")
    here = F.concat(F.lit("http://"), "host")
    folder = F.when(F.col("path") == "", "/").otherwise(F.regexp_replace("path", "[^/]*$", ""))
    absolute = (F.when(F.col("to").rlike("(?i)^[a-z][a-z0-9+.-]*://"), F.col("to"))
                .when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to"))
                .when(F.col("to").startswith("/"), F.concat(here, "to"))
                .when(F.col("to").startswith("?"), F.concat(here, "path", "to"))
                .otherwise(F.concat(here, folder, "to")))
    return found.select(
        "host", "path", "address", _host(absolute).alias("to_host"), _path(absolute).alias("to_path"),
        _address(absolute).alias("to_address")).where("to_host <> ''").distinct()


def matched(places: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) with the longest rule that fits, and its action; null where none does.

    The keys a place can have are its host's last labels with its path's begins, of those numbers of
    labels and lengths that rules have. They are joined with the rules by equality, so no host or
    rule meets more than its own. Rules of one text that differ in action count as allow.
    """
    parts = rules.where("rule IS NOT NULL").groupBy("rule").agg(F.min("action").alias("action"))
    host = F.translate(F.substring_index("rule", "/", 1), string.ascii_uppercase, string.ascii_lowercase)
    parts = parts.select("rule", "action", host.alias("rule_host"), F.expr("substr(rule, length(substring_index(rule, '/', 1)) + 1)").alias("rule_path"))
    shape = parts.agg(F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels"), F.collect_set(F.length("rule_path")).alias("lengths")).first()
    labels, lengths = sorted(shape["labels"]), sorted(shape["lengths"])
    places = places.select("host", "path").distinct()
    if not labels:
        return places.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action"))
    ends = F.array(*[F.when(F.size(F.split("host", r"\.")) >= n, F.substring_index("host", ".", -n)) for n in labels])
    begins = F.array(*[F.when(F.length("path") >= n, F.left("path", F.lit(n))) for n in lengths])
    keys = places.where("host <> ''").select("host", "path", F.explode(ends).alias("rule_host")).where("rule_host IS NOT NULL")
    keys = keys.select("host", "path", "rule_host", F.explode(begins).alias("rule_path")).where("rule_path IS NOT NULL")
    best = keys.join(parts, ["rule_host", "rule_path"]).groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), "rule", "action")).alias("best"))
    return places.join(best, ["host", "path"], "left").select("host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """pages (without html) with host, path, rule and verdict.

    A page with a rule of its own gets that rule's action. Any other is judged with its aliases, all
    addresses (host, path and query) that redirects and canonical links connect it with, pages or not: if a rule
    blocks one of them the page is blocked, unless a rule allows one of them; without either it is allowed. A null
    url, or one without a host, has no alias and is allowed. Repeated pages are judged alike. An empty table
    gives an empty one. Columns named like the new ones are replaced, _address and _blocked
    are dropped.
    """
    places = parsed(pages, url)
    edges = stored(alias_edges(places, html), "aliases")
    places = places.drop(html)
    known = places.select("host", "path").unionAll(edges.select("to_host", "to_path"))
    decided = stored(matched(known, rules), "decisions")
    classes = stored(components(edges.select(F.col("address").alias("a"), F.col("to_address").alias("b"))), "classes")
    linked = edges.select("host", "path", "address").unionAll(edges.select("to_host", "to_path", "to_address")).distinct()
    ruled = linked.join(decided.where("action IS NOT NULL"), ["host", "path"]).join(classes, F.col("address") == F.col("node"))
    spread = stored(ruled.groupBy("component").agg(
        (F.bool_or(F.col("action") == "block") & ~F.bool_or(F.col("action") == "allow")).alias("blocked")), "spread")
    blocked = stored(classes.join(spread.where("blocked"), "component").select(
        F.col("node").alias("_address"), F.col("blocked").alias("_blocked")), "blocked")
    ruled_pages = places.join(decided.withColumnRenamed("action", "verdict"), ["host", "path"], "left")
    verdict = F.coalesce("verdict", F.when(F.col("_blocked"), "block").otherwise("allow"))
    return ruled_pages.join(blocked, "_address", "left").withColumn("verdict", verdict).drop("_address", "_blocked")
