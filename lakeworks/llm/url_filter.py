"""URL filter: allow and block rules, and block decisions carried over redirects and canonical links.

DataFrame functions only. A rule is a host and a path; it fits that host and all its
subdomains where the url's path starts with the rule's, and the longest rule wins. An
address without a rule takes its decision from its aliases: addresses tied by redirects
(meta refresh, or a given table) and canonical links, in either direction and over any
number of steps, are one resource. If any of them is explicitly allowed the resource is
allowed, else if any is blocked it is blocked, else it is allowed. An address's own rule
comes before everything.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no
rule, has no aliases and is allowed; null or empty html has no links; equal rows get
equal results; of rules with the same host and path, allow wins; a page that names
several canonical addresses is tied to the first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import stored
from .graph import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINK = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
TARGET = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def parsed(df: DataFrame, url: str, name: str) -> DataFrame:
    """``df`` with ``name_host``, ``name_path`` and ``name_address`` of a url.

    The host is what follows the first ``://`` up to the first of ``/?#``, in small ASCII
    letters; the path is what follows up to the first of ``?#``. The address is host,
    path and query, which name a resource; it is null without a host. The steps are
    columns of their own, so that each is computed once.
    """
    rest = F.when(F.contains(F.col(url), F.lit("://")), F.substr(F.col(url), F.length(F.substring_index(F.col(url), "://", 1)) + 4))
    df = df.withColumn(f"{name}_rest", rest)
    rest = F.col(f"{name}_rest")
    df = df.withColumns({
        f"{name}_host": F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.lit("")),
        f"{name}_path": F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
        f"{name}_query": F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)?", 1)})
    host, path = F.col(f"{name}_host"), F.col(f"{name}_path")
    address = F.when(host != "", F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), f"{name}_query"))
    return df.withColumn(f"{name}_address", address).drop(f"{name}_rest", f"{name}_query")


def _absolute(link: Column, scheme: Column, host: Column, folder: Column) -> Column:
    """A link as it stands in a page, as a full url."""
    return (F.when(link == "", None).when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(scheme, F.lit("://"), host, link))
            .otherwise(F.concat(scheme, F.lit("://"), host, folder, link)))


def addresses(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """``page_id, host, path, address`` of every page and the addresses its canonical link and its redirect lead to."""
    h = F.col(html)
    df = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                      F.regexp_extract(F.regexp_extract(h, LINK, 0), HREF, 1).alias("link"),
                      F.regexp_extract(F.regexp_extract(h, REFRESH, 0), TARGET, 1).alias("refresh"))
    df = parsed(df, "url", "own")
    folder = F.regexp_replace("own_path", r"[^/]*$", "")
    df = df.select("page_id", "own_host", "own_path", "own_address", F.substring_index("url", "://", 1).alias("scheme"),
                   F.when(folder == "", F.lit("/")).otherwise(folder).alias("folder"),
                   *(F.regexp_replace(c, "&amp;", "&").alias(c) for c in ("link", "refresh")))
    place = F.col("scheme"), F.col("own_host"), F.col("folder")
    df = df.withColumns({c: _absolute(F.col(c), *place) for c in ("link", "refresh")})
    df = parsed(parsed(df, "link", "canonical"), "refresh", "redirect")
    return df.select("page_id", F.col("own_host").alias("host"), F.col("own_path").alias("path"), F.col("own_address").alias("address"),
                     F.col("canonical_address").alias("canonical"), F.col("redirect_address").alias("redirect"))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``(verdict, rule)`` pairs like ``("block", "example.org/es/")`` as a table of hosts and paths."""
    given = spark.createDataFrame(list(rules), "verdict string, rule string")
    return given.select(F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER).alias("host"),
                        F.concat(F.lit("/"), F.substr("rule", F.length(F.substring_index("rule", "/", 1)) + 2)).alias("path"), "verdict", "rule")


def longest_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest fitting rule of each distinct ``(host, path)``: ``host, path, rule, verdict``.

    A host is looked up by its suffixes and a path by its prefixes of the lengths that
    rules have, so this is an equality join however many rules there are.
    """
    lengths = rules.agg(F.array_sort(F.collect_set(F.length("path"))).alias("sizes"))  # one row, bounded by the longest path
    once = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"), F.min_by("rule", "verdict").alias("rule"))
    distinct = addresses.select("host", "path").where("host != ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    sizes = lengths.first()["sizes"] or []
    prefixes = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sizes])) if sizes else F.array()
    keys = distinct.select("host", "path", F.explode(suffixes).alias("h"), prefixes.cast("array<string>").alias("ps"))
    keys = keys.select("host", "path", "h", F.explode("ps").alias("p"))
    found = keys.join(once.select(F.col("host").alias("h"), F.col("path").alias("p"), "rule", "verdict"), ["h", "p"])
    size = F.struct(F.length("rule"), "rule")
    return found.groupBy("host", "path").agg(F.max_by("rule", size).alias("rule"), F.max_by("verdict", size).alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
          redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, reason``.

    ``redirects`` may add ``(source_url, target_url)`` pairs, for addresses that were not crawled too.
    """
    seen = stored(addresses(pages, page_id, url, html), "urls")
    edges = seen.select("address", F.col("canonical").alias("other")).unionByName(seen.select("address", F.col("redirect").alias("other")))
    if redirects is not None:
        hops = parsed(parsed(redirects.select("source_url", "target_url"), "source_url", "a"), "target_url", "b")
        edges = edges.unionByName(hops.select(F.col("a_address").alias("address"), F.col("b_address").alias("other")))
    edges = edges.where("address IS NOT NULL AND other IS NOT NULL AND address != other").distinct()
    # Addresses are long; components work on 64-bit names of them.
    edges = stored(edges, "aliases")
    aliases = components(edges.select(F.xxhash64("address").alias("u"), F.xxhash64("other").alias("v")), "u", "v")
    # Decisions of all addresses of a resource, crawled or only linked to.
    linked = edges.select(F.col("address").alias("a")).unionByName(edges.select(F.col("other").alias("a"))).distinct()
    linked = linked.select("a", F.substring_index("a", "/", 1).alias("host"),
                           F.regexp_extract("a", r"^[^/]*([^?]*)", 1).alias("path"))
    ruled = stored(longest_rules(seen.select("host", "path").unionByName(linked.select("host", "path")), rules), "rules")
    facts = (linked.join(ruled, ["host", "path"]).join(aliases.withColumnRenamed("component", "resource"), F.xxhash64("a") == F.col("node"))
             .groupBy("resource").agg(F.min("verdict").alias("resource_verdict")))  # allow comes before block
    decided = aliases.join(facts, F.col("component") == F.col("resource")).select("node", "resource_verdict")
    out = seen.select("page_id", "host", "path", F.xxhash64("address").alias("node")).join(ruled, ["host", "path"], "left").join(decided, "node", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", "resource_verdict", F.lit("allow")).alias("verdict"),
                      F.when(F.col("verdict").isNotNull(), "rule").when(F.col("resource_verdict").isNotNull(), "alias").otherwise("none").alias("reason"))
