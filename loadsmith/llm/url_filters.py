"""URL allow and block rules by hashed host and path expressions, in DataFrame operations only.

A rule is a host with a path, such as ``example.net/en/``; it fits its host and all
subdomains when the url's path starts with the rule's.  Each distinct url is expanded into
every (host suffix, path prefix) expression that a rule could have: suffixes at dots of the
lengths of the rules' hosts, prefixes of the lengths of their paths (at a slash where all
rules of that length end with one).  So a url of any length gives a bounded number of
expressions, each as short as a rule.  The expressions' SHA-256 are joined with the rules' on a short prefix (an equi-join on an
integer), then the full digests are compared.  The longest rule wins; of equally long ones
the longer host, then block.

Rules are broadcast only when their number and bytes are counted and small; else the join
shuffles, on expressions of distinct urls.  Urls are decided once each and joined back, so a
url that a third of all pages share is one row.

Defined results: a null url, or one without ``://``, has empty host and path and no rule; a
url that no rule fits is allowed; null rules and rules with an unknown verdict are an error;
repeated pages are all returned; columns of the pages named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_VERDICT = "allow"
# Hex digits of a digest that the join uses.
SHORT = 8
# Rules are broadcast up to this many rows and bytes of text.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 4_000_000

RESULTS = ("url_host", "url_path", "url_rule", "url_verdict")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)


def _lengths(lengths: list[int]) -> Column:
    return F.array(*[F.lit(n) for n in lengths]).cast("array<int>")


def _suffixes(host: Column, lengths: list[int]) -> Column:
    """The suffixes of a host, at its dots, that have one of these lengths."""
    size = F.length(host)
    fits = F.filter(_lengths(lengths), lambda n: (n == size) | (n < size) & (F.substring(host, size - n, F.lit(1)) == "."))
    return F.transform(fits, lambda n: F.substring(host, size - n + 1, n))


def _prefixes(path: Column, lengths: list[int], at_slash: list[int]) -> Column:
    """The prefixes of a path that have one of these lengths; those of ``at_slash`` end with a slash."""
    size = F.length(path)
    fits = F.concat(F.filter(_lengths(lengths), lambda n: n <= size),
                    F.filter(_lengths(at_slash), lambda n: (n <= size) & (F.substring(path, n, F.lit(1)) == "/")))
    return F.transform(fits, lambda n: F.substring(path, F.lit(1), n))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, *, url_col: str = "url") -> DataFrame:
    """``pages`` with url_host, url_path, url_rule and url_verdict.  ``rules``: host, path, verdict."""
    facts = rules.agg(
        F.count("*").alias("n"), F.sum(F.length("host") + F.length("path")).alias("bytes"),
        F.count_if(F.col("host").isNull() | F.col("path").isNull() | ~F.coalesce(F.col("verdict").isin("allow", "block"), F.lit(False))).alias("bad"),
        F.collect_set(F.length("host")).alias("hosts"),
        F.collect_set(F.when(~F.col("path").endswith("/"), F.length("path"))).alias("any_end"),
        F.collect_set(F.when(F.col("path").endswith("/"), F.length("path"))).alias("slashes")).first()
    if facts.bad:
        raise ValueError("every rule needs a host, a path and a verdict, allow or block")
    known = rules.select(
        F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_length"),
        _digest(F.translate("host", UPPER, LOWER), F.col("path")).alias("rule_digest"))
    known = known.withColumn("short", F.substring("rule_digest", 1, SHORT))
    if facts.n <= BROADCAST_ROWS and (facts.bytes or 0) <= BROADCAST_BYTES:
        known = F.broadcast(known)
    host, path = host_and_path(F.col("the_url"))
    urls = pages.select(F.col(f"`{url_col}`").alias("the_url")).where(F.col("the_url").contains("://")).distinct() \
        .select("the_url", host.alias("host"), path.alias("path"))
    slashes = sorted(set(facts.slashes) - set(facts.any_end))
    tried = urls.select("the_url", F.explode(_suffixes(F.col("host"), sorted(facts.hosts))).alias("host"),
                        _prefixes(F.col("path"), sorted(facts.any_end), slashes).alias("paths")) \
        .select("the_url", "host", F.explode("paths").alias("path")) \
        .select("the_url", _digest(F.col("host"), F.col("path")).alias("digest"))
    fits = tried.withColumn("short", F.substring("digest", 1, SHORT)).join(known, "short").where("digest = rule_digest")
    best = fits.groupBy("the_url").agg(F.max(F.struct(
        F.length("rule").alias("length"), "host_length", F.col("verdict").alias("verdict"), "rule")).alias("best")) \
        .select("the_url", "best.rule", "best.verdict")
    # Numbered columns, so that no name of the pages clashes with these.
    at = {name: F.col(f"c{i}") for i, name in enumerate(pages.columns)}
    numbered, url = pages.toDF(*[f"c{i}" for i in range(len(pages.columns))]), at[url_col]
    own_host, own_path = host_and_path(url)
    kept = [column.alias(name) for name, column in at.items() if name not in RESULTS]
    # Rows without a rule-bearing url can't match: their null keys must not meet in one task.
    usable = F.coalesce(url.contains("://"), F.lit(False))
    shown = numbered.where(usable).join(best, url == F.col("the_url"), "left").select(
        *kept, own_host.alias("url_host"), own_path.alias("url_path"), F.col("rule").alias("url_rule"),
        F.coalesce("verdict", F.lit(DEFAULT_VERDICT)).alias("url_verdict"))
    blank = numbered.where(~usable).select(*kept, F.lit("").alias("url_host"), F.lit("").alias("url_path"),
                                           F.lit(None).cast("string").alias("url_rule"), F.lit(DEFAULT_VERDICT).alias("url_verdict"))
    return shown.unionByName(blank)
