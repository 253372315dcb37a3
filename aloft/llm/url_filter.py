"""URL filter: host-suffix and path-prefix expressions against a hashed rule list.

Every URL is expanded into the (host suffix, path prefix) expressions that a
rule could name; an expression's SHA-256 digest is cut to a short prefix, the
prefixes are equi-joined with those of the rules, and the full digests confirm
the match.  The longest matching rule decides.

* Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
  A-Z lower-cased.  Path: from there up to ``?``, ``#`` or the end.  A null URL
  or one without ``://`` has both empty and fits no rule.
* A rule (host, path) fits its host and all subdomains when the URL's path
  starts with the rule's path.  The longest rule text wins, then the longer
  host.  Without a fitting rule the verdict is ``default`` and the rule null.
* Expansion is bounded by the rules, not by the URL: only suffixes and
  prefixes of lengths that occur among the rules are formed, so a host of
  thousands of labels costs no more than another.
* Repeated rows and repeated or null page ids are kept as they are: the join
  goes by URL.  An empty table gives an empty result.  Other columns named
  ``host``, ``path``, ``rule`` or ``verdict`` are replaced by the results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import free_name

#: hex digits of the short prefix (8 = 32 bits)
PREFIX_HEX = 8

#: fixed values: the rules of the contract (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(_lower_ascii(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # the separator cannot occur in a host, so the pair is unambiguous
    return F.sha2(F.concat(host, F.lit("#"), path), 256)


def rule_table(spark, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as rows (verdict, rule_host, rule_path)."""
    return spark.createDataFrame(list(rules), "verdict string, rule_host string, rule_path string")


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
               prefix_hex: int = PREFIX_HEX) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules`` may be of any size: it is joined, and broadcast only where Spark's own
    size threshold allows.  Only the distinct lengths of rule hosts and paths (a few
    numbers) come to the driver.
    """
    rules = rules.where("verdict is not null and rule_host is not null and rule_path is not null")
    lengths = rules.agg(F.collect_set(F.length("rule_host")).alias("h"),
                        F.collect_set(F.length("rule_path")).alias("p")).first()
    host_lengths, path_lengths = sorted(lengths["h"]), sorted(lengths["p"])

    listed = rules.select(
        _digest(F.col("rule_host"), F.col("rule_path")).alias("full"), "rule_host", "rule_path", "verdict")
    # a rule given twice: block before allow
    listed = listed.groupBy("full").agg(
        F.max(F.struct(F.col("verdict") == "block", "rule_host", "rule_path", "verdict")).alias("r"))
    listed = listed.select(F.substring("full", 1, prefix_hex).alias("short"), "full", "r")

    pages = pages.drop("host", "path", "rule", "verdict")
    key, = free_name(pages, "url_key")
    pages = pages.withColumn(key, F.col(url_col))
    host, path = F.col("host"), F.col("path")
    suffixes = F.filter(
        F.transform(F.array(*[F.lit(n) for n in host_lengths]).cast("array<int>"),
                    lambda n: F.when((F.length(host) == n)
                                     | (F.substr(host, F.length(host) - n, F.lit(1)) == "."),
                                     F.right(host, n))),
        lambda s: s.isNotNull())
    prefixes = F.filter(
        F.transform(F.array(*[F.lit(n) for n in path_lengths]).cast("array<int>"),
                    lambda n: F.when(F.length(path) >= n, F.left(path, n))),
        lambda s: s.isNotNull())
    expressions = (pages.select(key, host_of(F.col(key)).alias("host"), path_of(F.col(key)).alias("path"))
                   .where(host != "")
                   .select(key, F.explode(suffixes).alias("s"), "path")
                   .select(key, "s", F.explode(prefixes).alias("p"))
                   .select(key, _digest(F.col("s"), F.col("p")).alias("found")))
    hits = (expressions.withColumn("short", F.substring("found", 1, prefix_hex))
            .join(listed, "short").where(F.col("found") == F.col("full")))
    best = hits.groupBy(key).agg(F.max(F.struct(
        (F.length("r.rule_host") + F.length("r.rule_path")).alias("n"),
        F.length("r.rule_host").alias("nh"),
        F.concat("r.rule_host", "r.rule_path").alias("rule"), F.col("r.verdict").alias("verdict"))).alias("best"))
    out = pages.join(best, key, "left")
    return out.select(*[c for c in out.columns if c not in (key, "best")],
                      host_of(F.col(key)).alias("host"), path_of(F.col(key)).alias("path"),
                      F.col("best.rule").alias("rule"),
                      F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
