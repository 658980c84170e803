"""URL filter: host-suffix and path-prefix expressions joined with a rule table.

A rule ``(host, path, verdict)`` fits its host and all subdomains where the url's
path starts with the rule's.  A url is expanded into the expressions that could
be a rule (a suffix of its host that starts at a label, and a prefix of its
path).  Expressions join the rules on a short prefix of their SHA-256; the full
digest confirms the match, and the longest rule wins.

Only the lengths that occur among the rules are expanded, so a url gives at most
one expression for each pair of lengths, however long it is.  Urls that agree in
their host and in as much of the path as a rule can see are judged once.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm.common import MAX_BROADCAST_KEYS, MAX_BROADCAST_ROWS, checkpointed, join_small, written

ALLOW, BLOCK = "allow", "block"
HASH_PREFIX = 8         # hex digits of the digest that are joined
#: Rules of the registered query: (host, path, verdict).
RULES = [("net", "/", BLOCK), ("example.net", "/en/", ALLOW), ("example.com", "/de/", BLOCK), ("org", "/fr/", ALLOW)]
RULE_SCHEMA = "host string, path string, verdict string"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _until(text: Column, marks: str) -> Column:
    for m in marks:
        text = F.substring_index(text, m, 1)
    return text


def _right(text: Column, n: Column | int) -> Column:
    """The last ``n`` code points (``n`` within the length)."""
    return F.substring(text, F.length(text) - n + F.lit(1), F.lit(n) if isinstance(n, int) else n)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path of a url; both
    empty for null and for a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = _until(rest, "/?#")
    path = _until(F.substring(rest, F.length(host) + 1, F.length(rest)), "?#")
    return F.translate(host, _UPPER, _LOWER), path


def expression(host: Column, path: Column) -> Column:
    """Digest of a host suffix and a path prefix (the length keeps them apart)."""
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit(":"), host, path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """One row per rule: digest, its joined prefix, text, verdict and rank.
    Null hosts and paths count as empty; hosts are lower-cased; of equal rules
    ``block`` is kept; verdicts other than block and allow fail the job."""
    host, path = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER), F.coalesce("path", F.lit(""))
    verdict = F.when(F.col("verdict").isin(ALLOW, BLOCK), F.col("verdict"))
    r = rules.select(host.alias("host"), path.alias("path"),
                     F.coalesce(verdict, F.raise_error(F.concat(F.lit("verdict of a rule: "), F.coalesce("verdict", F.lit("null"))))).alias("verdict"))
    r = r.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    size, digest = F.length("host") + F.length("path"), expression(F.col("host"), F.col("path"))
    return r.select(digest.alias("digest"), F.substring(digest, 1, HASH_PREFIX).alias("prefix"), F.length("host").alias("host_size"),
                    F.length("path").alias("path_size"), F.concat("host", "path").alias("rule"), "verdict", size.alias("size"))


def _shapes(rules: DataFrame) -> tuple[Column, int]:
    """For each length of a rule's host the lengths of its paths (a literal: as
    many numbers as rules differ in length), and the longest path."""
    per = rules.groupBy("host_size").agg(F.sort_array(F.collect_set("path_size")).alias("paths")).orderBy("host_size").collect()
    shapes = json.dumps([r.asDict() for r in per])
    return F.from_json(F.lit(shapes), "array<struct<host_size: int, paths: array<int>>>"), max((r["paths"][-1] for r in per), default=0)


def _expressions(host: Column, path: Column, shapes: Column) -> Column:
    """Digests of the expressions of a url in the rules' lengths."""
    def suffix_fits(s: Column) -> Column:
        n = s["host_size"]
        starts = F.substring(host, F.length(host) - n, F.lit(1)) == F.lit(".")
        return (F.length(host) == n) | ((n > 0) & (F.length(host) > n) & starts)

    def prefixes(s: Column) -> Column:
        fits = F.filter(s["paths"], lambda p: p <= F.length(path))
        return F.transform(fits, lambda p: expression(_right(host, s["host_size"]), F.substring(path, F.lit(1), p)))
    return F.flatten(F.transform(F.filter(shapes, suffix_fits), prefixes))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = ALLOW, most_rules: int = MAX_BROADCAST_ROWS,
               most_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """One row per row of ``pages(page_id, url)``: ``page_id, host, path, rule,
    verdict``.

    The longest fitting rule (host and path together) gives the verdict; of
    equally long ones the longer host, then ``block``.  No rule: ``rule`` null
    and ``default``.  Null urls and urls without ``://`` have an empty host and
    path, which only a rule with an empty host and path fits.  Repeated rows and
    null ids stay as they are; other columns are not read; an empty rule table
    gives the default everywhere.

    At most ``most_rules`` rules are broadcast, and verdicts of up to ``most_keys``
    different urls (a digest, a rule and a verdict each); more are joined, where
    Spark splits a skewed host."""
    host, path = split_url(F.col("url"))
    table = checkpointed(rule_table(rules))
    shapes, longest = _shapes(table)
    seen = F.substring("path", 1, longest)
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("key", expression(F.col("host"), seen))
    keys = urls.groupBy("key").agg(F.any_value("host").alias("host"), F.any_value(seen).alias("path"))
    found = keys.select("key", F.explode(_expressions(F.col("host"), F.col("path"), shapes)).alias("found"))\
        .withColumn("prefix", F.substring("found", 1, HASH_PREFIX))
    match = join_small(found, table, ["prefix"], most=most_rules).where(F.col("found") == F.col("digest"))
    rank = F.struct("size", "host_size", "verdict")
    verdicts = written(match.groupBy("key").agg(F.max_by(F.struct("rule", "verdict"), rank).alias("hit")), "urls")
    return join_small(urls, verdicts, ["key"], "left", most=most_keys)\
        .select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """A rule list as a frame of literals."""
    rows = [F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(verdict).alias("verdict")) for host, path, verdict in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))
