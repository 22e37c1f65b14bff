"""URL filtering by host-suffix / path-prefix rules looked up by short hash prefixes.

Every URL is expanded into expressions ``host suffix + path prefix``.  The
expressions meet the rules in an equi-join on the first four bytes of their
SHA-256 digests; the whole digest then confirms the match, and the longest
rule wins (ties: the longer host, then block before allow).  An URL that no
rule fits is allowed.

A path prefix is taken at every length that some rule's path has, so a rule
path need not end at a slash.  Distinct (host, path) pairs are judged once, so
a hot host costs its distinct paths only.

Defined cases: a null URL or one without ``://`` has an empty host and path
and is allowed; a port or user name is part of the host, as written; without
rules everything is allowed; repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulse.llm.common import lower_ascii

PREFIX_HEX = 8  # four bytes


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (verdict, host, path) with their digests; host and path concatenate to the rule's text."""
    text = F.concat("host", "path")
    return rules.select(
        F.col("verdict").alias("rule_verdict"),
        text.alias("rule"),
        F.length("host").alias("rule_host_len"),
        F.size(F.split("host", r"\.")).alias("rule_labels"),
        F.length("path").alias("rule_path_len"),
        F.sha2(F.concat_ws("\x00", "host", "path"), 256).alias("rule_digest"),
    ).withColumn("prefix", F.substring("rule_digest", 1, PREFIX_HEX))


def expressions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path) rows expanded to the digests of their host suffixes and path prefixes."""
    # Only as many labels as some rule has: few suffixes, however many labels a host has.
    counts = sorted(r[0] for r in rules.select("rule_labels").distinct().collect())
    dots = F.length("host") - F.length(F.replace("host", F.lit(".")))
    suffixes = F.array_compact(
        F.array(*[F.when(dots >= n - 1, F.substring_index("host", ".", -n)) for n in counts]).cast("array<string>")
    )
    # Distinct lengths only: few, however many rules there are.
    lengths = sorted(r[0] for r in rules.select("rule_path_len").distinct().collect())
    prefixes = F.array_compact(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]).cast("array<string>")
    )
    return (
        urls.where(F.col("host") != "")
        .select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("path_prefix"))
        .withColumn("digest", F.sha2(F.concat_ws("\x00", "suffix", "path_prefix"), 256))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    )


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule (null without one), verdict."""
    rows = pages.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    table = rule_table(rules)
    best = F.max(
        F.struct(
            F.length("rule").alias("len"),
            F.col("rule_host_len").alias("host_len"),
            F.col("rule_verdict").alias("verdict"),  # 'block' sorts after 'allow'
            F.col("rule").alias("rule"),
        )
    )
    matched = (
        expressions(rows.select("host", "path").distinct(), table)
        .join(table, "prefix")
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(best.alias("best"))
    )
    return rows.join(matched, ["host", "path"], "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
    )
