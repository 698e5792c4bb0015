"""Judge URLs by rules for hosts and paths.

A URL is expanded into expressions, one for each suffix of its host and prefix of its path.
Rules and expressions meet in an equi-join on short prefixes of their digests; the whole
digest confirms; of the rules that fit, the longest decides. Only the numbers of labels and
the path lengths that occur among the rules are expanded, so a URL gives at most (label counts)
x (path lengths) rows however long it is, and rules may end within a path segment.

Defined cases: a null URL and one without ``://`` have empty host and path and fit no rule;
of equally long rules that fit, ``block`` wins, then the smaller rule; rules given twice count once;
a URL that no rule fits gets the ``default`` verdict; empty tables give no rows. Each
different URL is judged once, so a URL that holds a third of all rows is one row in the joins that
expand. Columns of the input are kept, those named in :data:`ADDED` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studiolens.llm.shared import ascii_lower, columns_of

ADDED = ("host", "path", "rule", "verdict")
ALLOW, BLOCK = "allow", "block"

# Hex digits of the digest that the join compares: 32 bits.
SHORT = 8


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(found), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``rule`` (host and path in one string) and ``verdict`` from pairs of (verdict, rule).

    A rule needs the slash that ends its host; one without would fit nothing, and is refused.
    """
    if wrong := [r for _, r in rules if "/" not in r]:
        raise ValueError(f"rules without a path: {wrong}")
    entries = [F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for v, r in rules]
    return spark.range(1).select(F.inline(F.array(*entries)))


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """``pages`` with ``host``, ``path``, the deciding ``rule`` or null, and the ``verdict``."""
    pages = pages.drop(*ADDED)
    keyed = (
        rules.where(F.col("rule").isNotNull() & F.col("rule").contains("/"))
        .select("rule", "verdict")
        .distinct()
        .withColumn("__cut", F.instr("rule", "/"))
        .withColumn("__host", ascii_lower(F.expr("substring(rule, 1, __cut - 1)")))
        .withColumn("__path", F.expr("substring(rule, __cut)"))
        .withColumn("digest", F.sha2(F.concat("__host", "__path"), 256))
    )
    # How rules look: two sets of small numbers, whatever the number of rules.
    labels, lengths = keyed.agg(
        F.collect_set(F.size(F.split("__host", r"\."))), F.collect_set(F.length("__path"))
    ).first()
    urls = (
        pages.select("url")
        .where(F.col("url").contains("://"))
        .distinct()
        .select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .withColumn("labels", F.split("host", r"\."))
    )
    expanded = (
        urls.withColumn("n", F.explode(F.lit(sorted(labels)).cast("array<int>")))
        .where(F.col("n") <= F.size("labels"))
        .withColumn("suffix", F.expr("array_join(slice(labels, size(labels) - n + 1, n), '.')"))
        .select("url", "path", "suffix", F.explode(F.lit(sorted(lengths)).cast("array<int>")).alias("n"))
        .where(F.col("n") <= F.length("path"))
        .select("url", F.sha2(F.concat("suffix", F.expr("substring(path, 1, n)")), 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    listed = keyed.select(
        F.substring("digest", 1, SHORT).alias("short"), F.col("digest").alias("full"), "rule", "verdict"
    )
    rank = F.struct(
        F.length("rule").alias("length"), (F.col("verdict") == BLOCK).alias("block"), "rule", "verdict"
    )
    decided = (
        expanded.join(listed, "short")
        .where(F.col("digest") == F.col("full"))
        .groupBy("url")
        .agg(F.max(rank).alias("best"))
        .select(F.col("url").alias("__url"), "best.rule", "best.verdict")
    )
    return (
        pages.join(decided, F.col("url") == F.col("__url"), "left")
        .drop("__url")
        .withColumns(
            {
                "host": host_of(F.col("url")),
                "path": path_of(F.col("url")),
                "verdict": F.coalesce("verdict", F.lit(default)),
            }
        )
    )


def kept(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """The pages whose URL is allowed, with the columns of ``pages``."""
    return judge(pages, rules, default).where(F.col("verdict") == ALLOW).select(*columns_of(pages))
