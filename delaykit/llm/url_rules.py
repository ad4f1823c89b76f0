"""URL filters by hashed host and path expressions (method 9).

Every URL is expanded into host suffixes (from the whole host to its last label) and path prefixes
(one of each length that some rule has). An expression's SHA-256 is cut to a short prefix, the rules
are joined on that prefix, and a hit counts only if the full digests agree. Of the rules that fit,
the longest host wins, then the longest path, then block before allow.

Null URLs and URLs without ``://`` have an empty host and path and fit no rule. Rules with a null host
or path count as empty, an unknown verdict raises. Rows are kept one to one, repeated ids included;
other columns are not carried. Where no rule fits the verdict is ``default``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_DIGITS = 8

#: The rules of the registered query, (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def expression_digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(
    pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, default: str = "allow",
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    ``rules`` is a list held by the driver, so its table is as large as what the caller wrote down.
    """
    spark = pages.sparkSession
    given = [(v, h or "", p or "") for v, h, p in rules]
    if bad := [v for v, _, _ in given if v not in ("allow", "block")]:
        raise ValueError(f"unknown verdicts {bad}")
    lengths = sorted({len(p) for _, _, p in given}) or [0]
    listed = spark.createDataFrame(given, "verdict string, rule_host string, rule_path string").select(
        "verdict",
        F.concat("rule_host", "rule_path").alias("rule"),
        expression_digest(F.col("rule_host"), F.col("rule_path")).alias("rule_digest"),
        F.struct(
            F.length("rule_host").alias("h"), F.length("rule_path").alias("p"),
            F.when(F.col("verdict") == "block", 1).otherwise(0).alias("b"),
        ).alias("weight"),
    ).withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))

    urls = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), url_host(F.col(f"`{url_col}`")).alias("host"), url_path(F.col(f"`{url_col}`")).alias("path"),
        F.monotonically_increasing_id().alias("row"),
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring(F.col("path"), 1, n)) for n in lengths]),
        lambda x: x.isNotNull(),
    )
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: expression_digest(h, p))))
    # one row per expression that shares its short prefix with a rule
    hits = (
        urls.select("page_id", "host", "path", "row", F.explode_outer(expressions).alias("digest"))
        .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
        .join(F.broadcast(listed), "short", "left")
    )
    found = F.when(F.col("digest") == F.col("rule_digest"), F.struct("weight", "rule", "verdict"))
    best = hits.groupBy("row").agg(
        F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(found).alias("best"),
    )
    return best.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
