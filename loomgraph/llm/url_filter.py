"""URL filtering by host-suffix and path-prefix expressions, in DataFrame operations alone."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm.common import UPPER

#: Hex digits of a digest that the equi-join uses; the rest is confirmed after it.
SHORT = 8


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """(verdict, "host/path") pairs as a rules table: host, path, rule, verdict."""
    rows = [(r.partition("/")[0], "/" + r.partition("/")[2], r, v) for v, r in rules]
    return spark.createDataFrame(rows, "host string, path string, rule string, verdict string")


def host_of(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict added.

    A rule fits its host and every subdomain if the path starts with the rule's path.
    The longest rule wins (host and path together; a tie goes to the longer host, then
    to block). Where none fits, the verdict is ``default``. Null urls and urls without
    ``://`` have empty host and path and get ``default``. Columns of ``pages`` named
    host, path, rule or verdict give way to the results. Repeated rows stay repeated.

    Every distinct (host, path) expands into host suffixes at label borders times path
    prefixes of the lengths that occur among the rules, so nothing else can fit. The
    join key is the first 32 bits of a digest; the full digest and the strings are
    confirmed on what it finds. The rules are a table: Catalyst broadcasts them only
    under its size threshold and else joins by shuffle.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    placed = pages.select(*kept, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keyed = rules.select(
        F.col("host").alias("_rh"), F.col("path").alias("_rp"), F.col("rule").alias("_rule"),
        F.col("verdict").alias("_verdict"), _digest(F.col("host"), F.col("path")).alias("_rd"),
    ).withColumn("_short", F.substring("_rd", 1, SHORT))
    lengths = keyed.agg(F.array_sort(F.collect_set(F.char_length("_rp"))).alias("_lengths"))

    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    urls = placed.select("host", "path").distinct().join(F.broadcast(lengths))  # lengths is one row
    tried = (
        urls.withColumn("_h", F.explode(F.array_distinct(suffixes)))
        .withColumn("_l", F.explode(F.filter("_lengths", lambda n: n <= F.char_length("path"))))
        .select("host", "path", "_h", F.expr("substring(path, 1, _l)").alias("_p"))
        .withColumn("_d", _digest(F.col("_h"), F.col("_p")))
        .withColumn("_short", F.substring("_d", 1, SHORT))
    )
    sure = (F.col("_d") == F.col("_rd")) & (F.col("_h") == F.col("_rh")) & (F.col("_p") == F.col("_rp"))
    rank = F.struct(
        F.char_length("_rh") + F.char_length("_rp"), F.char_length("_rh"), F.col("_verdict"), F.col("_rule")
    )
    best = (
        tried.join(keyed, "_short").where(sure).groupBy("host", "path")
        .agg(F.max(rank).alias("_best"))
        .select(F.col("host").alias("on_host"), F.col("path").alias("on_path"), F.col("_best._rule").alias("rule"), F.col("_best._verdict").alias("verdict"))
    )
    same = (placed["host"] == best["on_host"]) & (placed["path"] == best["on_path"])
    return placed.join(best, same, "left").select(
        *(placed[c] for c in kept), placed["host"], placed["path"], best["rule"], F.coalesce(best["verdict"], F.lit(default)).alias("verdict")
    )
