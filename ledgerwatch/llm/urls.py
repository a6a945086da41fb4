"""URL rules found through hashed host and path expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.session import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; null or no ``://``: empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """``rule``, ``verdict``, length of its path, 32-bit prefix and full digest of its expression.

    ``rules`` has ``host``, ``path`` and ``verdict``; hosts are lower case and not empty, a path is
    empty or begins with ``/``. Of rules on the same host and path ``block`` wins over ``allow``.
    """
    rule = F.concat("host", "path")
    one = rules.where("host != '' AND path IS NOT NULL AND verdict IS NOT NULL").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    digest = _digest(rule)
    return one.select(rule.alias("rule"), "verdict", "host", F.length("path").alias("path_length"), F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("prefix"), digest.alias("digest"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule`` and ``verdict`` for every row of ``pages``.

    A rule fits its host and all its subdomains if the path begins with the rule's; of several the
    longest wins (then the one with the longer host). Without a rule the verdict is ``default`` and
    ``rule`` is null.

    Each different host and path is expanded once: all suffixes of the host at label limits, with
    those prefixes of the path whose length some rule has. Expressions meet rules on 32-bit prefixes
    of their SHA-256, and full digests confirm. Urls that are repeated, null or without ``://`` keep
    their rows; an empty list of rules leaves all to ``default``.
    """
    listed = stored(prepared_rules(rules), "rules")
    lengths = listed.agg(F.sort_array(F.collect_set("path_length")).alias("lengths"))  # at most as many as a url has characters
    judged = pages.select(F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = judged.where("host != ''").select("host", "path").distinct().join(F.broadcast(lengths))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.expr("transform(filter(lengths, n -> n <= length(path)), n -> left(path, n))")
    spread = urls.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes")).select("host", "path", "suffix", F.explode("prefixes").alias("start"))
    hashed = spread.select("host", "path", _digest(F.concat("suffix", "start")).alias("digest"))
    hashed = hashed.withColumn("prefix", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"))
    hits = hashed.join(listed.select("prefix", F.col("digest").alias("full"), "rule", "verdict", F.length("host").alias("host_length")), "prefix").where("digest = full")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "host_length", "rule", "verdict")).alias("best"))
    out = judged.join(best, ["host", "path"], "left")
    return out.select(F.col("_id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
