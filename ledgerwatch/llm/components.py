"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.session import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``label``, the smallest node of its component, for every node with a link.

    ``edges`` has two columns of one orderable type; direction, repeats and loops don't matter and
    null ends are ignored. Alternating large-star and small-star rounds end after about log(n) of
    them. Each round is written to the shared folder, which cuts the lineage, and every round but
    the first only reads the one before. A hub's rows meet in a plain join, which Spark may split.
    """
    a, b = edges.columns
    links = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    links = stored(links, "links")
    seen = _state(links)
    while seen[0]:
        links = stored(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == seen:
            break
        seen = now
    leaves = links.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
    roots = links.select(F.col("lo").alias("node")).distinct().withColumn("label", F.col("node"))
    return leaves.unionByName(roots)


def _state(links: DataFrame) -> tuple:
    """Number of links and a sum over them that changes with any of them."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(links.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
