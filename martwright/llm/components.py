"""Connected components of links between documents, as a loop of joins that settles by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.operators.joins import attach

from .textkit import stage


def components(edges: DataFrame, node: str = "a", other: str = "b") -> DataFrame:
    """(node, root): every node of the links with the smallest node of its component. Null ends are left out.

    Each round hangs every node's larger neighbours on the smallest node it knows, then its smaller ones, until all
    links are stars and nothing moves. Rows never outnumber the links. Every round is written to the shared folder.
    """
    links = stage(
        edges.filter(F.col(node) != F.col(other))
        .select(F.greatest(node, other).alias("node"), F.least(node, other).alias("low"))
        .distinct(),
        "links",
    )
    mark = _mark(links)
    while True:
        links = stage(_hang_small(_hang_large(links)), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return links.select("node", F.col("low").alias("root")).unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """Number of links and two digests of them; equal marks mean that a round changed nothing."""
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "low")), F.bit_xor(F.xxhash64("low", F.lit(1), "node"))
        ).first()
    )


def _hang_large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = both.groupBy("node").agg(F.min("low").alias("least")).withColumn("least", F.least("node", "least"))
    return (
        attach(both.filter("low > node"), least, "node", "inner")
        .select(F.col("low").alias("node"), F.col("least").alias("low"))
        .distinct()
    )


def _hang_small(links: DataFrame) -> DataFrame:
    least = links.groupBy("node").agg(F.min("low").alias("least"))
    moved = attach(links, least, "node", "inner").filter("low <> least").select(
        F.col("low").alias("node"), F.col("least").alias("low")
    )
    return moved.unionByName(least.select("node", F.col("least").alias("low"))).distinct()
