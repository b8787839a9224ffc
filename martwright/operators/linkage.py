"""Accounts that share an instrument, address or subnet.

A shared value links its accounts to one of them (a star), never pair by pair, so a value shared
by very many accounts costs one row per account.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import address_key, blank_to_null, norm_key
from ..session import discard, written
from .joins import attach
from .networks import longest_prefix

#: A network of fewer fixed bits belongs to a carrier rather than to an office, and links nobody.
SUBNET_BITS = 24


def linkage_attributes(
    instruments: DataFrame, addresses: DataFrame, sessions: DataFrame, prefixes: DataFrame, entity: str = "account_id",
    instrument: str = "instrument", address: str = "address", ip: str = "ip_address", prefix: str = "prefix",
    subnet_bits: int = SUBNET_BITS,
) -> DataFrame:
    """(entity, attribute, value): what accounts may share, for :func:`link_entities` and :func:`account_groups`.

    Instruments are compared without case and outer spaces, business addresses without case, punctuation and spacing.
    A session address stands for the most specific known network that holds it, if that has ``subnet_bits`` or more.
    """
    nets = longest_prefix(sessions.select(entity, ip).distinct(), ip, prefixes, prefix, "_net")
    return (
        instruments.select(entity, F.lit("instrument").alias("attribute"), blank_to_null(norm_key(instrument)).alias("value"))
        .unionByName(addresses.select(entity, F.lit("address").alias("attribute"), address_key(address).alias("value")))
        .unionByName(
            nets.select(entity, F.lit("subnet").alias("attribute"), F.when(F.col("_net_length") >= subnet_bits, F.col("_net_prefix")).alias("value"))
        )
    )


def link_entities(df: DataFrame, entity: str, attribute: str, value: str) -> DataFrame:
    """Star edges (attribute, value, anchor, entity, group_size) of every shared value.

    The anchor is the smallest entity of the group and is listed as well.
    """
    members = df.select(attribute, value, entity).filter(f"{value} is not null and {entity} is not null").distinct()
    groups = (
        members.groupBy(attribute, value)
        .agg(F.min(entity).alias("anchor"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )
    return attach(members, groups, [attribute, value], "inner")


def linkage_signal(df: DataFrame, entity: str, attribute: str, value: str) -> DataFrame:
    """Per entity: shared values, the largest group it is in, and the 0/1 signal."""
    stars = link_entities(df, entity, attribute, value)
    linked = stars.groupBy(entity).agg(
        F.count(F.lit(1)).alias("shared_values"), F.max("group_size").alias("largest_group")
    )
    return (
        df.select(entity).filter(F.col(entity).isNotNull()).distinct()
        .join(linked, entity, "left")
        .fillna(0, ["shared_values", "largest_group"])
        .withColumn("sig_cross_account_linkage", F.when(F.col("shared_values") > 0, 1).otherwise(0))
    )


def account_groups(stars: DataFrame, entity: str, anchor: str = "anchor") -> DataFrame:
    """Connected components of the links: (entity, group_id = smallest member).

    Each round re-hangs every node's larger neighbours on its smallest known neighbour (large
    star) and then its smaller ones (small star), until a round changes nothing, which digests of
    the links before and after it tell. Edge rows never grow in number beyond the input's, and
    both steps aggregate map-side. Every round is written to the shared folder, so a lost executor
    does not replay the rounds before it; the round before the last is then deleted.
    """
    spark = stars.sparkSession
    edges, path = written(
        stars.filter(F.col(entity) != F.col(anchor))
        .select(F.greatest(entity, anchor).alias("node"), F.least(entity, anchor).alias("low"))
        .distinct(),
        "account-links",
    )
    digest = _digest(edges)
    while True:
        hung, hung_path = written(_small_star(_large_star(edges)), "account-links")
        after = _digest(hung)
        discard(spark, path)
        edges, path = hung, hung_path
        if after == digest:
            break
        digest = after
    members = edges.select(F.col("node").alias(entity), F.col("low").alias("group_id"))
    roots = edges.select(F.col("low").alias(entity), F.col("low").alias("group_id")).distinct()
    return members.unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    """Number of links and two digests of them."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "low")), F.bit_xor(F.xxhash64("low", F.lit(1), "node"))
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours on the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = both.groupBy("node").agg(F.min("low").alias("_least")).withColumn("_least", F.least("node", "_least"))
    return (
        attach(both.filter("low > node"), least, "node", "inner")
        .select(F.col("low").alias("node"), F.col("_least").alias("low"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("node").agg(F.min("low").alias("_least"))
    moved = attach(edges, least, "node", "inner").filter("low <> _least").select(
        F.col("low").alias("node"), F.col("_least").alias("low")
    )
    return moved.unionByName(least.select("node", F.col("_least").alias("low"))).distinct()
