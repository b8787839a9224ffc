"""Payment-gateway responses as one long table of signal codes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import norm_key, repeated
from .joins import attach


@dataclass(frozen=True)
class Gateway:
    """One gateway's transactions and its response mapping, with the text columns' names."""

    transactions: DataFrame
    text: str
    mapping: DataFrame
    mapping_text: str
    distinct: bool = True
    separator: str = ","


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _responses(gateways: Mapping[str, Gateway]) -> DataFrame:
    return _stack([
        g.transactions.select("checkout_id", F.lit(name).alias("gateway"), norm_key(g.text).alias("_key"))
        for name, g in gateways.items()
    ])


def _codes(gateways: Mapping[str, Gateway]) -> DataFrame:
    return _stack([
        g.mapping.select(F.lit(name).alias("gateway"), norm_key(g.mapping_text).alias("_key"), "signal_code")
        for name, g in gateways.items()
    ])


def normalize_gateways(gateways: Mapping[str, Gateway]) -> DataFrame:
    """All responses as (checkout_id, gateway, signal_code, hits).

    One join and one map-side combined count serve all gateways. A response without a mapping has
    a NULL code.
    """
    joined = _responses(gateways).join(_codes(gateways), ["gateway", "_key"], "left")
    return joined.groupBy("checkout_id", "gateway", "signal_code").agg(F.count(F.lit(1)).alias("hits"))


def gateway_code_lists(gateways: Mapping[str, Gateway], suffix: str = "_signals") -> DataFrame:
    """One row per checkout with one code-list column per gateway.

    The lists are built from the counted codes, so a checkout with very many retries brings one
    row per code into its group. Responses without a checkout are left out: they belong to no
    order, and their list would grow with the data.
    """
    long = normalize_gateways(gateways).filter(F.col("checkout_id").isNotNull())
    pieces, lists = {}, []
    for name, g in gateways.items():
        piece = F.col("signal_code") if g.distinct else repeated("signal_code", "hits", g.separator)
        pieces[f"_{name}"] = F.when(F.col("gateway") == name, piece)
        lists.append(
            F.expr(f"listagg(`_{name}`, '{g.separator}') within group (order by signal_code)").alias(name + suffix)
        )
    return long.withColumns(pieces).groupBy("checkout_id").agg(*lists)


def code_list_of(gateway: Gateway, name: str) -> DataFrame:
    """The code list of a single gateway per checkout."""
    return gateway_code_lists({name: gateway})


def checkouts_with_code(
    gateways: Mapping[str, Gateway], fragment: str, among: DataFrame | None = None
) -> DataFrame:
    """Checkouts that got at least one code containing ``fragment`` from any gateway.

    Only matching mapping rows take part, so most responses drop out in the join, before any
    shuffle when the mapping is small. ``among``, a table of checkout ids, cuts the responses to
    those before they are made distinct.
    """
    wanted = _codes(gateways).filter(F.col("signal_code").contains(fragment)).select("gateway", "_key").distinct()
    responses = _responses(gateways).filter(F.col("checkout_id").isNotNull())
    if among is not None:
        # Distinct ids need none of the lookups that the table was enriched with: Spark drops their joins.
        responses = responses.join(among.select("checkout_id").distinct(), "checkout_id", "left_semi")
    return attach(responses, wanted, ["gateway", "_key"], "left_semi").select("checkout_id").distinct()
