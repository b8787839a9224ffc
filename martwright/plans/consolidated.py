"""Consolidated merchant mart, and the five separate result sets it replaces.

``consolidated_merchant`` reads each fact once: all measures of a fact, windowed or not, are
conditional aggregates of one grouping. ``five_visual_merge`` answers the same question with one
query per visual and serves as its cross-check.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ConsolidatedConfig
from ..functions import cond_avg, cond_count, cond_max, ratio_or_zero, zero_if_null
from ..operators.joins import merge_on
from ..operators.signals import first_match

Tables = Mapping[str, DataFrame]


def _since(cfg: ConsolidatedConfig) -> Column:
    return F.col("order_created_at") >= F.lit(cfg.since)


def _direct() -> Column:
    return F.col("traffic_source").isin("direct", "")


def _velocity(cfg: ConsolidatedConfig) -> list[Column]:
    return [
        cond_count(F.col("payment_attempts") >= cfg.high_attempts, "order_id").alias("high_attempt_orders"),
        cond_count(F.col("shipping_country") != F.col("card_country"), "order_id").alias("geo_mismatch_orders"),
    ]


def order_measures(orders: DataFrame, cfg: ConsolidatedConfig) -> DataFrame:
    recent = _since(cfg)
    return orders.groupBy("shop_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("gmv").alias("total_gmv"),
        F.sum("merchant_profit").alias("total_profit"),
        cond_avg(recent, "merchant_profit").alias("avg_profit_3d"),
        cond_max(recent, "gmv").alias("max_gmv_3d"),
        cond_count(recent & _direct(), "order_id").alias("direct_orders_3d"),
        *_velocity(cfg),
    )


def session_measures(sessions: DataFrame) -> DataFrame:
    """Distinct addresses and events. Rows are first reduced per address, which also splits a hot shop."""
    per_address = sessions.groupBy("shop_id", "ip_address").agg(F.count("session_id").alias("_events"))
    return per_address.groupBy("shop_id").agg(
        F.count("ip_address").alias("distinct_session_ips"), F.sum("_events").alias("total_events")
    )


def dispute_measures(disputes: DataFrame) -> DataFrame:
    return disputes.groupBy("shop_id").agg(
        F.count("dispute_id").alias("total_disputes"), F.sum("amount").alias("total_dispute_amount")
    )


def suggested_action(cfg: ConsolidatedConfig, dispute_rate: Column, direct_ratio: Column) -> Column:
    return first_match(
        [
            (
                (dispute_rate > cfg.max_dispute_rate)
                | (F.col("high_attempt_orders") >= cfg.max_high_attempt_orders),
                "Hold for Ledger Audit",
            ),
            (
                (F.col("total_gmv") >= cfg.large_gmv) | (F.col("geo_mismatch_orders") >= cfg.geo_mismatch_orders),
                "Tier-2 Signoff Required",
            ),
            ((F.col("is_public_domain") == 0) & (direct_ratio > cfg.direct_ratio), "Hold for Catalog Audit"),
        ],
        "Auto-Disburse Approved",
    )


MEASURES = (
    "total_orders", "total_gmv", "total_profit", "avg_profit_3d", "max_gmv_3d", "direct_orders_3d",
    "high_attempt_orders", "geo_mismatch_orders", "distinct_session_ips", "total_disputes",
    "total_dispute_amount",
)


def consolidated_merchant(tables: Tables, cfg: ConsolidatedConfig = ConsolidatedConfig()) -> DataFrame:
    """One row per shop with totals, recent performance, footprint, disputes and the action."""
    merchants = tables["merchants"].select(
        "shop_id", "user_id", "is_public_domain", F.col("country").alias("merchant_country")
    )
    mart = merge_on(
        "shop_id",
        merchants,
        order_measures(tables["orders"], cfg),
        session_measures(tables["web_sessions"]).drop("total_events"),
        dispute_measures(tables["disputes"]),
    ).withColumns({name: zero_if_null(name) for name in MEASURES})
    return mart.select(
        "shop_id", "user_id", "is_public_domain", "merchant_country", *MEASURES,
        ratio_or_zero("total_disputes", "total_orders").alias("dispute_rate"),
        ratio_or_zero("direct_orders_3d", "total_orders").alias("direct_traffic_ratio"),
    ).withColumn("suggested_action", suggested_action(cfg, F.col("dispute_rate"), F.col("direct_traffic_ratio")))


def visual_profile(tables: Tables) -> DataFrame:
    totals = tables["orders"].groupBy("shop_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("gmv").alias("total_gmv"),
        F.sum("merchant_profit").alias("total_profit"),
    )
    merchants = tables["merchants"].select(
        "shop_id", "user_id", "is_public_domain", F.col("country").alias("merchant_country")
    )
    return merchants.join(totals, "shop_id", "left").withColumn("total_orders", zero_if_null("total_orders"))


def visual_recent(tables: Tables, cfg: ConsolidatedConfig = ConsolidatedConfig()) -> DataFrame:
    return tables["orders"].filter(_since(cfg)).groupBy("shop_id").agg(
        cond_avg(None, "merchant_profit").alias("avg_profit_3d"),
        F.max("gmv").alias("max_gmv_3d"),
        cond_count(_direct(), "order_id").alias("direct_orders_3d"),
    )


def visual_sessions(tables: Tables) -> DataFrame:
    return session_measures(tables["web_sessions"])


def visual_velocity(tables: Tables, cfg: ConsolidatedConfig = ConsolidatedConfig()) -> DataFrame:
    return tables["orders"].groupBy("shop_id").agg(*_velocity(cfg))


def visual_disputes(tables: Tables) -> DataFrame:
    return dispute_measures(tables["disputes"])


def five_visual_merge(tables: Tables, cfg: ConsolidatedConfig = ConsolidatedConfig()) -> DataFrame:
    """The five result sets merged on shop, gaps filled with 0, then the same action."""
    merged = merge_on(
        "shop_id",
        visual_profile(tables),
        visual_recent(tables, cfg),
        visual_sessions(tables),
        visual_velocity(tables, cfg),
        visual_disputes(tables),
    )
    filled = merged.withColumns({name: zero_if_null(name) for name in (*MEASURES, "total_events")})
    action = suggested_action(
        cfg, ratio_or_zero("total_disputes", "total_orders"), ratio_or_zero("direct_orders_3d", "total_orders")
    )
    return filled.withColumn("suggested_action", action)
