"""Merchant 360 mart: one row per active shop with health codes, tier and formatted rates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MerchantHealthConfig
from ..functions import as_of_day, pct_text, zero_if_null
from ..operators.registry import restricted_merchants
from ..operators.signals import Signal, add_codes, first_match

Tables = Mapping[str, DataFrame]


def active_storefronts(
    orders: DataFrame, merchants: DataFrame, cfg: MerchantHealthConfig = MerchantHealthConfig(), as_of=None
) -> DataFrame:
    """Shops with a live order in the window, per (shop, merchant).

    Orders are reduced to one row per pair before the merchant e-mail is joined. A shop that sold
    for two merchants has two rows.
    """
    start = F.date_sub(as_of_day(as_of), cfg.active_days)
    pairs = (
        orders.filter((F.col("is_test") == 0) & (F.col("order_created_at") >= start))
        .groupBy("shop_id", "merchant_id")
        .agg(F.max("order_created_at").cast("date").alias("latest_active_date"))
    )
    emails = merchants.groupBy(F.col("id").alias("merchant_id")).agg(F.max("email").alias("merchant_email"))
    return pairs.join(emails, "merchant_id", "left").select(
        "shop_id", "merchant_id", "merchant_email", "latest_active_date"
    )


def base_metrics(tables: Tables, cfg: MerchantHealthConfig = MerchantHealthConfig(), as_of=None) -> DataFrame:
    active = active_storefronts(tables["dim_order"], tables["dim_merchant"], cfg, as_of).drop("merchant_id")
    restricted = restricted_merchants(
        tables["fact_merchant_payout_setting"], tables["ref_restricted_account_registry"]
    )
    return (
        tables["fact_merchant_daily_metrics"]
        .join(active, "shop_id")
        .join(restricted, "merchant_id", "left")
        .withColumn("is_disbursement_restricted", zero_if_null("is_matched"))
        .drop("is_matched")
    )


def health_signals(cfg: MerchantHealthConfig = MerchantHealthConfig()) -> list[Signal]:
    c = F.col
    return [
        Signal("sig_critical_dispute", c("dispute_order_ratio") >= cfg.critical_dispute_ratio, "CRITICAL_DISPUTE_SURGE"),
        Signal(
            "sig_gateway_failure",
            c("payment_failure_rate_primary_gateway") >= cfg.high_failure_ratio,
            "HIGH_GATEWAY_FAILURE",
        ),
        Signal("sig_gmv_surge", c("avg_gmv_l3d") >= cfg.gmv_surge, "HIGH_GMV_SURGE"),
        Signal(
            "sig_disposable_emails", c("disposable_email_rate") >= cfg.high_disposable_ratio, "DISPOSABLE_BUYER_EMAIL"
        ),
        Signal(
            "sig_direct_traffic", c("pct_direct_traffic_l3d") >= cfg.direct_traffic_ratio, "UNATTRIBUTED_DIRECT_TRAFFIC"
        ),
        Signal(
            "sig_multi_store_clustering",
            c("multi_store_buyer_rate") >= cfg.multi_store_buyer_rate,
            "MULTI_STORE_BUYER_CLUSTER",
        ),
        Signal(
            "sig_restricted_disbursement", c("is_disbursement_restricted") == 1, "RESTRICTED_DISBURSEMENT_RECIPIENT"
        ),
    ]


def with_health_codes(metrics: DataFrame, cfg: MerchantHealthConfig = MerchantHealthConfig()) -> DataFrame:
    """Add the seven text signals and their concatenation."""
    signals = health_signals(cfg)
    return metrics.transform(add_codes, signals).withColumn(
        "aggregated_health_signals", F.trim(F.concat(*(F.col(s.name) for s in signals)))
    )


def segment_tier(cfg: MerchantHealthConfig = MerchantHealthConfig()) -> Column:
    gmv = F.col("avg_gmv_l30d")
    return first_match(
        [
            (gmv >= cfg.enterprise_gmv, "Tier 1 - Enterprise Merchant"),
            (gmv >= cfg.growth_gmv, "Tier 2 - Growth Merchant"),
        ],
        "Tier 3 - Standard Merchant",
    )


def merchant_360(
    tables: Tables, cfg: MerchantHealthConfig = MerchantHealthConfig(), as_of=None, sort: bool = True
) -> DataFrame:
    day = as_of_day(as_of)
    mart = with_health_codes(base_metrics(tables, cfg, as_of), cfg).select(
        F.date_format(day, "yyyy-MM-dd").alias("calculation_date"),
        "merchant_id", "merchant_email", "shop_id",
        F.weekofyear(day).alias("reporting_week"),
        segment_tier(cfg).alias("merchant_segment_tier"),
        "aggregated_health_signals",
        pct_text("disposable_email_rate").alias("disposable_email_rate"),
        pct_text("invalid_email_rate").alias("invalid_email_rate"),
        pct_text("multi_store_buyer_rate").alias("multi_store_buyer_rate"),
        "unique_ip_location_count", "merchant_country", "merchant_city", "total_order_count",
        pct_text("dispute_order_ratio").alias("dispute_order_ratio"),
        pct_text("payment_failure_rate_primary_gateway").alias("primary_gateway_failure_rate"),
        "avg_profit_l3d", "avg_profit_l7d", "avg_profit_l30d", "avg_gmv_l3d", "avg_gmv_l7d", "avg_gmv_l30d",
        "max_lineitem_gmv_l3d", "max_lineitem_gmv_l7d",
        pct_text("cr_view_to_purchase_l3d").alias("conversion_rate_3d"),
        pct_text("pct_direct_traffic_l3d").alias("direct_traffic_share_3d"),
        "is_disbursement_restricted", "flagged_destination_emails",
    )
    return mart.orderBy(F.col("shop_id").asc_nulls_last()) if sort else mart
