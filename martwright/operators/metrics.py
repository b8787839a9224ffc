"""Metric dictionary: each BI measure as one grouped DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    as_of_day,
    cond_max,
    contains_flag,
    delimiter_tier,
    ratio_of_sums,
    safe_div,
)
from .features import DIRECT_SOURCES
from .temporal import Rolling, rolling_as_of


def disputed_rate(store_profile: DataFrame) -> DataFrame:
    return store_profile.groupBy("shop_id").agg(
        ratio_of_sums("count_disputed_order_total", "total_order").alias("pct_orders_flagged_disputed")
    )


def secondary_failure_rate(store_profile: DataFrame) -> DataFrame:
    return store_profile.groupBy("shop_id").agg(
        ratio_of_sums("count_failed_gateway_secondary", "total_order").alias("pct_secondary_gateway_failures")
    )


def restricted_keyword_rate(store_profile: DataFrame) -> DataFrame:
    return store_profile.groupBy("shop_id").agg(
        ratio_of_sums("dispute_contain_restricted_keywords_count", "total_order").alias(
            "pct_disputes_restricted_keywords"
        )
    )


def buyer_cancel_rate(store_profile: DataFrame, support_tickets: DataFrame, repeat_denominator: bool = True) -> DataFrame:
    """Share of cancelled orders per shop.

    The original joins tickets to the profile rows by shop alone, which counts the order total once
    per cancelled order. ``repeat_denominator`` gives that result by arithmetic, without making
    the joined rows; False gives the plain share.
    """
    cancelled = (
        support_tickets.filter(contains_flag("ticket_type", ["cancel order"]) == 1)
        .select("order_id", "shop_id")
        .distinct()
        .groupBy("shop_id")
        .agg(F.count(F.lit(1)).alias("_rows"), F.count("order_id").alias("_cancelled"))
    )
    totals = store_profile.groupBy("shop_id").agg(F.sum("total_order").alias("_total"))
    joined = totals.join(cancelled, "shop_id", "left").fillna(0, ["_rows", "_cancelled"])
    times = F.greatest(F.col("_rows"), F.lit(1)) if repeat_denominator else F.lit(1)
    return joined.select(
        "shop_id", safe_div(F.col("_cancelled"), F.col("_total") * times).alias("pct_buyer_requested_cancel")
    )


def avg_profit_last_days(orders: DataFrame, as_of, days: int = 3) -> DataFrame:
    """Mean profit of the last days per shop; NULL for a shop without an order in them.

    The days are read by a pruned scan; the list of shops needs one column of the others.
    """
    name = f"avg_profit_last_{days}_days"
    spec = Rolling(name, "avg", F.col("merchant_profit"), days)
    recent = rolling_as_of(orders, ["shop_id"], "order_created_at", as_of_day(as_of), [spec])
    shops = orders.groupBy("shop_id").agg(F.lit(1).alias("_one")).drop("_one")
    same = shops["shop_id"].eqNullSafe(recent["shop_id"])
    return shops.join(recent, same, "left").select(shops["shop_id"], name)


def max_line_gmv_anchored(orders: DataFrame, as_of, days: int = 3, bounded: bool = False) -> DataFrame:
    """Largest line price since N + 1 days before the row's own anchor (else the as-of day).

    The window is open at its end; ``bounded`` closes it at the anchor.
    """
    anchor = F.coalesce(F.col("account_tier_updated_at"), as_of_day(as_of))
    at = F.col("order_created_at")
    inside = at >= anchor - F.expr(f"interval {days + 1} days")
    if bounded:
        inside = inside & (at < anchor)
    return orders.groupBy("shop_id").agg(
        cond_max(inside, "max_raw_price_lineitem").alias(f"max_lineitem_gmv_last_{days}_days")
    )


def direct_order_ratio(orders: DataFrame) -> DataFrame:
    """Share of distinct orders that came directly: grouped by order first, then counted per shop."""
    direct = F.when(F.col("referring_site_label").isin(*DIRECT_SOURCES), 1).otherwise(0)
    per_order = orders.groupBy("shop_id", "order_id").agg(F.max(direct).alias("_direct"))
    known = F.col("order_id").isNotNull()
    return per_order.groupBy("shop_id").agg(
        safe_div(F.sum(F.when(known, F.col("_direct")).otherwise(0)), F.count("order_id")).alias(
            "direct_traffic_order_ratio"
        )
    )


def ip_location_tier(profiles: DataFrame) -> DataFrame:
    return profiles.withColumn("ip_locations_count_tier", delimiter_tier("ip_location"))


def view_to_purchase(event_product: DataFrame) -> DataFrame:
    return event_product.groupBy("shop_id").agg(
        ratio_of_sums("total_session_purchase_l3d", "total_session_view_content_l3d").alias("cr_view_to_purchase_3d")
    )


def run_statistics(timings: DataFrame, run: str, elapsed_ms: str, records: str) -> DataFrame:
    """Mean, population deviation, and records per second of the runs of each form."""
    return timings.groupBy(run).agg(
        F.count(F.lit(1)).alias("rounds"),
        F.avg(elapsed_ms).alias("mean_ms"),
        F.stddev_pop(elapsed_ms).alias("std_ms"),
        safe_div(F.max(records) * 1000, F.avg(elapsed_ms)).alias("records_per_sec"),
    )


def speed_up(stats: DataFrame, run: str, base: str, other: str) -> DataFrame:
    """Speed-up and latency cut of ``other`` against ``base`` as one row."""
    wide = stats.agg(
        F.max(F.when(F.col(run) == base, F.col("mean_ms"))).alias("base_ms"),
        F.max(F.when(F.col(run) == other, F.col("mean_ms"))).alias("other_ms"),
    )
    return wide.withColumns({
        "speedup": safe_div("base_ms", "other_ms"),
        "latency_cut_pct": (F.lit(1.0) - safe_div("other_ms", "base_ms")) * 100,
    })
