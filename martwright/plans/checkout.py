"""Checkout routing mart: one row per recent order with telemetry codes and a routing action."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CheckoutConfig
from ..functions import as_of_day, blank_to_null, norm_key, safe_div, zero_if_null
from ..operators.gateways import Gateway, checkouts_with_code, gateway_code_lists
from ..operators.joins import attach
from ..operators.signals import Signal, add_flags, code_string, first_match

Tables = Mapping[str, DataFrame]

DECLINE = "DECLINE"

# Columns by the clean-up they get.
UNCHANGED = (
    "shop_id", "order_id", "order_name", "order_created_at", "checkout_id", "payment_gateway",
    "total_store_customer_buy", "cvv_result", "is_3d_secured_request", "shipping_match_ip_country",
    "billing_shipping_match", "ip_proxy", "buyer_email_match_merchant_email",
    "is_same_ip_country_order_created", "is_same_store_public_domain",
)
LOWERED = ("buyer_email", "cvc_check", "address_line1_check", "address_postal_code_check")
BLANK_TO_NULL = ("shipping_match_card_country", "billing_match_card_country", "ip_match_card_country")
NULL_TO_ZERO = (
    "count_order_of_customer", "no_order_customer_email_per_day", "shipping_distance", "billing_distance",
    "gateway_latency_ms", "gmv", "merchant_profit", "total_quantity", "line_item_count", "payment_attempt",
    "base_cost_margin", "avg_payment_intent_by_card_per_day", "count_customer_by_card",
    "count_order_cancel_refund_by_buyer_email",
)


def gateways(tables: Tables) -> dict[str, Gateway]:
    """The four response sources; A and Stripe list distinct codes, B and PayPal all of them."""
    return {
        "gateway_a": Gateway(
            tables["dim_gateway_a_transaction"], "response_reason",
            tables["ref_gateway_a_response_mapping"], "description", True, ", ",
        ),
        "gateway_b": Gateway(
            tables["dim_gateway_b_transaction"], "response_reason",
            tables["ref_gateway_b_response_mapping"], "description", False, ",",
        ),
        "paypal": Gateway(
            tables["map_paypal_checkout"], "response_message",
            tables["ref_paypal_response_mapping"], "response_message", False, ",",
        ),
        "stripe": Gateway(
            tables["dim_stripe_payment_intent"], "failed_reason",
            tables["ref_stripe_response_mapping"], "error_message", True, ",",
        ),
    }


def _cleaned(orders: DataFrame) -> list[Column]:
    """The clean-up of every order column that is present; absent optional ones read as NULL."""

    def col(name: str) -> Column:
        return F.col(name) if name in orders.columns else F.lit(None)

    margin = F.when(F.col("merchant_profit").isNull(), 0.0).otherwise(
        zero_if_null(safe_div(F.abs("merchant_profit"), "gmv"))
    )
    return [
        *(col(n).alias(n) for n in UNCHANGED),
        *(F.lower(col(n).cast("string")).alias(n) for n in LOWERED),
        *(blank_to_null(col(n).cast("string")).alias(n) for n in BLANK_TO_NULL),
        *(zero_if_null(col(n)).alias(n) for n in NULL_TO_ZERO),
        zero_if_null(F.col("distance_billing_to_shipment").try_cast("double")).alias("distance_billing_to_shipment"),
        norm_key("order_traffic_source").alias("order_traffic_source"),
        margin.alias("profit_margin"),
        F.col("merchant_id"),
    ]


def recent_orders(tables: Tables, cfg: CheckoutConfig, as_of) -> DataFrame:
    """Live orders of the lookback window; both conditions reach the file scan."""
    start = F.date_sub(as_of_day(as_of), cfg.lookback_days)
    return tables["dim_order"].filter((F.col("is_test") == 0) & (F.col("order_created_at") >= start))


def prepared_orders(
    tables: Tables, cfg: CheckoutConfig = CheckoutConfig(), as_of=None, code_lists: bool = True,
    store_domain: bool = True, recent_responses: bool = True,
) -> DataFrame:
    """Cleaned orders with merchant, store and gateway telemetry.

    With ``code_lists`` every gateway's codes are added as text. Without, there is only
    ``has_decline``, which is all the routing rules need and costs no text aggregation. With
    ``recent_responses`` only the responses to these orders are looked at, which pays where the
    lookback is short. ``store_domain`` adds ``shop_domain``.
    """
    live = recent_orders(tables, cfg, as_of)
    orders = live.select(*_cleaned(live))
    merchants = tables["dim_merchant"].select(F.col("id").alias("merchant_id"), F.col("email").alias("merchant_email"))
    named = orders.join(merchants, "merchant_id", "left")
    if store_domain:
        stores = tables["dim_store"].select("shop_id", norm_key("domain").alias("shop_domain"))
        named = named.join(stores, "shop_id", "left")
    if code_lists:
        lists = gateway_code_lists(gateways(tables))
        declined = F.lit(False)
        for name in gateways(tables):
            declined = declined | F.coalesce(F.col(f"{name}_signals").contains(DECLINE), F.lit(False))
        return attach(named, lists, "checkout_id").withColumn("has_decline", declined)
    hits = checkouts_with_code(gateways(tables), DECLINE, live if recent_responses else None).withColumn("has_decline", F.lit(True))
    return attach(named, hits, "checkout_id").withColumn(
        "has_decline", F.coalesce(F.col("has_decline"), F.lit(False))
    )


def routing_signals(cfg: CheckoutConfig = CheckoutConfig()) -> list[Signal]:
    c = F.col
    return [
        Signal("sig_gateway_decline_received", c("has_decline"), "GATEWAY_DECLINE"),
        Signal("sig_excessive_retry_burst", c("payment_attempt") >= cfg.critical_retry, "RETRY_BURST"),
        Signal("sig_high_gateway_latency", c("gateway_latency_ms") >= cfg.latency_cutoff_ms, "GATEWAY_LATENCY"),
        Signal("sig_buyer_velocity_spike", c("no_order_customer_email_per_day") >= cfg.buyer_orders_per_day),
        Signal("sig_buyer_return_history", c("count_order_cancel_refund_by_buyer_email") >= cfg.buyer_returns),
        Signal("sig_shipping_ip_mismatch", c("shipping_match_ip_country") == "not match"),
        Signal("sig_shipping_card_country_mismatch", c("shipping_match_card_country") == "not match"),
        Signal("sig_billing_avs_mismatch", c("billing_match_card_country").contains("doesn't match")),
        Signal("sig_billing_shipping_mismatch", c("billing_shipping_match") == "not match"),
        Signal(
            "sig_geo_distance_outlier",
            c("distance_billing_to_shipment") > cfg.max_geo_distance_miles,
            "GEO_DISTANCE_OUTLIER",
        ),
        Signal("sig_high_value_order", c("gmv") >= cfg.high_order_value, "HIGH_ORDER_VALUE"),
        Signal("sig_negative_profit_margin", c("merchant_profit") <= 0),
        Signal("sig_abnormal_high_margin", c("profit_margin") >= cfg.abnormal_margin_ratio),
        Signal("sig_near_zero_base_cost_margin", c("base_cost_margin") <= cfg.near_zero_margin, "LOW_UNIT_MARGIN"),
        Signal("sig_bulk_item_quantity", c("total_quantity") >= cfg.bulk_quantity),
        Signal("sig_non_public_domain_store", c("is_same_store_public_domain") == 0),
        Signal("sig_direct_traffic_origin", c("order_traffic_source").isin("direct", ""), "DIRECT_TRAFFIC"),
    ]


# The codes in the order in which they are printed.
CODE_ORDER = (
    "GATEWAY_DECLINE", "RETRY_BURST", "GATEWAY_LATENCY", "GEO_DISTANCE_OUTLIER", "DIRECT_TRAFFIC",
    "HIGH_ORDER_VALUE", "LOW_UNIT_MARGIN",
)


def routing_rules(cfg: CheckoutConfig = CheckoutConfig()) -> list[Signal]:
    """Composite rules over the 0/1 signals, strongest first; the code is the action."""

    def on(name: str) -> Column:
        return F.col(name) == 1

    thin = on("sig_near_zero_base_cost_margin")
    return [
        Signal(
            "rule_trigger_fallback_gateway",
            on("sig_gateway_decline_received") | on("sig_excessive_retry_burst") | on("sig_high_gateway_latency"),
            "Route to Fallback Gateway",
        ),
        Signal(
            "rule_unlisted_catalog_variance", thin & on("sig_non_public_domain_store"), "Hold for Catalog Audit"
        ),
        Signal(
            "rule_pricing_reconciliation_hold",
            on("sig_abnormal_high_margin") | (thin & (F.col("gmv") >= cfg.medium_order_value)),
            "Hold for Margin Reconciliation",
        ),
        Signal(
            "rule_secondary_validation_required",
            (on("sig_billing_shipping_mismatch") & on("sig_geo_distance_outlier")) | on("sig_high_value_order"),
            "Route to Secondary Validation",
        ),
    ]


def evaluated_orders(prepared: DataFrame, cfg: CheckoutConfig = CheckoutConfig()) -> DataFrame:
    """Add the 17 signals and the 4 rules to prepared orders."""
    return prepared.transform(add_flags, routing_signals(cfg)).transform(add_flags, routing_rules(cfg))


def telemetry_codes(cfg: CheckoutConfig = CheckoutConfig()) -> Column:
    coded = {s.code: Signal(s.name, F.col(s.name) == 1, s.code) for s in routing_signals(cfg) if s.code}
    return code_string([coded[code] for code in CODE_ORDER])


def routing_action(cfg: CheckoutConfig = CheckoutConfig()) -> Column:
    return first_match([(F.col(r.name) == 1, r.code) for r in routing_rules(cfg)], "Auto-Route to Primary Gateway")


def checkout_routing(
    tables: Tables, cfg: CheckoutConfig = CheckoutConfig(), as_of=None, sort: bool = True,
    recent_responses: bool = True,
) -> DataFrame:
    prepared = prepared_orders(
        tables, cfg, as_of, code_lists=False, store_domain=False, recent_responses=recent_responses
    )
    evaluated = evaluated_orders(prepared, cfg)
    mart = evaluated.select(
        "order_id", "shop_id", "order_name", "order_created_at", "merchant_email", "buyer_email", "gmv",
        "merchant_profit", "profit_margin", "payment_gateway", "order_traffic_source",
        telemetry_codes(cfg).alias("routing_telemetry_codes"),
        routing_action(cfg).alias("prescribed_routing_action"),
    )
    # The order id splits the rows of a hot instant over the sort's ranges.
    return mart.orderBy(F.col("order_created_at").desc_nulls_first(), F.col("order_id").desc()) if sort else mart
