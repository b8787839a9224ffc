import pytest
from pyspark.sql import functions as F

from martwright.config import CheckoutConfig
from martwright.plans import checkout

AS_OF = "2026-09-30"
PLAIN = dict(
    shop_id=1, merchant_id=1, checkout_id=1, is_test=0, order_created_at="2026-09-29 10:00:00", gmv=100, merchant_profit=10,
    base_cost_margin=0.5, is_same_store_public_domain=1, order_traffic_source="google",
)
GATEWAYS = {
    "dim_gateway_a_transaction": "response_reason", "dim_gateway_b_transaction": "response_reason",
    "map_paypal_checkout": "response_message", "dim_stripe_payment_intent": "failed_reason",
}
MAPPINGS = {
    "ref_gateway_a_response_mapping": "description", "ref_gateway_b_response_mapping": "description",
    "ref_paypal_response_mapping": "response_message", "ref_stripe_response_mapping": "error_message",
}


@pytest.fixture
def mart_tables(role):
    def build(*orders, declined=()):
        tables = {name: role(name, *({"checkout_id": c, text: " Do Not Honor "} for c in declined)) for name, text in GATEWAYS.items()}
        tables |= {name: role(name, {text: "do not honor", "signal_code": "DECLINE_X"}) for name, text in MAPPINGS.items()}
        tables["dim_merchant"] = role("dim_merchant", {"id": 1, "email": "m@x"})
        tables["dim_store"] = role("dim_store", {"shop_id": 1, "merchant_id": 1, "domain": " Shop.X "})
        tables["dim_order"] = role("dim_order", *({**PLAIN, "order_id": i, **o} for i, o in enumerate(orders)))
        return tables

    return build


def by_id(df, *columns):
    return {r.order_id: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_actions_in_priority_order(mart_tables):
    tables = mart_tables(
        {},
        {"payment_attempt": 11}, {"payment_attempt": 12}, {"gateway_latency_ms": 75},
        {"checkout_id": 9, "gmv": 5000},
        {"base_cost_margin": None, "is_same_store_public_domain": 0},
        {"base_cost_margin": 0.1, "gmv": 250}, {"base_cost_margin": 0.1, "gmv": 249.99, "merchant_profit": 1},
        {"merchant_profit": -80}, {"gmv": 1000},
        {"billing_shipping_match": "not match", "distance_billing_to_shipment": "1000.1"},
        {"billing_shipping_match": "not match", "distance_billing_to_shipment": "1000"},
        {"billing_shipping_match": "not match", "distance_billing_to_shipment": "abc"},
        declined=[9],
    )
    got = by_id(checkout.checkout_routing(tables, as_of=AS_OF), "prescribed_routing_action", "routing_telemetry_codes")
    auto, fallback = "Auto-Route to Primary Gateway", "Route to Fallback Gateway"
    margin, second = "Hold for Margin Reconciliation", "Route to Secondary Validation"
    assert got == {
        0: (auto, ""), 1: (auto, ""), 2: (fallback, "RETRY_BURST"), 3: (fallback, "GATEWAY_LATENCY"),
        4: (fallback, "GATEWAY_DECLINE HIGH_ORDER_VALUE"), 5: ("Hold for Catalog Audit", "LOW_UNIT_MARGIN"),
        6: (margin, "LOW_UNIT_MARGIN"), 7: (auto, "LOW_UNIT_MARGIN"), 8: (margin, ""), 9: (second, "HIGH_ORDER_VALUE"),
        10: (second, "GEO_DISTANCE_OUTLIER"), 11: (auto, ""), 12: (auto, ""),
    }


def test_window_edge_test_orders_and_order(mart_tables):
    tables = mart_tables(
        {"order_created_at": "2026-09-22 00:00:00"}, {"order_created_at": "2026-09-21 23:59:59"},
        {"is_test": 1}, {"is_test": None}, {},
    )
    assert [r.order_id for r in checkout.checkout_routing(tables, as_of=AS_OF).collect()] == [4, 0]


def test_null_profit_and_zero_gmv(mart_tables):
    tables = mart_tables({"merchant_profit": None, "gmv": 0}, {"merchant_profit": 5, "gmv": 0}, {"order_traffic_source": " Direct "})
    evaluated = checkout.evaluated_orders(checkout.prepared_orders(tables, as_of=AS_OF))
    got = by_id(evaluated, "profit_margin", "sig_negative_profit_margin", "sig_direct_traffic_origin")
    assert got == {0: (0.0, 1, 0), 1: (0.0, 0, 0), 2: (0.1, 0, 1)}


def test_null_traffic_is_not_direct_and_blank_is(mart_tables):
    tables = mart_tables({"order_traffic_source": None}, {"order_traffic_source": "  "})
    evaluated = checkout.evaluated_orders(checkout.prepared_orders(tables, as_of=AS_OF))
    assert by_id(evaluated, "sig_direct_traffic_origin") == {0: 0, 1: 1}


@pytest.mark.parametrize(
    ("column", "below", "at", "signal"),
    [
        ("payment_attempt", 11, 12, "sig_excessive_retry_burst"),
        ("gateway_latency_ms", 74, 75, "sig_high_gateway_latency"),
        ("no_order_customer_email_per_day", 4, 5, "sig_buyer_velocity_spike"),
        ("count_order_cancel_refund_by_buyer_email", 7, 8, "sig_buyer_return_history"),
        ("shipping_match_ip_country", "match", "not match", "sig_shipping_ip_mismatch"),
        ("shipping_match_card_country", "", "not match", "sig_shipping_card_country_mismatch"),
        ("billing_match_card_country", "match", "zip doesn't match", "sig_billing_avs_mismatch"),
        ("billing_shipping_match", "match", "not match", "sig_billing_shipping_mismatch"),
        ("distance_billing_to_shipment", "1000", "1000.5", "sig_geo_distance_outlier"),
        ("gmv", 999.99, 1000, "sig_high_value_order"),
        ("merchant_profit", 0.01, 0, "sig_negative_profit_margin"),
        ("merchant_profit", 79.99, 80, "sig_abnormal_high_margin"),
        ("base_cost_margin", 0.11, 0.1, "sig_near_zero_base_cost_margin"),
        ("total_quantity", 9, 10, "sig_bulk_item_quantity"),
        ("is_same_store_public_domain", 1, 0, "sig_non_public_domain_store"),
        ("order_traffic_source", "google", "", "sig_direct_traffic_origin"),
    ],
)
def test_signal_thresholds(spark, column, below, at, signal):
    """Each signal is 0 just below its bound, 1 at it, and 0 for an unknown value."""
    base = dict(
        has_decline=False, payment_attempt=1, gateway_latency_ms=1, no_order_customer_email_per_day=1,
        count_order_cancel_refund_by_buyer_email=1, shipping_match_ip_country="match", shipping_match_card_country="match",
        billing_match_card_country="match", billing_shipping_match="match", distance_billing_to_shipment="1", gmv=100,
        merchant_profit=10, base_cost_margin=0.5, total_quantity=1, is_same_store_public_domain=1,
        order_traffic_source="google",
    )
    rows = [{**base, column: v} for v in (below, at, None)]
    types = {"has_decline": "boolean"} | {c: "string" for c, v in base.items() if isinstance(v, str)}
    df = spark.createDataFrame(
        [tuple(None if r[c] is None else (r[c] if c == "has_decline" else str(r[c])) for c in base) for r in rows],
        ", ".join(f"{c} {'boolean' if c == 'has_decline' else 'string'}" for c in base),
    ).select(*(F.col(c).cast(types.get(c, "double")).alias(c) for c in base))
    df = df.withColumn("distance_billing_to_shipment", F.col("distance_billing_to_shipment").cast("double"))
    df = df.withColumn("profit_margin", F.abs("merchant_profit") / F.col("gmv"))
    wanted = next(s for s in checkout.routing_signals(CheckoutConfig()) if s.name == signal)
    assert [r[0] for r in df.select(wanted.flag).collect()] == [0, 1, 0]


def test_list_form_and_flag_form_agree(mart_tables):
    tables = mart_tables({}, {"checkout_id": 9}, {"checkout_id": None}, declined=[9, 9, 4])
    lists = checkout.prepared_orders(tables, as_of=AS_OF)
    flags = checkout.prepared_orders(tables, as_of=AS_OF, code_lists=False)
    assert by_id(lists, "has_decline") == by_id(flags, "has_decline") == {0: False, 1: True, 2: False}
    assert by_id(lists, "gateway_a_signals", "gateway_b_signals")[1] == ("DECLINE_X", "DECLINE_X,DECLINE_X")
