"""Declared schemas of the role tables, as Spark DDL. ``money`` columns are decimal(18,2)."""

from __future__ import annotations

from pyspark.sql.types import StructType

MONEY = "decimal(18,2)"

DDL = {
    # Benchmark star
    "merchants": "shop_id bigint, user_id bigint, created_at timestamp, is_public_domain int, "
    "payout_email string, country string",
    "orders": f"order_id bigint, shop_id bigint, order_created_at timestamp, gmv {MONEY}, "
    f"merchant_profit {MONEY}, base_cost {MONEY}, payment_gateway string, traffic_source string, "
    "order_status string, buyer_email string, buyer_ip string, shipping_country string, "
    "card_country string, payment_attempts int",
    "web_sessions": "session_id bigint, shop_id bigint, ip_address string, event_name string, created_at timestamp",
    "disputes": f"dispute_id bigint, order_id bigint, shop_id bigint, reason string, amount {MONEY}, "
    "created_at timestamp",
    # Checkout
    "dim_gateway_a_transaction": "checkout_id bigint, response_reason string",
    "dim_gateway_b_transaction": "checkout_id bigint, response_reason string",
    "map_paypal_checkout": "checkout_id bigint, response_message string",
    "dim_stripe_payment_intent": "checkout_id bigint, failed_reason string",
    "ref_gateway_a_response_mapping": "description string, signal_code string",
    "ref_gateway_b_response_mapping": "description string, signal_code string",
    "ref_paypal_response_mapping": "response_message string, signal_code string",
    "ref_stripe_response_mapping": "error_message string, signal_code string",
    # Core
    "dim_order": "order_id bigint, order_name string, shop_id bigint, merchant_id bigint, checkout_id bigint, "
    "order_created_at timestamp, is_test int, buyer_email string, payment_gateway string, "
    f"order_traffic_source string, gmv {MONEY}, merchant_profit {MONEY}, base_cost_margin double, "
    "total_quantity int, line_item_count int, payment_attempt int, gateway_latency_ms int, "
    "count_order_of_customer int, no_order_customer_email_per_day int, total_store_customer_buy int, "
    "count_order_cancel_refund_by_buyer_email int, avg_payment_intent_by_card_per_day double, "
    "count_customer_by_card int, distance_billing_to_shipment string, shipping_distance double, "
    "billing_distance double, shipping_match_ip_country string, shipping_match_card_country string, "
    "billing_match_card_country string, ip_match_card_country string, billing_shipping_match string, "
    "cvv_result string, cvc_check string, address_line1_check string, address_postal_code_check string, "
    "is_3d_secured_request int, ip_proxy int, buyer_email_match_merchant_email int, "
    "is_same_ip_country_order_created int, is_same_store_public_domain int, "
    f"max_raw_price_lineitem {MONEY}, account_tier_updated_at timestamp, referring_site_label string",
    "dim_merchant": "id bigint, email string, created_at timestamp",
    "dim_store": "shop_id bigint, merchant_id bigint, domain string, store_segment string, "
    "total_order_count bigint, total_disputed_orders bigint",
    "fact_merchant_daily_metrics": "shop_id bigint, merchant_id bigint, disposable_email_rate double, "
    "invalid_email_rate double, multi_store_buyer_rate double, unique_ip_location_count bigint, "
    "merchant_country string, merchant_city string, total_order_count bigint, dispute_order_ratio double, "
    "payment_failure_rate_primary_gateway double, payment_failure_rate_secondary_gateway double, "
    "total_disputed_orders bigint, total_refunded_orders bigint, avg_profit_l3d double, avg_profit_l7d double, "
    "avg_profit_l30d double, avg_gmv_l3d double, avg_gmv_l7d double, avg_gmv_l30d double, "
    f"max_lineitem_gmv_l3d {MONEY}, max_lineitem_gmv_l7d {MONEY}, cr_view_to_purchase_l3d double, "
    "cr_view_to_purchase_l7d double, cr_view_to_purchase_l30d double, pct_direct_traffic_l3d double, "
    "pct_direct_traffic_l7d double, pct_direct_traffic_l30d double, pct_social_traffic_l30d double",
    "fact_order_daily": f"order_id bigint, shop_id bigint, order_amount {MONEY}, order_created_at timestamp, "
    f"dispute_id bigint, refund_amount {MONEY}, tracking_number string, "
    "distinct_customers_same_tracking int, tracking_dest_country string, shipping_country_name string",
    # Finance and fulfilment
    "fact_settlement_request": f"settlement_id bigint, merchant_id bigint, store_segment string, "
    f"requested_amount {MONEY}, reserve_hold_amount {MONEY}, created_at timestamp, status string",
    "fact_merchant_payout_setting": "merchant_id bigint, payout_destination_email string",
    "ref_restricted_account_registry": "restricted_email string",
    # Change logs of the two: a null destination removes a setting, is_listed says whether an account is listed from then on
    "fact_merchant_payout_change": "merchant_id bigint, setting_id int, change_id int, payout_destination_email string, "
    "changed_at timestamp",
    "ref_restricted_account_change": "restricted_email string, change_id int, is_listed boolean, changed_at timestamp",
    # What accounts may share
    "account_address": "account_id bigint, address string",
    "account_session": "event_id bigint, account_id bigint, ip_address string",
    "ref_network_prefix": "prefix string",
    "fact_chargebacks": f"shop_id bigint, order_id bigint, dispute_amount_usd {MONEY}, status string",
    "fact_merchant_account_balance": f"merchant_id bigint, available_balance {MONEY}, "
    f"rolling_reserve_balance {MONEY}",
    "fact_merchant_balance_history": f"merchant_id bigint, balance_id bigint, recorded_at timestamp, "
    f"available_balance {MONEY}, rolling_reserve_balance {MONEY}",
    "fact_order_shipment": "order_id bigint, first_carrier_scan_at timestamp",
    # Billing
    "fact_subscription_invoice": f"invoice_id bigint, merchant_id bigint, invoice_amount {MONEY}, "
    "payment_status string, plan_type string, created_at timestamp",
    "fact_billing_charge_event": "billing_event_id bigint, merchant_id bigint, payment_instrument_id bigint, "
    "invoice_id bigint, billing_event_timestamp timestamp, merchant_country string, instrument_last4 string, "
    f"billing_amount {MONEY}, card_holder_name string, card_issuing_country_code string, "
    "gateway_response_code string, gateway_error_message string",
    # Metric dictionary
    "store_profile": "shop_id bigint, order_id bigint, total_order bigint, count_disputed_order_total bigint, "
    "count_failed_gateway_secondary bigint, dispute_contain_restricted_keywords_count bigint",
    "support_tickets": "order_id bigint, shop_id bigint, ticket_type string",
    "event_product": "shop_id bigint, total_session_purchase_l3d bigint, total_session_view_content_l3d bigint",
    "user_profile": "ip_location string",
    # Triage rows, as exported
    "settlement_signals": "settlement_id string, merchant_id string, shop_id string, merchant_country string, "
    "requested_amount double, dispute_rate double, direct_traffic_ratio double, conversion_rate_3d double, "
    "automated_reconciliation_status string, reconciliation_rule_summary string",
}


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(DDL[table])
