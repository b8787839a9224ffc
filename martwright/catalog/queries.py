"""Every mart, stage and operator as a named query over the sample star.

Each callable takes (spark, folder) and reads whole tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..config import BillingConfig, CheckoutConfig, ConsolidatedConfig, MerchantHealthConfig, SettlementConfig
from ..functions import as_of_day, days_between, map_code, pair, pct_text, regex_flag, safe_div, zero_if_null
from ..operators import features, gateways, linkage, metrics, networks, ranges, registry
from ..operators.adjustments import apply_adjustments
from ..operators.joins import filter_ids, id_list, with_config
from ..operators.partials import DayStore, LastDays, Measure, days_of
from ..operators.temporal import as_of_join, rolling_per_event, time_bounds
from ..plans import billing, checkout, consolidated, merchant360, settlement, triage
from ..session import shared_dir, written
from ..snapshots import SnapshotTable
from ..sources.files import read_csv, write_csv, write_mart, write_run_metrics
from ..sources.layout import KeyedLayout
from ..sources.sample_star import EVENT_K, EVENTS_AS_OF, ORDERS_AS_OF, PENDING, SampleStar, cents, money, scaled

Query = Callable[[SparkSession, str], DataFrame]

CONSOLIDATED = ConsolidatedConfig(since=dt.date(1996, 1, 1))
ALL_DAYS = 4000
# Decision thresholds are the defaults; windows reach back over the whole sample where a query says "history".
CHECKOUT_HISTORY = CheckoutConfig(lookback_days=ALL_DAYS)
HEALTH = MerchantHealthConfig()
HEALTH_HISTORY = replace(HEALTH, active_days=ALL_DAYS)
SETTLEMENT = SettlementConfig(pending_status=PENDING)
SETTLEMENT_HISTORY = replace(SETTLEMENT, flag_order_age_days=ALL_DAYS)
BILLING = BillingConfig(pending_status=PENDING)

_REGISTRY: dict[str, Callable[[SampleStar], DataFrame]] = {}


def _register(fn: Callable[[SampleStar], DataFrame]) -> Callable[[SampleStar], DataFrame]:
    _REGISTRY[fn.__name__] = fn
    return fn


def _report(df: DataFrame) -> DataFrame:
    """Exact decimals leave the library as doubles, the reports' money type."""
    return df.withColumns({
        f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, DecimalType)
    })


def queries() -> dict[str, Query]:
    def bind(build: Callable[[SampleStar], DataFrame]) -> Query:
        return lambda spark, folder: _report(build(SampleStar(spark, folder)))

    return {name: bind(build) for name, build in _REGISTRY.items()}


# ---- consolidated merchant mart ------------------------------------------------------------


@_register
def consolidated_merchant_mart(star: SampleStar) -> DataFrame:
    return consolidated.consolidated_merchant(star, CONSOLIDATED)


@_register
def five_visual_merge(star: SampleStar) -> DataFrame:
    return consolidated.five_visual_merge(star, CONSOLIDATED)


@_register
def visual_1_profile(star: SampleStar) -> DataFrame:
    return consolidated.visual_profile(star)


@_register
def visual_2_recent(star: SampleStar) -> DataFrame:
    return consolidated.visual_recent(star, CONSOLIDATED)


@_register
def visual_3_sessions(star: SampleStar) -> DataFrame:
    return consolidated.visual_sessions(star)


@_register
def visual_4_velocity(star: SampleStar) -> DataFrame:
    return consolidated.visual_velocity(star, CONSOLIDATED)


@_register
def visual_5_disputes(star: SampleStar) -> DataFrame:
    return consolidated.visual_disputes(star)


# ---- checkout routing ----------------------------------------------------------------------


@_register
def checkout_routing_mart(star: SampleStar) -> DataFrame:
    return checkout.checkout_routing(star, as_of=ORDERS_AS_OF)


@_register
def checkout_routing_history(star: SampleStar) -> DataFrame:
    return checkout.checkout_routing(star, CHECKOUT_HISTORY, ORDERS_AS_OF, recent_responses=False)


class _WithFeatures(SampleStar):
    """The sample star whose orders carry the buyer features."""

    def __getitem__(self, role: str) -> DataFrame:
        return super().__getitem__("dim_order_with_features" if role == "dim_order" else role)


def _evaluated(star: SampleStar) -> DataFrame:
    prepared = checkout.prepared_orders(
        _WithFeatures(star.spark, star.folder), CHECKOUT_HISTORY, ORDERS_AS_OF, code_lists=False, store_domain=False,
        recent_responses=False,
    )
    return checkout.evaluated_orders(prepared, CHECKOUT_HISTORY)


@_register
def routing_signals(star: SampleStar) -> DataFrame:
    return _evaluated(star).select("order_id", *(s.name for s in checkout.routing_signals()))


@_register
def routing_rules(star: SampleStar) -> DataFrame:
    return _evaluated(star).select(
        "order_id", *(r.name for r in checkout.routing_rules()),
        checkout.routing_action().alias("prescribed_routing_action"),
    )


@_register
def routing_codes(star: SampleStar) -> DataFrame:
    return _evaluated(star).select("order_id", checkout.telemetry_codes().alias("routing_telemetry_codes"))


@_register
def gateway_codes_distinct(star: SampleStar) -> DataFrame:
    return gateways.code_list_of(checkout.gateways(star)["gateway_a"], "gateway_a")


@_register
def gateway_codes_all(star: SampleStar) -> DataFrame:
    return gateways.code_list_of(checkout.gateways(star)["gateway_b"], "gateway_b")


@_register
def gateway_normalized(star: SampleStar) -> DataFrame:
    return gateways.gateway_code_lists(checkout.gateways(star))


@_register
def gateway_code_counts(star: SampleStar) -> DataFrame:
    return gateways.normalize_gateways(checkout.gateways(star))


# ---- merchant 360 --------------------------------------------------------------------------


@_register
def merchant_360_mart(star: SampleStar) -> DataFrame:
    return merchant360.merchant_360(star, HEALTH, ORDERS_AS_OF)


@_register
def active_storefronts(star: SampleStar) -> DataFrame:
    return merchant360.active_storefronts(star["dim_order"], star["dim_merchant"], as_of=ORDERS_AS_OF)


@_register
def merchant_tiers(star: SampleStar) -> DataFrame:
    return star["fact_merchant_daily_metrics"].select(
        "shop_id", "avg_gmv_l30d", merchant360.segment_tier().alias("merchant_segment_tier")
    )


@_register
def merchant_health_codes(star: SampleStar) -> DataFrame:
    coded = merchant360.with_health_codes(
        merchant360.base_metrics(star, HEALTH_HISTORY, ORDERS_AS_OF), HEALTH_HISTORY
    )
    return coded.select("shop_id", *(s.name for s in merchant360.health_signals()), "aggregated_health_signals")


@_register
def rate_text(star: SampleStar) -> DataFrame:
    day = as_of_day(ORDERS_AS_OF)
    rates = (
        "disposable_email_rate", "invalid_email_rate", "multi_store_buyer_rate", "dispute_order_ratio",
        "payment_failure_rate_primary_gateway", "pct_direct_traffic_l30d",
    )
    return star["fact_merchant_daily_metrics"].select(
        "shop_id", F.date_format(day, "yyyy-MM-dd").alias("calculation_date"),
        F.weekofyear(day).alias("reporting_week"), *(pct_text(r).alias(r) for r in rates),
    )


@_register
def merchant_daily_metrics(star: SampleStar) -> DataFrame:
    return star.windowed_metrics


@_register
def daily_metrics_incremental(star: SampleStar) -> DataFrame:
    """The daily metrics from stored partials: first without a late batch, then with its days computed again."""
    orders, events = star["dim_order_large"], star["funnel_events"]
    store = features.DailyMetrics(star.spark, _scratch(star, "daily-metrics"), orders.schema, events.schema)
    month = [F.col("order_created_at") >= F.date_sub(F.lit(ORDERS_AS_OF), 31), F.col("order_created_at") < F.lit(ORDERS_AS_OF)]
    recent = orders.filter(month[0] & month[1])
    late = F.col("order_id") % 40 == 3
    store.refresh_orders(orders.filter(~late), days_of(recent.filter(~late), "order_created_at"))
    store.refresh_orders(orders, days_of(recent.filter(late), "order_created_at"))
    store.refresh_events(events, days_of(events, "created_at"))
    return store.metrics(ORDERS_AS_OF, EVENTS_AS_OF)


@_register
def restricted_registry_match(star: SampleStar) -> DataFrame:
    return registry.restricted_merchants(
        star["fact_merchant_payout_setting"], star["ref_restricted_account_registry"]
    )


# ---- settlement ----------------------------------------------------------------------------


@_register
def restricted_destination_as_of(star: SampleStar) -> DataFrame:
    return registry.restricted_destinations_as_of(
        star["fact_settlement_request"], star["fact_merchant_payout_change"], star["ref_restricted_account_change"]
    )


@_register
def restricted_destination_check(star: SampleStar) -> DataFrame:
    return registry.restricted_destinations(
        settlement.pending_requests(star["fact_settlement_request"], SETTLEMENT),
        star["fact_merchant_payout_setting"], star["ref_restricted_account_registry"],
    )


@_register
def settlement_mart(star: SampleStar) -> DataFrame:
    return settlement.settlement_reconciliation(star, SETTLEMENT, ORDERS_AS_OF)


@_register
def settlement_mart_as_of(star: SampleStar) -> DataFrame:
    return settlement.settlement_reconciliation(star, SETTLEMENT, ORDERS_AS_OF, balances_as_of_request=True)


@_register
def settlement_mart_exclude_self(star: SampleStar) -> DataFrame:
    return settlement.settlement_reconciliation(star, SETTLEMENT, ORDERS_AS_OF, exclude_self=True)


@_register
def shipment_flags(star: SampleStar) -> DataFrame:
    return settlement.reconciled_orders(
        star["fact_order_daily"], star["fact_order_shipment"], SETTLEMENT_HISTORY, ORDERS_AS_OF
    )


@_register
def dispute_reserve(star: SampleStar) -> DataFrame:
    return settlement.dispute_reserves(star["fact_chargebacks"], star["dim_store"], SETTLEMENT)


@_register
def variance_exposure(star: SampleStar) -> DataFrame:
    return settlement.variance_exposure(star, SETTLEMENT, ORDERS_AS_OF)


@_register
def portfolio_dispute_rate(star: SampleStar) -> DataFrame:
    return settlement.portfolio_summary(star, SETTLEMENT)


@_register
def ledger_balance(star: SampleStar) -> DataFrame:
    return settlement.ledger_balance(star, SETTLEMENT)


@_register
def settlement_triage(star: SampleStar) -> DataFrame:
    shops = consolidated.consolidated_merchant(star, CONSOLIDATED).select(
        "shop_id", F.col("total_gmv").alias("requested_amount"), "dispute_rate", "direct_traffic_ratio"
    )
    return triage.settlement_triage(shops)


# ---- billing -------------------------------------------------------------------------------


class _BillingStar(SampleStar):
    """The sample star with the billing mart's own merchant ids."""

    OWN = {"dim_order": "billing_order", "dim_merchant": "billing_merchant"}

    def __getitem__(self, role: str) -> DataFrame:
        return super().__getitem__(self.OWN.get(role, role))


@_register
def billing_activation_mart(star: SampleStar) -> DataFrame:
    return billing.billing_activation(_BillingStar(star.spark, star.folder), BILLING, EVENTS_AS_OF)


@_register
def plan_neighbors(star: SampleStar) -> DataFrame:
    return billing.plan_sequence(star["fact_subscription_invoice"]).select(
        "invoice_id", "previous_plan_type", "subsequent_plan_type"
    )


@_register
def first_instrument_attempt(star: SampleStar) -> DataFrame:
    return billing.first_charges(
        star["fact_billing_charge_event"].select(
            "billing_event_id", "payment_instrument_id", "billing_event_timestamp"
        )
    )


@_register
def card_country_names(star: SampleStar) -> DataFrame:
    return star["fact_billing_charge_event"].select(
        "billing_event_id",
        map_code("card_issuing_country_code", billing.COUNTRY_NAMES, "UNKNOWN").alias(
            "normalized_card_issuing_country"
        ),
    )


@_register
def country_affinity(star: SampleStar) -> DataFrame:
    name = map_code("card_issuing_country_code", billing.COUNTRY_NAMES, "UNKNOWN")
    return star["fact_billing_charge_event"].select(
        "billing_event_id", pair(F.col("merchant_country"), name).alias("country_affinity_pair")
    )


@_register
def processor_reject_flags(star: SampleStar) -> DataFrame:
    message = "gateway_error_message"
    return star["fact_billing_charge_event"].select(
        "billing_event_id",
        regex_flag(message, billing.CRITICAL_REJECTS).alias("flag_critical_processor_reject"),
        regex_flag(message, billing.TEMPORARY_FAILURES).alias("flag_temporary_billing_failure"),
    )


@_register
def lifetime_orders(star: SampleStar) -> DataFrame:
    return billing.lifetime_orders(star.billing_order)


@_register
def pending_invoices(star: SampleStar) -> DataFrame:
    return billing.pending_invoices(star["fact_subscription_invoice"], BILLING)


@_register
def csm_lookup(star: SampleStar) -> DataFrame:
    return star["fact_billing_charge_event"].select(
        "billing_event_id", "merchant_id", billing.manager_of(F.col("merchant_id")).alias("enterprise_csm_owner")
    )


@_register
def seasoned_merchants(star: SampleStar) -> DataFrame:
    cfg = replace(BILLING, tenured_orders=600)
    merchants = star.billing_merchant.select(F.col("id").alias("merchant_id"), "created_at")
    history = billing.lifetime_orders(star.billing_order).select("merchant_id", "total_lifetime_orders")
    return (
        merchants.join(history, "merchant_id", "left")
        .withColumn("merchant_tenure_days", days_between(as_of_day(EVENTS_AS_OF), F.col("created_at")))
        .transform(with_config, cfg)
        .select(
            "merchant_id", "merchant_tenure_days", "total_lifetime_orders", "cfg_tenured_days", "cfg_tenured_orders",
            billing.is_seasoned(cfg).alias("is_seasoned_merchant"),
        )
    )


# ---- metric dictionary ---------------------------------------------------------------------


@_register
def disputed_rate(star: SampleStar) -> DataFrame:
    return metrics.disputed_rate(star["store_profile"])


@_register
def secondary_failure_rate(star: SampleStar) -> DataFrame:
    return metrics.secondary_failure_rate(star["store_profile"])


@_register
def buyer_cancel_rate(star: SampleStar) -> DataFrame:
    original = metrics.buyer_cancel_rate(star["store_profile"], star["support_tickets"])
    plain = metrics.buyer_cancel_rate(star["store_profile"], star["support_tickets"], repeat_denominator=False)
    return original.join(
        plain.withColumnRenamed("pct_buyer_requested_cancel", "pct_buyer_requested_cancel_plain"), "shop_id"
    )


@_register
def restricted_keyword_rate(star: SampleStar) -> DataFrame:
    return metrics.restricted_keyword_rate(star["store_profile"])


@_register
def avg_profit_3d(star: SampleStar) -> DataFrame:
    return metrics.avg_profit_last_days(star["dim_order"], ORDERS_AS_OF)


@_register
def max_line_gmv_3d_anchored(star: SampleStar) -> DataFrame:
    return metrics.max_line_gmv_anchored(star["dim_order"], ORDERS_AS_OF)


@_register
def direct_order_ratio(star: SampleStar) -> DataFrame:
    return metrics.direct_order_ratio(star["dim_order"])


@_register
def ip_location_tier(star: SampleStar) -> DataFrame:
    return metrics.ip_location_tier(star["user_profile"])


@_register
def view_to_purchase_3d(star: SampleStar) -> DataFrame:
    return metrics.view_to_purchase(star["event_product"])


# ---- anchored windows ----------------------------------------------------------------------


@_register
def rolling_per_event_value(star: SampleStar) -> DataFrame:
    events = star.raw("events").select(
        "event_id", "user_id", "ts", "event_type", F.expr(money(cents("value"))).alias("amount")
    )
    purchases = events.filter("event_type = 'purchase'")
    return rolling_per_event(
        purchases, events, "event_id", "user_id", "ts", "ts", 3,
        {"amount_3d": F.col("amount"), "events_3d": F.lit(1).cast("bigint")}, bounds=time_bounds(purchases, "ts"),
    )


@_register
def ledger_as_of_request(star: SampleStar) -> DataFrame:
    requests = star["fact_settlement_request"]
    snapshots = requests.filter(F.col("status") != PENDING).select(
        "merchant_id", F.col("created_at").alias("recorded_at"), F.col("settlement_id").alias("snapshot_id"),
        F.col("requested_amount").alias("available_balance"),
    ).withColumn("balance_at", F.col("recorded_at"))
    pending = settlement.pending_requests(requests, SETTLEMENT).select(
        "settlement_id", "merchant_id", "requested_amount", "settlement_requested_at"
    )
    return as_of_join(
        pending, snapshots, "merchant_id", "settlement_requested_at", "recorded_at",
        ["balance_at", "available_balance"], tie="snapshot_id",
    )


@_register
def settlement_anchored_gmv(star: SampleStar) -> DataFrame:
    requests = star["fact_settlement_request"]
    disputed = star.disputes.select(F.col("order_id").alias("settlement_id"), F.lit(1).alias("_disputed")).distinct()
    sales = requests.join(disputed, "settlement_id", "left").select(
        "merchant_id", "created_at", F.col("requested_amount").alias("gmv"), zero_if_null("_disputed").alias("disputed")
    )
    pending = settlement.pending_requests(requests, SETTLEMENT)
    windows = rolling_per_event(
        pending, sales, "settlement_id", "merchant_id", "settlement_requested_at",
        "created_at", 3,
        {"gmv_3d": F.col("gmv"), "orders_3d": F.lit(1).cast("bigint"), "disputed_3d": F.col("disputed").cast("bigint")},
        bounds=time_bounds(pending, "settlement_requested_at"),
    )
    return windows.withColumn("dispute_rate_3d", safe_div("disputed_3d", "orders_3d"))


# ---- features ------------------------------------------------------------------------------


@_register
def buyer_velocity(star: SampleStar) -> DataFrame:
    return features.buyer_velocity(star["dim_order"]).select("order_id", "no_order_customer_email_per_day")


@_register
def buyer_velocity_at_order(star: SampleStar) -> DataFrame:
    orders = star["dim_order"].select("order_id", "buyer_email", "order_created_at")
    return features.buyer_velocity_at_order(orders).select("order_id", "buyer_orders_so_far_that_day")


@_register
def buyer_history(star: SampleStar) -> DataFrame:
    return features.buyer_history(star["dim_order"]).select(
        "order_id", "count_order_of_customer", "count_order_cancel_refund_by_buyer_email"
    )


@_register
def card_features(star: SampleStar) -> DataFrame:
    return features.card_features(_card_orders(star))


@_register
def order_card_features(star: SampleStar) -> DataFrame:
    return features.order_card_features(_card_orders(star).filter("order_id is not null")).select(
        "order_id", "count_customer_by_card", "avg_payment_intent_by_card_per_day"
    )


def _card_orders(star: SampleStar) -> DataFrame:
    return star.raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.date_format("o_orderdate", "MMdd"), F.substring("o_orderpriority", 1, 1)).alias("card_token"),
        F.col("o_custkey").alias("buyer_email"),
        F.col("o_orderdate").alias("order_created_at"),
    )


@_register
def tracking_reuse(star: SampleStar) -> DataFrame:
    return features.tracking_reuse(star.shipments_by_customer).select(
        "order_id", "tracking_number", "distinct_customers_same_tracking"
    )


@_register
def geo_features(star: SampleStar) -> DataFrame:
    place = star.raw("nation").select(
        "n_nationkey", "n_name", (F.col("n_nationkey") * 6.5 - 78).alias("lat"), (F.col("n_nationkey") * 13.5 - 160).alias("lon")
    )
    homes = star.raw("customer").select("c_custkey", "c_nationkey")
    stores = star.raw("supplier").select("s_suppkey", "s_nationkey")
    bill = place.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("billing_country"),
        F.col("lat").alias("billing_lat"), F.col("lon").alias("billing_lon"),
    )
    ship = place.select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("shipping_country"),
        F.col("lat").alias("shipping_lat"), F.col("lon").alias("shipping_lon"),
    )
    orders = (
        star.raw("orders").withColumnRenamed("o_orderkey", "order_id")
        .join(star.order_lines.select("order_id", F.col("shop_id").alias("s_suppkey")), "order_id", "left")
        .join(homes.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left")
        .join(stores, "s_suppkey", "left")
        .join(bill, "c_nationkey", "left")
        .join(ship, "s_nationkey", "left")
        .withColumn("ip_country", F.when(F.col("o_orderpriority") != "5-LOW", F.col("billing_country")))
        .withColumn("card_country", F.when(F.col("o_orderstatus") == "F", F.col("shipping_country")).otherwise(
            F.col("billing_country")))
    )
    return features.geo_features(orders).select(
        "order_id", "shipping_match_ip_country", "shipping_match_card_country", "ip_match_card_country",
        "billing_match_card_country", "billing_shipping_match",
        F.round("distance_billing_to_shipment", 2).alias("distance_billing_to_shipment"),
    )


@_register
def email_quality(star: SampleStar) -> DataFrame:
    return features.email_quality(star["dim_order"], star.disposable_domains)


@_register
def multi_store_rate(star: SampleStar) -> DataFrame:
    return features.multi_store_rate(star["dim_order"])


@_register
def ip_footprint(star: SampleStar) -> DataFrame:
    return features.ip_footprint(star["web_sessions"])


@_register
def ip_footprint_windows(star: SampleStar) -> DataFrame:
    """Distinct session addresses per shop over several windows, from one stored sketch per shop and day."""
    sessions = star.raw("events").select(
        F.col("user_id").alias("shop_id"), "ts", F.concat(F.lit("10.0.0."), F.expr(EVENT_K)).alias("ip_address")
    )
    store = DayStore(star.spark, _scratch(star, "ip-footprint"), ["shop_id"], "ts", [Measure("ips", "distinct", F.col("ip_address"))])
    store.refresh(sessions, days_of(sessions, "ts"))
    wanted = [LastDays(f"unique_ips_l{n}d", "ips", n) for n in (3, 7, 30)]
    return store.windows(store.schema(sessions), EVENTS_AS_OF, wanted)


def _shared_attributes(star: SampleStar) -> DataFrame:
    """Customers with the payment fingerprint of each order, their address and the subnets they were used from."""
    price_class = F.floor(F.col("o_totalprice") / 20000).cast("int")
    token = F.concat_ws("|", F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority", "o_orderstatus", price_class)
    paid = star.raw("orders").select(F.col("o_custkey").alias("account_id"), token.alias("instrument"))
    return linkage.linkage_attributes(paid, star["account_address"], star["account_session"], star["ref_network_prefix"])


@_register
def network_prefixes(star: SampleStar) -> DataFrame:
    sessions = star["account_session"].select("event_id", "ip_address")
    return networks.longest_prefix(sessions, "ip_address", star["ref_network_prefix"])


@_register
def account_links(star: SampleStar) -> DataFrame:
    return linkage.link_entities(_shared_attributes(star), "account_id", "attribute", "value")


@_register
def account_linkage_signal(star: SampleStar) -> DataFrame:
    return linkage.linkage_signal(_shared_attributes(star), "account_id", "attribute", "value")


@_register
def account_groups(star: SampleStar) -> DataFrame:
    stars = linkage.link_entities(_shared_attributes(star), "account_id", "attribute", "value")
    return linkage.account_groups(stars, "account_id")


def _purchases_and_sessions(star: SampleStar) -> tuple[DataFrame, DataFrame]:
    events = star.raw("events").withColumn("ip", F.concat(F.lit("10.0.0."), F.expr(EVENT_K)))
    purchases = events.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("order_id"), "user_id", F.col("ts").alias("ordered_at"), F.col("ip").alias("order_ip")
    )
    sessions = events.filter("event_type in ('view', 'click')").select(
        F.col("event_id").alias("session_id"), "user_id", F.col("ts").alias("seen_at"), F.col("ip").alias("ip_address")
    )
    return purchases, sessions


@_register
def session_ip_mismatch(star: SampleStar) -> DataFrame:
    purchases, sessions = _purchases_and_sessions(star)
    return features.session_ip_mismatch(
        purchases, sessions, "user_id", "ordered_at", "seen_at", "24 hours"
    ).select("order_id", "order_ip", "session_ip", "sig_order_session_ip_mismatch")


@_register
def session_ip_any_mismatch(star: SampleStar) -> DataFrame:
    purchases, sessions = _purchases_and_sessions(star)
    return ranges.session_ip_any_mismatch(purchases, sessions, "order_id", "user_id", "ordered_at", "seen_at").drop("user_id", "ordered_at")


# ---- ids, adjustments, sinks ---------------------------------------------------------------


def _scratch(star: SampleStar, name: str) -> str:
    """A new folder that executors share, which goes with the session."""
    empty = star.spark.createDataFrame([], "nothing int")
    return f"{written(empty, name)[1]}/table"


def _console(star: SampleStar) -> DataFrame:
    """Customers as console rows: 50 to a page; some ids are names and not numeric."""
    return star.raw("customer").select(
        F.floor(F.col("c_custkey") / 50).cast("bigint").alias("page_no"),
        "c_custkey",
        F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_name")).otherwise(
            F.concat(F.lit(" "), F.col("c_custkey"))
        ).alias("shown_id"),
        "c_acctbal",
    )


@_register
def id_pages(star: SampleStar) -> DataFrame:
    return id_list(_console(star), "shown_id", ["page_no"], ["c_custkey"])


@_register
def filter_by_ids(star: SampleStar) -> DataFrame:
    pasted = id_list(_console(star).filter("c_acctbal < 0"), "shown_id", ["page_no"], ["c_custkey"]).select("id_text")
    return filter_ids(
        star.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", pasted
    )


@_register
def merged_adjustments(star: SampleStar) -> DataFrame:
    base = star["fact_settlement_request"].select(
        "settlement_id", "requested_amount", "status", F.col("created_at").alias("version_at")
    )
    updates = star.raw("lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("settlement_id"), F.expr(money(scaled("l_extendedprice", 30))).alias("requested_amount"),
        F.lit("adjusted").alias("status"), F.col("l_shipdate").alias("version_at"),
    )
    return apply_adjustments(base, updates, "settlement_id", "version_at", tie="requested_amount")


@_register
def sink_round_trip(star: SampleStar) -> DataFrame:
    """Triage rows written as CSV to the shared folder and read back with the declared schema."""
    rows = settlement_triage(star).select(
        F.col("shop_id").cast("string").alias("settlement_id"),
        F.lit(None).cast("string").alias("merchant_id"),
        F.col("shop_id").cast("string").alias("shop_id"),
        F.lit(None).cast("string").alias("merchant_country"),
        F.col("requested_amount").cast("double").alias("requested_amount"),
        "dispute_rate", "direct_traffic_ratio",
        F.lit(None).cast("double").alias("conversion_rate_3d"),
        "automated_reconciliation_status", "reconciliation_rule_summary",
    )
    path = f"{shared_dir(star.spark)}/triage"
    write_csv(rows, path, mode="overwrite")
    return read_csv(star.spark, path, "settlement_signals").drop("merchant_id", "merchant_country", "conversion_rate_3d")


@_register
def mart_sink(star: SampleStar) -> DataFrame:
    """The consolidated mart written as Parquet to the shared folder and read back."""
    path = f"{shared_dir(star.spark)}/mart-sink"
    write_mart(consolidated_merchant_mart(star), path, mode="overwrite")
    return star.spark.read.parquet(path)


@_register
def mart_snapshot(star: SampleStar) -> DataFrame:
    """The consolidated mart published twice as a snapshot and read back, after older snapshots were retired."""
    table, mart = SnapshotTable(star.spark, _scratch(star, "mart-snapshot")), consolidated_merchant_mart(star)
    table.replace(mart.limit(0))
    table.replace(mart)
    table.retire(keep=1)
    return table.read(mart.schema)


@_register
def consolidated_mart_stored(star: SampleStar) -> DataFrame:
    """The consolidated mart over tables stored by shop: facts are joined and grouped where they lie."""
    roles = ("merchants", "orders", "web_sessions", "disputes")
    buckets = int(star.spark.conf.get("spark.sql.shuffle.partitions"))
    layout = KeyedLayout(star.spark, _scratch(star, "layout"), f"layout_{uuid.uuid4().hex}", "shop_id", buckets)
    layout.write(star.only(*roles))
    return layout.per_key(lambda tables: consolidated.consolidated_merchant(tables, CONSOLIDATED), roles)


@_register
def run_metrics_sink(star: SampleStar) -> DataFrame:
    """Run statistics written as JSON lines to the shared folder and read back."""
    path, stats = f"{shared_dir(star.spark)}/run-metrics", run_statistics(star)
    write_run_metrics(stats, path, mode="overwrite")
    return star.spark.read.schema(stats.schema).json(path)


@_register
def run_statistics(star: SampleStar) -> DataFrame:
    timings = star.raw("events").select("event_type", "value", F.expr(EVENT_K).cast("int").alias("records"))
    stats = metrics.run_statistics(timings, "event_type", "value", "records")
    return stats.withColumns({n: F.round(n, 4) for n in ("mean_ms", "std_ms", "records_per_sec")})


@_register
def run_speed_up(star: SampleStar) -> DataFrame:
    timings = star.raw("events").select("event_type", "value", F.expr(EVENT_K).cast("int").alias("records"))
    wide = metrics.speed_up(
        metrics.run_statistics(timings, "event_type", "value", "records"), "event_type", "view", "click"
    )
    return wide.withColumns({n: F.round(n, 4) for n in wide.columns})
