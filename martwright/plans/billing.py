"""Subscription billing activation mart: first charge per instrument with an activation decision."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BillingConfig
from ..functions import as_of_day, days_between, map_code, pair, regex_flag, zero_if_null
from ..operators.joins import attach, first_per_key
from ..operators.signals import first_match
from ..operators.temporal import with_neighbors

Tables = Mapping[str, DataFrame]

# ISO-3166 alpha-3 codes, account managers, processor texts, same-country pairs.
COUNTRY_NAMES = {
    "USA": "United States",
    "VNM": "Vietnam",
    "GBR": "United Kingdom",
    "CAN": "Canada",
    "AUS": "Australia",
    "DEU": "Germany",
    "FRA": "France",
    "SGP": "Singapore",
    "HKG": "Hong Kong",
    "KOR": "South Korea",
    "JPN": "Japan",
}
MANAGED_ACCOUNTS = (
    (10000001, "Enterprise_CSM_NorthAmerica"),
    (10000002, "Enterprise_CSM_NorthAmerica"),
    (10000003, "Enterprise_CSM_EMEA"),
    (10000004, "Enterprise_CSM_APAC"),
)
CRITICAL_REJECTS = "stolen_card|unauthorized_card|pickup_card"
TEMPORARY_FAILURES = "insufficient_funds|card_declined|expired_card"
HOME_PAIRS = (
    "United States-United States", "Vietnam-Vietnam", "United Kingdom-United Kingdom", "Canada-Canada",
)


def account_managers(accounts: Iterable[tuple[int, str]] = MANAGED_ACCOUNTS) -> dict[int, str]:
    """One owner per account; of several the largest name."""
    owners: dict[int, str] = {}
    for account, owner in accounts:
        owners[account] = max(owner, owners.get(account, owner))
    return owners


def manager_of(merchant_id: Column, accounts: Iterable[tuple[int, str]] = MANAGED_ACCOUNTS) -> Column:
    """The account's owner or empty, from a map literal."""
    entries = [c for k, v in account_managers(accounts).items() for c in (F.lit(k).cast("bigint"), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*entries), merchant_id.cast("bigint")), F.lit(""))


def lifetime_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("is_test") == 0).groupBy("merchant_id").agg(
        F.max("order_created_at").alias("latest_order_date"), F.count("order_id").alias("total_lifetime_orders")
    )


def pending_invoices(invoices: DataFrame, cfg: BillingConfig = BillingConfig()) -> DataFrame:
    return invoices.filter(F.col("payment_status") == cfg.pending_status).groupBy("merchant_id").agg(
        F.count("invoice_id").alias("count_pending_invoices"),
        F.sum("invoice_amount").alias("total_pending_invoice_amount"),
    )


def plan_sequence(invoices: DataFrame, piece: str | Column = "day") -> DataFrame:
    """Previous and next plan of the merchant for every invoice."""
    return with_neighbors(
        invoices.select("invoice_id", "merchant_id", "created_at", "plan_type"),
        ["merchant_id"], "created_at", "invoice_id", "plan_type", piece=piece,
    )


def external_charges(charges: DataFrame, merchants: DataFrame, cfg: BillingConfig = BillingConfig()) -> DataFrame:
    """Charges of merchants with a known, non-internal e-mail."""
    known = merchants.filter(~F.col("email").contains(cfg.internal_mail_mark)).select(
        F.col("id").alias("merchant_id"), F.col("email").alias("merchant_email"),
        F.col("created_at").alias("merchant_created_at"),
    )
    return charges.join(known, "merchant_id")


def first_charges(charges: DataFrame) -> DataFrame:
    """The earliest charge of each instrument; charges without one count as one instrument."""
    return first_per_key(
        charges,
        ["payment_instrument_id"],
        [F.col("billing_event_timestamp").asc_nulls_last(), F.col("billing_event_id").asc_nulls_last()],
    )


def is_seasoned(cfg: BillingConfig = BillingConfig()) -> Column:
    tenured = F.col("merchant_tenure_days") >= cfg.tenured_days
    return F.when(tenured & (F.col("total_lifetime_orders") >= cfg.tenured_orders), 1).otherwise(0)


def staged_charges(
    tables: Tables, cfg: BillingConfig = BillingConfig(), as_of=None, with_plans: bool = False
) -> DataFrame:
    """First charges with order history, pending invoices and tenure.

    The first charge is picked before the per-merchant results are joined, and those are joined
    with each other first, so the charges are shuffled once for both. The plan sequence is no
    input of the decision and is added on request.
    """
    charges = first_charges(external_charges(tables["fact_billing_charge_event"], tables["dim_merchant"], cfg))
    history = lifetime_orders(tables["dim_order"]).join(
        pending_invoices(tables["fact_subscription_invoice"], cfg), "merchant_id", "full"
    )
    staged = attach(charges, history, "merchant_id").withColumns({
        "count_pending_invoices": zero_if_null("count_pending_invoices"),
        "total_pending_invoice_amount": zero_if_null("total_pending_invoice_amount"),
        "merchant_tenure_days": days_between(as_of_day(as_of), F.col("merchant_created_at")),
    })
    if with_plans:
        plans = plan_sequence(tables["fact_subscription_invoice"]).select(
            "invoice_id", "subsequent_plan_type", "previous_plan_type"
        )
        staged = staged.join(plans, "invoice_id", "left")
    return staged


def with_decision_inputs(staged: DataFrame, cfg: BillingConfig = BillingConfig()) -> DataFrame:
    """Add owner, card country, seasoning, country pair and the three flags."""
    message = "gateway_error_message"
    return staged.withColumns({
        "enterprise_csm_owner": manager_of(F.col("merchant_id")),
        "normalized_card_issuing_country": map_code("card_issuing_country_code", COUNTRY_NAMES, "UNKNOWN"),
        "is_seasoned_merchant": is_seasoned(cfg),
        "flag_critical_processor_reject": regex_flag(message, CRITICAL_REJECTS),
        "flag_temporary_billing_failure": regex_flag(message, TEMPORARY_FAILURES),
        "flag_pending_invoice_balance_high": F.when(
            F.col("total_pending_invoice_amount") >= cfg.max_pending_amount, 1
        ).otherwise(0),
    }).withColumn("country_affinity_pair", pair("merchant_country", "normalized_card_issuing_country"))


def activation_status() -> Column:
    c = F.col
    return first_match(
        [
            (c("flag_critical_processor_reject") == 1, "SUSPEND_UNAUTHORIZED_INSTRUMENT"),
            (c("enterprise_csm_owner") != "", "ACTIVATE_ENTERPRISE_VIP"),
            (c("flag_temporary_billing_failure") == 1, "RETRY_ALTERNATIVE_PAYMENT_METHOD"),
            (c("flag_pending_invoice_balance_high") == 1, "HOLD_FOR_BILLING_RECONCILIATION"),
            (
                ~c("country_affinity_pair").isin(*HOME_PAIRS) & (c("is_seasoned_merchant") == 0),
                "FLAG_CROSS_BORDER_VALIDATION",
            ),
        ],
        "ACTIVATE_FULL_SERVICE",
    )


def billing_activation(
    tables: Tables, cfg: BillingConfig = BillingConfig(), as_of=None, sort: bool = True
) -> DataFrame:
    mart = with_decision_inputs(staged_charges(tables, cfg, as_of), cfg).select(
        "billing_event_id", "merchant_id", "merchant_email", "merchant_country",
        "normalized_card_issuing_country", "country_affinity_pair", "billing_amount", "enterprise_csm_owner",
        "total_pending_invoice_amount", "is_seasoned_merchant",
        activation_status().alias("automated_activation_status"),
    )
    return mart.orderBy(F.col("billing_event_id").desc_nulls_first()) if sort else mart
