"""Settlement reconciliation mart: one row per pending request with exposure and decision.

Everything a request is compared with depends on its merchant alone. The facts are therefore
reduced per shop and per merchant first, joined there (all sides already partitioned by
merchant), and met by the requests in one last join that can split a hot merchant. Grain: settlement_id is unique.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SettlementConfig
from ..functions import as_of_day, days_between, ratio_of_sums, zero_if_null
from ..operators.joins import attach
from ..operators.numbering import running_totals
from ..operators.registry import restricted_destinations_as_of, restricted_merchants
from ..operators.signals import first_match
from ..operators.temporal import as_of_join

Tables = Mapping[str, DataFrame]

# The shipment flags that count as exposure.
EXPOSED_FLAGS = (
    "destination_country_mismatch", "unfulfilled_exceeds_14d", "carrier_scan_precedes_order",
    "duplicate_tracking_number",
)


def pending_requests(requests: DataFrame, cfg: SettlementConfig = SettlementConfig()) -> DataFrame:
    return requests.filter(F.col("status") == cfg.pending_status).select(
        "settlement_id", "merchant_id", "store_segment", "requested_amount", "reserve_hold_amount",
        F.col("created_at").alias("settlement_requested_at"),
    )


def first_scans(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("order_id").agg(F.min("first_carrier_scan_at").alias("first_carrier_scan_at"))


def shipment_flag(cfg: SettlementConfig, as_of) -> Column:
    """Why an order's shipment is in doubt; NULL when it is not, or when the order is too old."""
    c = F.col
    age = days_between(as_of_day(as_of), c("order_created_at"))
    tracked = c("tracking_number").isNotNull()
    flag = (
        F.when(c("dispute_id").isNotNull(), "disputed_transaction")
        .when(c("order_amount") == c("refund_amount"), "fully_refunded")
        .when(~tracked & (age >= cfg.unfulfilled_days), "unfulfilled_exceeds_14d")
        .when(
            tracked & (days_between(c("first_carrier_scan_at"), c("order_created_at")) < 0),
            "carrier_scan_precedes_order",
        )
        .when(
            tracked & (c("distinct_customers_same_tracking") >= cfg.shared_tracking_customers),
            "duplicate_tracking_number",
        )
        .when(tracked & (c("tracking_dest_country") != c("shipping_country_name")), "destination_country_mismatch")
    )
    return F.when(age <= cfg.flag_order_age_days, flag)


def reconciled_orders(
    orders: DataFrame, shipments: DataFrame, cfg: SettlementConfig = SettlementConfig(), as_of=None,
    recent_only: bool = False,
) -> DataFrame:
    """Orders with their shipment flag.

    ``recent_only`` leaves out orders past the flag's age limit, whose flag is always NULL; the
    limit then prunes the order scan, and only those orders' shipments are aggregated.
    """
    if recent_only:
        orders = orders.filter(
            F.col("order_created_at") >= F.date_sub(as_of_day(as_of), cfg.flag_order_age_days)
        )
        shipments = shipments.join(
            orders.filter(F.col("tracking_number").isNotNull()).select("order_id"), "order_id", "left_semi"
        )
    return orders.join(first_scans(shipments), "order_id", "left").select(
        "order_id", "shop_id", "order_amount", shipment_flag(cfg, as_of).alias("shipment_reconciliation_flag")
    )


def shop_reserves(chargebacks: DataFrame, cfg: SettlementConfig = SettlementConfig()) -> DataFrame:
    """Pending dispute amount per shop; repeated chargebacks of an order count once, at their maximum."""
    return (
        chargebacks.filter(F.lower("status") == cfg.pending_dispute_status)
        .groupBy("shop_id", "order_id")
        .agg(F.max("dispute_amount_usd").alias("_amount"))
        .groupBy("shop_id")
        .agg(F.sum(zero_if_null("_amount")).alias("_reserve"))
    )


def dispute_reserves(
    chargebacks: DataFrame, stores: DataFrame, cfg: SettlementConfig = SettlementConfig()
) -> DataFrame:
    """Pending dispute amount per merchant."""
    return (
        stores.select("shop_id", "merchant_id")
        .join(shop_reserves(chargebacks, cfg), "shop_id")
        .groupBy("merchant_id")
        .agg(F.sum("_reserve").alias("total_pending_dispute_reserve_usd"))
    )


def shop_exposure(tables: Tables, cfg: SettlementConfig = SettlementConfig(), as_of=None) -> DataFrame:
    """Amounts of orders with a flag that counts as exposure, per shop."""
    return (
        reconciled_orders(
            tables["fact_order_daily"], tables["fact_order_shipment"], cfg, as_of, recent_only=True
        )
        .filter(F.col("shipment_reconciliation_flag").isin(*EXPOSED_FLAGS))
        .groupBy("shop_id")
        .agg(F.sum("order_amount").alias("_exposed"))
    )


def merchant_summary(tables: Tables, cfg: SettlementConfig = SettlementConfig(), as_of=None) -> DataFrame:
    """Portfolio and exposure per merchant, in one pass over the stores."""
    stores = (
        tables["dim_store"]
        .join(shop_exposure(tables, cfg, as_of), "shop_id", "left")
        .join(shop_reserves(tables["fact_chargebacks"], cfg), "shop_id", "left")
    )
    exposure = (zero_if_null(F.sum("_exposed")) + zero_if_null(F.sum("_reserve"))).alias("_exposure")
    return stores.groupBy("merchant_id").agg(*_portfolio(), exposure)


def merchant_exposure(tables: Tables, cfg: SettlementConfig = SettlementConfig(), as_of=None) -> DataFrame:
    """Exposed order amounts plus the dispute reserve per merchant."""
    return merchant_summary(tables, cfg, as_of).select("merchant_id", "_exposure")


def variance_exposure(tables: Tables, cfg: SettlementConfig = SettlementConfig(), as_of=None) -> DataFrame:
    requests = pending_requests(tables["fact_settlement_request"], cfg)
    return attach(requests, merchant_exposure(tables, cfg, as_of), "merchant_id").select(
        "settlement_id", zero_if_null("_exposure").alias("total_unfulfilled_or_disputed_exposure")
    )


def _portfolio() -> list[Column]:
    return [
        F.max("store_segment").alias("portfolio_segment"),
        F.sum("total_order_count").alias("total_orders"),
        ratio_of_sums("total_disputed_orders", "total_order_count").alias("portfolio_dispute_rate"),
    ]


def portfolio(stores: DataFrame) -> DataFrame:
    return stores.groupBy("merchant_id").agg(*_portfolio())


def portfolio_summary(tables: Tables, cfg: SettlementConfig = SettlementConfig()) -> DataFrame:
    requests = pending_requests(tables["fact_settlement_request"], cfg)
    return attach(requests, portfolio(tables["dim_store"]), "merchant_id").select(
        "settlement_id", "merchant_id", F.col("portfolio_segment").alias("store_segment"), "total_orders",
        "portfolio_dispute_rate",
    )


def payout_holds(requests: DataFrame) -> DataFrame:
    """All pending amounts per merchant. A request without a merchant matches no hold."""
    return (
        requests.filter(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(F.sum("requested_amount").alias("pending_payout_hold"))
    )


def projected_balance(exclude_self: bool = False) -> Column:
    """Ledger balance after the request, all pending requests of the merchant, and the reserve.

    The merchant's pending total contains the request itself, so by default it is taken off
    twice; ``exclude_self`` takes it off once.
    """
    own = F.lit(0) if exclude_self else zero_if_null("requested_amount")
    return (
        zero_if_null("available_balance")
        - own
        - zero_if_null("pending_payout_hold")
        - zero_if_null("rolling_reserve_balance")
    )


def ledger_balance(
    tables: Tables, cfg: SettlementConfig = SettlementConfig(), exclude_self: bool = False
) -> DataFrame:
    """Projected balance per request; a merchant with two balance rows gives two rows."""
    requests = pending_requests(tables["fact_settlement_request"], cfg)
    position = payout_holds(requests).join(
        tables["fact_merchant_account_balance"].select(
            "merchant_id", "available_balance", "rolling_reserve_balance"
        ),
        "merchant_id",
        "left",
    )
    return attach(requests, position, "merchant_id").select(
        "settlement_id", "merchant_id", "requested_amount",
        projected_balance(exclude_self).alias("projected_remaining_balance"),
    )


BALANCES = ("available_balance", "rolling_reserve_balance")


def balances_at_request(requests: DataFrame, history: DataFrame) -> DataFrame:
    """Add the merchant's balances as last recorded at or before the time of each request."""
    return as_of_join(
        requests, history, "merchant_id", "settlement_requested_at", "recorded_at", BALANCES, tie="balance_id"
    )


def holds_at_request(requests: DataFrame) -> DataFrame:
    """Add the pending amounts of the merchant's requests made up to the time of each, itself included."""
    held = running_totals(requests, ["merchant_id"], "settlement_requested_at", {"pending_payout_hold": F.col("requested_amount")})
    return attach(requests, held, ["merchant_id", "settlement_requested_at"])


def restricted_at_request(requests: DataFrame, tables: Tables) -> DataFrame:
    """Add whether a payout destination of the merchant was restricted when each request was made."""
    found = restricted_destinations_as_of(
        requests.withColumnRenamed("settlement_requested_at", "created_at"),
        tables["fact_merchant_payout_change"], tables["ref_restricted_account_change"],
    ).withColumnRenamed("is_destination_restricted", "is_matched")
    return attach(requests, found, "settlement_id")


def merchant_position(
    tables: Tables, requests: DataFrame, cfg: SettlementConfig, as_of, current: bool = True
) -> DataFrame:
    """All merchant-level inputs of the decision, for merchants with a pending request; without ``current``, those alone
    that don't depend on the time of a request."""
    if not current:
        asking = requests.filter(F.col("merchant_id").isNotNull()).select("merchant_id").distinct()
        return asking.join(merchant_summary(tables, cfg, as_of), "merchant_id", "left")
    restricted = restricted_merchants(
        tables["fact_merchant_payout_setting"], tables["ref_restricted_account_registry"]
    )
    position = (
        payout_holds(requests)
        .join(merchant_summary(tables, cfg, as_of), "merchant_id", "left")
        .join(restricted, "merchant_id", "left")
    )
    balances = tables["fact_merchant_account_balance"].select("merchant_id", *BALANCES)
    return position.join(balances, "merchant_id", "left")


# The labels of a decision and their order.
def reconciliation_status(cfg: SettlementConfig = SettlementConfig()) -> Column:
    c = F.col
    return first_match(
        [
            (c("is_destination_restricted") == 1, "HOLD_RESTRICTED_RECIPIENT"),
            (c("projected_remaining_balance") < 0, "HOLD_INSUFFICIENT_LEDGER_BALANCE"),
            (c("requested_amount") >= cfg.large_disbursement, "ESCALATE_TIER2_FINANCE_SIGNOFF"),
            (
                c("total_unfulfilled_or_disputed_exposure") >= c("requested_amount"),
                "HOLD_SHIPMENT_EXPOSURE_VARIANCE",
            ),
            (c("portfolio_dispute_rate") >= cfg.max_dispute_ratio, "HOLD_ELEVATED_DISPUTE_RESERVE"),
        ],
        "AUTO_DISBURSE_APPROVED",
    )


def settlement_reconciliation(
    tables: Tables, cfg: SettlementConfig = SettlementConfig(), as_of=None, sort: bool = True,
    exclude_self: bool = False, balances_as_of_request: bool = False,
) -> DataFrame:
    """The mart. ``balances_as_of_request`` takes the ledger as it stood when a request was made: balances from
    ``fact_merchant_balance_history``, holds from the requests up to then, and restricted destinations from the change
    logs of payout settings and registry, instead of the current ones."""
    requests = pending_requests(tables["fact_settlement_request"], cfg)
    position = merchant_position(tables, requests, cfg, as_of, not balances_as_of_request)
    if balances_as_of_request:
        requests = balances_at_request(holds_at_request(requests), tables["fact_merchant_balance_history"])
        requests = restricted_at_request(requests, tables)
    joined = attach(requests, position, "merchant_id").withColumns({
        "is_destination_restricted": zero_if_null("is_matched"),
        "total_unfulfilled_or_disputed_exposure": zero_if_null("_exposure"),
        "projected_remaining_balance": projected_balance(exclude_self),
    })
    exposure = F.col("total_unfulfilled_or_disputed_exposure")
    mart = joined.select(
        "settlement_id", "merchant_id", "store_segment", "requested_amount", "settlement_requested_at",
        "is_destination_restricted", "flagged_destination_emails", "total_unfulfilled_or_disputed_exposure",
        "portfolio_dispute_rate", "projected_remaining_balance",
        F.greatest(F.lit(0), F.col("requested_amount") - exposure).alias("net_eligible_disbursement_amount"),
        reconciliation_status(cfg).alias("automated_reconciliation_status"),
    )
    return mart.orderBy(F.col("settlement_id").desc_nulls_first()) if sort else mart
