"""Thresholds of every mart as frozen dataclasses.

A mart turns its config into literals, which Catalyst folds and pushes down; there is no config
table to join. Override with ``dataclasses.replace``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Fixed values of the decision rules follow; results must equal them.


@dataclass(frozen=True)
class CheckoutConfig:
    critical_retry: int = 12
    moderate_retry: int = 8
    high_order_value: float = 1000.0
    medium_order_value: float = 250.0
    max_geo_distance_miles: float = 1000.0
    latency_cutoff_ms: int = 75
    abnormal_margin_ratio: float = 0.80
    near_zero_margin: float = 0.10
    bulk_quantity: int = 10
    buyer_orders_per_day: int = 5
    buyer_returns: int = 8
    lookback_days: int = 8


@dataclass(frozen=True)
class MerchantHealthConfig:
    critical_dispute_ratio: float = 0.85
    high_failure_ratio: float = 0.40
    dispute_rate_benchmark: float = 0.035
    high_disposable_ratio: float = 0.15
    multi_store_buyer_rate: float = 0.40
    gmv_surge: float = 100.0
    direct_traffic_ratio: float = 0.85
    enterprise_gmv: float = 50000.0
    growth_gmv: float = 10000.0
    active_days: int = 14


@dataclass(frozen=True)
class SettlementConfig:
    large_disbursement: float = 10000.0
    max_dispute_ratio: float = 0.035
    min_reserve_holdback: float = 0.20
    flag_order_age_days: int = 120
    unfulfilled_days: int = 14
    shared_tracking_customers: int = 2
    pending_status: str = "pending_reconciliation"
    pending_dispute_status: str = "pending_arbitration"


@dataclass(frozen=True)
class BillingConfig:
    max_pending_amount: float = 200.0
    tenured_days: int = 30
    tenured_orders: int = 100
    pending_status: str = "pending"
    internal_mail_mark: str = "@internal-testing.com"


@dataclass(frozen=True)
class ConsolidatedConfig:
    since: dt.date = dt.date(2026, 9, 20)
    high_attempts: int = 3
    max_dispute_rate: float = 0.035
    max_high_attempt_orders: int = 5
    large_gmv: float = 10000.0
    geo_mismatch_orders: int = 3
    direct_ratio: float = 0.8


@dataclass(frozen=True)
class TriageConfig:
    hold_dispute_rate: float = 0.035
    hold_direct_ratio: float = 0.85
    escalate_amount: float = 10000.0
    escalate_dispute_rate: float = 0.015
