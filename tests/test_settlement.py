import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martwright.catalog import queries
from martwright.config import SettlementConfig
from martwright.plans import settlement

AS_OF = "2026-09-30"


def day(age, clock="00:00:00"):
    return f"{dt.date(2026, 9, 30) - dt.timedelta(days=age)} {clock}"


@pytest.fixture
def books(role):
    def build(requests, **rows):
        names = (
            "fact_merchant_payout_setting", "ref_restricted_account_registry", "fact_order_shipment", "fact_order_daily",
            "fact_chargebacks", "dim_store", "fact_merchant_account_balance",
        )
        filled = ({"settlement_id": i, "merchant_id": 1, "status": "pending_reconciliation", **r} for i, r in enumerate(requests))
        return {"fact_settlement_request": role("fact_settlement_request", *filled)} | {n: role(n, *rows.get(n, ())) for n in names}

    return build


@pytest.mark.parametrize(
    ("order", "scans", "flag"),
    [
        ({"order_created_at": day(120), "dispute_id": 1}, [], "disputed_transaction"),
        ({"order_created_at": day(121), "dispute_id": 1}, [], None),
        ({"order_created_at": day(1), "order_amount": 5, "refund_amount": 5}, [], "fully_refunded"),
        ({"order_created_at": day(13)}, [], None),
        ({"order_created_at": day(14)}, [], "unfulfilled_exceeds_14d"),
        ({"order_created_at": day(5, "23:59:00"), "tracking_number": "T"}, [day(4, "00:01:00")], None),
        ({"order_created_at": day(5), "tracking_number": "T"}, [day(4), day(6, "23:59:59")], "carrier_scan_precedes_order"),
        ({"order_created_at": day(5), "tracking_number": "T", "distinct_customers_same_tracking": 2}, [], "duplicate_tracking_number"),
        ({"order_created_at": day(5), "tracking_number": "T", "tracking_dest_country": "A", "shipping_country_name": "B"}, [], "destination_country_mismatch"),
        ({"order_created_at": day(5), "tracking_number": "T", "tracking_dest_country": "A"}, [], None),
        ({"order_created_at": day(50), "tracking_number": "T"}, [], None),
    ],
)
@pytest.mark.parametrize("recent_only", [False, True])
def test_shipment_flag(role, order, scans, flag, recent_only):
    orders = role("fact_order_daily", {"order_id": 1, "shop_id": 1, "order_amount": 9, **order})
    shipments = role("fact_order_shipment", *({"order_id": 1, "first_carrier_scan_at": s} for s in scans))
    got = settlement.reconciled_orders(orders, shipments, as_of=AS_OF, recent_only=recent_only).collect()
    pruned = recent_only and order["order_created_at"] < day(120)
    assert [r.shipment_reconciliation_flag for r in got] == ([] if pruned else [flag])


def test_own_request_is_taken_off_twice(books):
    tables = books(
        [{"requested_amount": 100}, {"requested_amount": 50}, {"requested_amount": 7, "merchant_id": None}],
        fact_merchant_account_balance=[{"merchant_id": 1, "available_balance": 300, "rolling_reserve_balance": 0}],
    )
    got = {r.settlement_id: r.projected_remaining_balance for r in settlement.ledger_balance(tables).collect()}
    assert got == {0: 50, 1: 100, 2: -7}
    once = settlement.ledger_balance(tables, exclude_self=True)
    assert {r.settlement_id: r.projected_remaining_balance for r in once.collect()} == {0: 150, 1: 150, 2: 0}


def test_two_balance_rows_fan_out(books):
    tables = books(
        [{"requested_amount": 100}],
        fact_merchant_account_balance=[{"merchant_id": 1, "available_balance": 300}, {"merchant_id": 1, "available_balance": 500}],
    )
    assert sorted(r.projected_remaining_balance for r in settlement.ledger_balance(tables).collect()) == [100, 300]
    assert settlement.settlement_reconciliation(tables, as_of=AS_OF).count() == 2


def test_repeated_chargebacks_count_once(books):
    tables = books(
        [{"requested_amount": 10}],
        dim_store=[{"shop_id": 1, "merchant_id": 1}, {"shop_id": 2, "merchant_id": 1}],
        fact_chargebacks=[
            {"shop_id": 1, "order_id": 1, "dispute_amount_usd": 40, "status": "PENDING_arbitration"},
            {"shop_id": 1, "order_id": 1, "dispute_amount_usd": 60, "status": "pending_arbitration"},
            {"shop_id": 2, "order_id": 1, "dispute_amount_usd": None, "status": "pending_arbitration"},
            {"shop_id": 2, "order_id": 2, "dispute_amount_usd": 900, "status": "won"},
        ],
        fact_order_daily=[
            {"order_id": i, "shop_id": 1 + i % 2, "order_amount": 5, "order_created_at": day(20)} for i in range(3)
        ],
    )
    got = settlement.dispute_reserves(tables["fact_chargebacks"], tables["dim_store"]).collect()
    assert [tuple(r) for r in got] == [(1, Decimal("60.00"))]
    assert [r[1] for r in settlement.variance_exposure(tables, as_of=AS_OF).collect()] == [75]


def test_decision_order(books):
    restricted = dict(
        fact_merchant_payout_setting=[{"merchant_id": 5, "payout_destination_email": " R@x "}],
        ref_restricted_account_registry=[{"restricted_email": "r@x"}],
    )
    tables = books(
        [
            {"merchant_id": 5, "requested_amount": 10000}, {"merchant_id": 2, "requested_amount": 60},
            {"merchant_id": 3, "requested_amount": 10000}, {"merchant_id": 4, "requested_amount": 75},
            {"merchant_id": 6, "requested_amount": 75}, {"merchant_id": 7, "requested_amount": 75},
            {"merchant_id": 8, "requested_amount": None}, {"requested_amount": 1, "status": "paid"},
        ],
        fact_merchant_account_balance=[{"merchant_id": m, "available_balance": 119.99 if m == 2 else 99999} for m in range(1, 9)],
        dim_store=[
            {"shop_id": 4, "merchant_id": 4}, {"shop_id": 6, "merchant_id": 6, "total_order_count": 1000, "total_disputed_orders": 35},
            {"shop_id": 7, "merchant_id": 7, "total_order_count": 1000, "total_disputed_orders": 34}, {"shop_id": 8, "merchant_id": 8, "total_order_count": 0},
        ],
        fact_order_daily=[{"order_id": 1, "shop_id": 4, "order_amount": 75, "order_created_at": day(30)}],
        **restricted,
    )
    got = settlement.settlement_reconciliation(tables, as_of=AS_OF).collect()
    assert [r.settlement_id for r in got] == [6, 5, 4, 3, 2, 1, 0]
    assert [r.automated_reconciliation_status for r in reversed(got)] == [
        "HOLD_RESTRICTED_RECIPIENT", "HOLD_INSUFFICIENT_LEDGER_BALANCE", "ESCALATE_TIER2_FINANCE_SIGNOFF",
        "HOLD_SHIPMENT_EXPOSURE_VARIANCE", "HOLD_ELEVATED_DISPUTE_RESERVE", "AUTO_DISBURSE_APPROVED", "AUTO_DISBURSE_APPROVED",
    ]
    rows = {r.settlement_id: r for r in got}
    assert rows[6].net_eligible_disbursement_amount == 0 and rows[6].portfolio_dispute_rate is None
    assert rows[0].flagged_destination_emails == "r@x" and rows[1].is_destination_restricted == 0
    assert rows[3].net_eligible_disbursement_amount == 0 and rows[5].net_eligible_disbursement_amount == 75


def test_statuses_follow_the_config(books):
    tables = books([{"requested_amount": 5}, {"requested_amount": 6, "status": "P"}])
    got = settlement.pending_requests(tables["fact_settlement_request"], SettlementConfig(pending_status="P")).collect()
    assert [r.requested_amount for r in got] == [6]


def test_ledger_as_of_the_request_decides_both_ways(spark):
    """Balances on both sides of zero, and all statuses that the sample's amounts allow."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("sample data not present")
    mart = queries()["settlement_mart_as_of"](spark, folder)
    signs = mart.agg(*(F.count_if(F.expr(f"projected_remaining_balance {s} 0")).alias(n) for n, s in (("below", "<"), ("above", ">=")))).first()
    assert min(signs) > 100
    statuses = {r[0] for r in mart.select("automated_reconciliation_status").distinct().collect()}
    assert len(statuses) >= 4, statuses
    assert mart.agg(F.count_distinct("is_destination_restricted")).first()[0] == 2


def test_holds_count_requests_up_to_the_time(table):
    rows = [(1, 7, "10.00", "2026-01-01"), (2, 7, "5.00", "2026-01-03"), (3, 7, "1.00", "2026-01-03"), (4, 7, "2.00", "2026-02-01"), (5, 8, "9.00", "2026-01-05"), (6, None, "3.00", "2026-01-05")]
    requests = table("settlement_id int, merchant_id int, requested_amount decimal(18,2), settlement_requested_at timestamp", rows)
    got = {r.settlement_id: r.pending_payout_hold and float(r.pending_payout_hold) for r in settlement.holds_at_request(requests).collect()}
    assert got == {1: 10.0, 2: 16.0, 3: 16.0, 4: 18.0, 5: 9.0, 6: None}
