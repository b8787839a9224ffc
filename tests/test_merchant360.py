import datetime as dt

from martwright.plans import merchant360

AS_OF = "2026-09-30"


def tables(role, metrics, orders, payout=(), registry=()):
    return {
        "dim_order": role("dim_order", *({"is_test": 0, **o} for o in orders)),
        "dim_merchant": role("dim_merchant", {"id": 1, "email": "one@x"}, {"id": 2, "email": "two@x"}),
        "fact_merchant_daily_metrics": role("fact_merchant_daily_metrics", *metrics),
        "fact_merchant_payout_setting": role("fact_merchant_payout_setting", *payout),
        "ref_restricted_account_registry": role("ref_restricted_account_registry", *registry),
    }


def recent(shop, merchant, at="2026-09-29 10:00:00"):
    return {"shop_id": shop, "merchant_id": merchant, "order_created_at": at}


def test_tiers_codes_and_text(role):
    got = merchant360.merchant_360(
        tables(
            role,
            [
                {"shop_id": 1, "merchant_id": 1, "avg_gmv_l30d": 9999.99, "disposable_email_rate": None},
                {"shop_id": 2, "merchant_id": 1, "avg_gmv_l30d": 10000, "dispute_order_ratio": 0.85, "avg_gmv_l3d": 100},
                {"shop_id": 3, "merchant_id": 2, "avg_gmv_l30d": 50000, "disposable_email_rate": 0.15, "pct_direct_traffic_l3d": 0.85,
                 "multi_store_buyer_rate": 0.40, "payment_failure_rate_primary_gateway": 0.40},
                {"shop_id": 4, "merchant_id": 2, "avg_gmv_l30d": None},
                {"shop_id": 5, "merchant_id": 2},
            ],
            [recent(1, 1), recent(2, 1), recent(3, 2), recent(4, 2), {**recent(5, 2), "is_test": 1}, recent(5, 2, "2026-09-15 23:59:59")],
            payout=[{"merchant_id": 1, "payout_destination_email": " A@X.com"}],
            registry=[{"restricted_email": "a@x.com"}],
        ),
        as_of=AS_OF,
    ).collect()
    assert [r.shop_id for r in got] == [1, 2, 3, 4]
    assert [r.merchant_segment_tier[:6] for r in got] == ["Tier 3", "Tier 2", "Tier 1", "Tier 3"]
    assert [r.aggregated_health_signals for r in got] == [
        "RESTRICTED_DISBURSEMENT_RECIPIENT",
        "CRITICAL_DISPUTE_SURGE HIGH_GMV_SURGE RESTRICTED_DISBURSEMENT_RECIPIENT",
        "HIGH_GATEWAY_FAILURE DISPOSABLE_BUYER_EMAIL UNATTRIBUTED_DIRECT_TRAFFIC MULTI_STORE_BUYER_CLUSTER",
        "",
    ]
    assert got[0].flagged_destination_emails == "a@x.com" and got[2].flagged_destination_emails is None
    assert (got[0].disposable_email_rate, got[2].disposable_email_rate) == (None, "  15.00%")
    assert (got[0].calculation_date, got[0].reporting_week) == ("2026-09-30", 40)
    assert (got[0].merchant_email, len(got[0])) == ("one@x", 28)


def test_two_merchants_on_a_shop_give_two_rows(role):
    mart = merchant360.merchant_360(
        tables(role, [{"shop_id": 1, "merchant_id": 1}], [recent(1, 1), recent(1, 2), recent(1, 2)]), as_of=AS_OF
    )
    assert sorted(r.merchant_email for r in mart.collect()) == ["one@x", "two@x"]


def test_active_window_edge(role):
    t = tables(role, [], [recent(1, 1, "2026-09-16 00:00:00"), recent(2, 9, "2026-09-20 05:00:00")])
    got = merchant360.active_storefronts(t["dim_order"], t["dim_merchant"], as_of=AS_OF).collect()
    assert {tuple(r) for r in got} == {(1, 1, "one@x", dt.date(2026, 9, 16)), (2, 9, None, dt.date(2026, 9, 20))}
