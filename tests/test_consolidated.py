import pytest

from martwright.plans import consolidated
from martwright.plans.triage import settlement_triage


@pytest.fixture
def star(role):
    merchants = [{"shop_id": i, "user_id": 1000 + i, "is_public_domain": int(i != 5), "country": "US"} for i in range(1, 8)]
    base = {"order_created_at": "2026-09-25 00:00:00", "gmv": 10, "merchant_profit": 1, "traffic_source": "google", "payment_attempts": 1,
            "shipping_country": "US", "card_country": "US"}
    orders = [{"shop_id": 2, "payment_attempts": 3}] * 5 + [{"shop_id": 3, "gmv": 10000}]
    orders += [{"shop_id": 4, "card_country": "VN"}] * 3 + [{"shop_id": 5, "traffic_source": ""}] * 9 + [{"shop_id": 5}]
    orders += [{"shop_id": 6, "card_country": None}] * 28 + [{"shop_id": 6, "order_created_at": "2026-09-19 23:59:59", "traffic_source": "direct"}]
    orders += [{"shop_id": 7}] * 200
    disputes = [{"shop_id": 1}] * 3 + [{"shop_id": 6}] + [{"shop_id": 7}] * 7
    sessions = [{"shop_id": 6, "ip_address": ip} for ip in ("a", "a", "b", None)]
    return {
        "merchants": role("merchants", *merchants),
        "orders": role("orders", *({**base, "order_id": i, **o} for i, o in enumerate(orders))),
        "disputes": role("disputes", *({"dispute_id": i, "amount": 2, **d} for i, d in enumerate(disputes))),
        "web_sessions": role("web_sessions", *({"session_id": i, **s} for i, s in enumerate(sessions))),
    }


def test_actions(star):
    got = {r.shop_id: r for r in consolidated.consolidated_merchant(star).collect()}
    assert {k: r.suggested_action for k, r in got.items()} == {
        1: "Auto-Disburse Approved",      # disputes without orders: rate 0
        2: "Hold for Ledger Audit",
        3: "Tier-2 Signoff Required",
        4: "Tier-2 Signoff Required",
        5: "Hold for Catalog Audit",
        6: "Auto-Disburse Approved",      # unknown card country is no mismatch; 1/29 < 0.035
        7: "Auto-Disburse Approved",      # 7/200 = 0.035 is not above the bound
    }
    six = got[6]
    assert (six.distinct_session_ips, six.total_disputes, six.geo_mismatch_orders, six.direct_orders_3d) == (2, 1, 0, 0)
    assert (got[1].total_orders, got[1].avg_profit_3d, got[1].dispute_rate) == (0, 0.0, 0.0)
    assert got[5].direct_traffic_ratio == 0.9


def test_five_visuals_agree_with_the_single_pass(star):
    names = ["shop_id", "user_id", "is_public_domain", "merchant_country", *consolidated.MEASURES, "suggested_action"]
    single = consolidated.consolidated_merchant(star).select(*names)
    merged = consolidated.five_visual_merge(star).select(*names)
    assert single.exceptAll(merged).count() == merged.exceptAll(single).count() == 0


# The 50 expected decisions (amount, dispute rate, direct-traffic ratio, status).
GOLDEN = [
    (613.12, 0.1123, 0.3302, "HOLD"), (3662.15, 0.0015, 0.8831, "HOLD"),
    (1630.09, 0.0067, 0.2418, "AUTO"), (1145.53, 0.0297, 0.2446, "ESCALATE"),
    (253.55, 0.0258, 0.5176, "ESCALATE"), (253.52, 0.0002, 0.1177, "AUTO"),
    (121.81, 0.0556, 0.3127, "HOLD"), (2463.48, 0.0044, 0.3905, "AUTO"),
    (1152.9, 0.0552, 0.4348, "HOLD"), (1527.5, 0.0146, 0.1603, "AUTO"),
    (74.96, 0.0108, 0.566, "AUTO"), (4254.27, 0.011, 0.6826, "AUTO"),
    (2193.72, 0.008, 0.3923, "AUTO"), (336.43, 0.0413, 0.0483, "HOLD"),
    (290.81, 0.0359, 0.8027, "HOLD"), (293.13, 0.0525, 0.7889, "HOLD"),
    (485.3, 0.002, 0.2277, "AUTO"), (942.71, 0.0099, 0.4831, "AUTO"),
    (728.64, 0.0006, 0.7775, "AUTO"), (463.07, 0.0212, 0.3306, "ESCALATE"),
    (1185.65, 0.0098, 0.5481, "AUTO"), (230.28, 0.002, 0.2466, "AUTO"),
    (464.62, 0.0007, 0.5077, "AUTO"), (597.53, 0.0222, 0.362, "ESCALATE"),
    (780.72, 0.021, 0.4033, "ESCALATE"), (1895.52, 0.0161, 0.5266, "ESCALATE"),
    (317.28, 0.0131, 0.4382, "AUTO"), (916.43, 0.0055, 0.5937, "AUTO"),
    (1127.01, 0.004, 0.4856, "AUTO"), (107.08, 0.0161, 0.142, "ESCALATE"),
    (1172.4, 0.0003, 0.4827, "AUTO"), (274.35, 0.0042, 0.5458, "AUTO"),
    (130.72, 0.0673, 0.5754, "HOLD"), (3618.43, 0.0612, 0.5583, "HOLD"),
    (4094.76, 0.0003, 0.5262, "AUTO"), (2032.8, 0.0019, 0.3229, "AUTO"),
    (485.95, 0.0035, 0.3713, "AUTO"), (173.33, 0.005, 0.3361, "AUTO"),
    (1433.3, 0.0609, 0.5622, "HOLD"), (746.11, 0.019, 0.4563, "ESCALATE"),
    (206.18, 0.0188, 0.584, "ESCALATE"), (870.26, 0.0708, 0.357, "HOLD"),
    (91.99, 0.1367, 0.4524, "HOLD"), (2930.51, 0.0056, 0.3652, "AUTO"),
    (409.35, 0.1022, 0.7693, "HOLD"), (1353.51, 0.0105, 0.7764, "AUTO"),
    (498.26, 0.0296, 0.1499, "ESCALATE"), (930.93, 0.0455, 0.2761, "HOLD"),
    (999.47, 0.0094, 0.2364, "AUTO"), (295.27, 0.0284, 0.11, "ESCALATE"),
]


def test_golden_triage(table):
    names = "requested_amount double, dispute_rate double, direct_traffic_ratio double"
    df = table("n int, " + names, [(k, *r[:3]) for k, r in enumerate(GOLDEN)])
    got = {r.n: r.automated_reconciliation_status.split("_")[0] for r in settlement_triage(df).collect()}
    assert got == {k: r[3] for k, r in enumerate(GOLDEN)} and len(got) == 50


@pytest.mark.parametrize(("amount", "dispute", "direct", "status"), [
    (613.12, 0.1123, 0.3302, "HOLD"), (3662.15, 0.0015, 0.8831, "HOLD"), (1630.09, 0.0067, 0.2418, "AUTO"),
    (1145.53, 0.0297, 0.2446, "ESCALATE"), (290.81, 0.0359, 0.8027, "HOLD"), (9999.99, 0.015, 0.85, "AUTO"),
    (10000, 0, 0, "ESCALATE"), (100, 0.035, 0, "ESCALATE"), (100, None, None, "AUTO"),
])
def test_triage(table, amount, dispute, direct, status):
    df = table("requested_amount double, dispute_rate double, direct_traffic_ratio double", [(amount, dispute, direct)])
    row = settlement_triage(df).first()
    assert row.automated_reconciliation_status.startswith(status)
    assert row.reconciliation_rule_summary.startswith({"HOLD": "Elevated", "ESCALATE": "Large", "AUTO": "Passed"}[status])
