import pytest

from martwright.plans import billing

AS_OF = "2026-09-30"


@pytest.fixture
def ledgers(role):
    def build(charges, merchants=None, orders=(), invoices=()):
        merchants = merchants or [{"id": 1, "email": "m@x", "created_at": "2026-08-31 12:00:00"}]
        filled = (
            {"billing_event_id": i, "merchant_id": 1, "payment_instrument_id": 100 + i, "billing_event_timestamp": "2026-09-01 00:00:00",
             "merchant_country": "United States", "card_issuing_country_code": "USA", "billing_amount": 1, **c}
            for i, c in enumerate(charges)
        )
        return {
            "fact_billing_charge_event": role("fact_billing_charge_event", *filled),
            "dim_merchant": role("dim_merchant", *merchants),
            "dim_order": role("dim_order", *orders),
            "fact_subscription_invoice": role("fact_subscription_invoice", *invoices),
        }

    return build


def statuses(tables):
    return {r.billing_event_id: r.automated_activation_status for r in billing.billing_activation(tables, as_of=AS_OF).collect()}


def test_email_rules_precede_the_ranking(ledgers):
    merchants = [
        {"id": 1, "email": "m@x"}, {"id": 2, "email": "a@internal-testing.com"}, {"id": 3, "email": None},
    ]
    tables = ledgers(
        [
            {"merchant_id": 2, "payment_instrument_id": 7}, {"payment_instrument_id": 7, "billing_event_timestamp": "2026-09-02 00:00:00"},
            {"merchant_id": 3}, {"merchant_id": 4},
            {"payment_instrument_id": None}, {"payment_instrument_id": None}, {"payment_instrument_id": None, "billing_event_timestamp": "2026-08-02 00:00:00"},
        ],
        merchants,
    )
    assert set(statuses(tables)) == {1, 6}


def test_decision_order(ledgers):
    merchants = [{"id": i, "email": "m@x", "created_at": "2026-08-31 00:00:00"} for i in (1, 2, 10000001)]
    tables = ledgers(
        [
            {"merchant_id": 10000001, "gateway_error_message": "x stolen_card"},
            {"merchant_id": 10000001, "gateway_error_message": "expired_card"},
            {"gateway_error_message": "card_declined"},
            {"merchant_id": 2}, {"card_issuing_country_code": "BRA"}, {"card_issuing_country_code": None}, {},
            {"merchant_country": "Germany", "card_issuing_country_code": "DEU"},
        ],
        merchants,
        invoices=[{"invoice_id": 1, "merchant_id": 2, "invoice_amount": 150, "payment_status": "pending"},
                  {"invoice_id": 2, "merchant_id": 2, "invoice_amount": 50, "payment_status": "pending"},
                  {"invoice_id": 3, "merchant_id": 1, "invoice_amount": 500, "payment_status": "paid"}],
    )
    assert statuses(tables) == {
        0: "SUSPEND_UNAUTHORIZED_INSTRUMENT", 1: "ACTIVATE_ENTERPRISE_VIP", 2: "RETRY_ALTERNATIVE_PAYMENT_METHOD",
        3: "HOLD_FOR_BILLING_RECONCILIATION", 4: "FLAG_CROSS_BORDER_VALIDATION", 5: "FLAG_CROSS_BORDER_VALIDATION",
        6: "ACTIVATE_FULL_SERVICE", 7: "FLAG_CROSS_BORDER_VALIDATION",
    }


@pytest.mark.parametrize(("created", "orders", "seasoned"), [
    ("2026-08-31 23:59:59", 100, 1), ("2026-09-01 00:00:00", 100, 0), ("2026-08-31 00:00:00", 99, 0), ("2026-08-31 00:00:00", 0, 0),
])
def test_seasoning(ledgers, created, orders, seasoned):
    tables = ledgers(
        [{"card_issuing_country_code": "BRA"}], [{"id": 1, "email": "m@x", "created_at": created}],
        orders=[{"order_id": i, "merchant_id": 1, "is_test": 0} for i in range(orders)] + [{"order_id": 999, "merchant_id": 1, "is_test": 1}],
    )
    row = billing.billing_activation(tables, as_of=AS_OF).first()
    assert row.is_seasoned_merchant == seasoned
    assert row.automated_activation_status == ("ACTIVATE_FULL_SERVICE" if seasoned else "FLAG_CROSS_BORDER_VALIDATION")
    assert (row.country_affinity_pair, row.total_pending_invoice_amount) == ("United States-BRA", 0)


def test_plan_sequence_is_optional(ledgers):
    tables = ledgers(
        [{"invoice_id": 2}],
        invoices=[{"invoice_id": i, "merchant_id": 1, "plan_type": p, "created_at": "2026-09-01 00:00:00"} for i, p in ((1, "a"), (2, "b"), (3, "c"))],
    )
    row = billing.staged_charges(tables, as_of=AS_OF, with_plans=True).first()
    assert (row.previous_plan_type, row.subsequent_plan_type) == ("a", "c")
    assert "previous_plan_type" not in billing.staged_charges(tables, as_of=AS_OF).columns


def test_account_managers_keep_the_largest_owner():
    assert billing.account_managers([(1, "a"), (1, "c"), (1, "b"), (2, "z")]) == {1: "c", 2: "z"}
