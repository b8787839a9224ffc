import random

import pytest
from pyspark.sql import functions as F

from martwright.operators import (
    Gateway, Signal, account_groups, add_flags, apply_adjustments, checkouts_with_code, code_string, email_quality,
    enrich, filter_ids, first_match, first_per_key, gateway_code_lists, id_list, link_entities, linkage_signal,
    lookup_text, merge_on, multi_store_rate, restricted_merchants, session_ip_mismatch,
)
from martwright.operators import metrics
from martwright.operators.features import buyer_history, buyer_velocity, card_features, tracking_reuse


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_signals_and_first_match(table):
    df = table("x int", [(1,), (5,), (None,)])
    signals = [Signal("big", F.col("x") >= 5, "BIG"), Signal("any", F.col("x").isNotNull(), "ANY")]
    got = add_flags(df, signals).select(
        "x", "big", "any", code_string(signals).alias("codes"),
        first_match([(F.col("big") == 1, "first"), (F.col("any") == 1, "second")], "none").alias("label"),
    )
    assert rows(got) == [(1, 0, 1, "ANY", "second"), (5, 1, 1, "BIG ANY", "first"), (None, 0, 0, "", "none")]


@pytest.mark.parametrize("spread", [1, 4])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_enrich_spread_keeps_results(table, spread, how):
    left = table("id int, k int", [(i, 1 if i % 2 else i) for i in range(40)] + [(99, None)])
    right = table("k int, v string", [(1, "hot"), (2, "two"), (2, "twice")])
    assert rows(enrich(left, right, "k", how, spread=spread), "id", "v") == rows(left.join(right, "k", how), "id", "v")


def test_enrich_one_per_key_does_not_fan_out(table):
    left = table("id int, k int", [(1, 2)])
    right = table("k int, v string", [(2, "a"), (2, "b")])
    assert rows(enrich(left, right, "k", one_per_key=[F.col("v").desc()]), "id", "v") == [(1, "b")]


def test_merge_on(table):
    a, b, c = table("k int, a int", [(1, 1), (2, 2)]), table("k int, b int", [(1, 5)]), table("k int, c int", [(2, 6)])
    assert rows(merge_on("k", a, b, c)) == [(1, 1, 5, None), (2, 2, None, 6)]


def test_first_per_key_null_keys_share_a_group(table):
    df = table("k int, ts int, id int", [(None, 2, 1), (None, 1, 2), (7, 5, 3), (7, 5, 4)])
    assert rows(first_per_key(df, ["k"], [F.col("ts"), F.col("id")]), "id") == [(2,), (3,)]


def gateway_fixture(table):
    a = table("checkout_id int, response_reason string", [(1, " Do Not Honor "), (1, "do not honor"), (2, "odd"), (3, None)])
    b = a.filter("checkout_id < 3")
    mapping = table("description string, signal_code string", [("do not honor", "DECLINE_X"), ("Do Not Honor ", "DECLINE_X"), ("do not honor", "A")])
    return {
        "gateway_a": Gateway(a, "response_reason", mapping, "description", True, ", "),
        "gateway_b": Gateway(b, "response_reason", mapping, "description", False, ","),
    }


def test_gateway_lists(table):
    got = gateway_code_lists(gateway_fixture(table))
    want = [
        (1, "A, DECLINE_X", "A,A,DECLINE_X,DECLINE_X,DECLINE_X,DECLINE_X"), (2, None, None), (3, None, None),
    ]
    assert rows(got, "checkout_id", "gateway_a_signals", "gateway_b_signals") == want


def test_checkouts_with_code(table):
    assert rows(checkouts_with_code(gateway_fixture(table), "DECLINE")) == [(1,)]


def test_lookup_text_left_keeps_unmapped(table):
    df = table("id int, t string", [(1, " X "), (2, "none"), (3, None)])
    mapping = table("d string, code string", [("x", "C")])
    assert rows(lookup_text(df, "t", mapping, "d", "code"), "id", "code") == [(1, "C"), (2, None), (3, None)]


def test_restricted_merchants_show_registry_spelling(table):
    payout = table("merchant_id int, payout_destination_email string", [(1, " A@X.com"), (1, "b@x.com"), (2, "c@x.com"), (3, None)])
    registry = table("restricted_email string", [("a@x.com",), ("B@x.com",)])
    assert rows(restricted_merchants(payout, registry)) == [(1, 1, "B@x.com, a@x.com")]


def test_apply_adjustments(table):
    base = table("id int, v string, version int", [(1, "old", 1), (2, "kept", 9), (4, "base", 3)])
    updates = table("id int, v string, version int", [(1, "new", 2), (2, "late", 5), (3, "added", 1), (4, "update", 3)])
    assert rows(apply_adjustments(base, updates, "id", "version")) == [
        (1, "new", 2), (2, "kept", 9), (3, "added", 1), (4, "update", 3)
    ]


def test_adjustments_keep_rows_without_a_key_and_repeated_ones(table):
    base = table("k int, v int, at int", [(None, 1, 1), (None, 2, 1), (1, 3, 1), (1, 4, 9), (2, 5, None), (3, 6, 5)])
    updates = table("k int, v int, at int", [(1, 30, 2), (1, 31, 5), (1, 32, 5), (2, 50, None), (3, 60, 4), (4, 70, 1), (None, 80, 9)])
    got = apply_adjustments(base, updates, "k", "at", tie="v")
    want = [(None, 1, 1), (None, 2, 1), (1, 32, 5), (1, 4, 9), (2, 50, None), (3, 6, 5), (4, 70, 1)]
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)


def test_long_chain_of_accounts_settles(table):
    n = 70
    links = table("anchor int, account int", [(k, k + 1) for k in range(n)] + [(500, 501)])
    got = {r.account: r.group_id for r in account_groups(links, "account").collect()}
    assert got == {**{k: 0 for k in range(n + 1)}, 500: 500, 501: 500}


def test_long_pages_go_on_in_parts(table):
    page = table("page int, n int, t string", [(1, k, str(k)) for k in range(7)])
    got = sorted(map(tuple, id_list(page, "t", ["page"], ["n"], page_rows=3).collect()))
    assert got == [(1, 1, "0, 1, 2", 3), (1, 2, "3, 4, 5", 3), (1, 3, "6", 1)]


def test_filter_ids_and_id_list(table):
    df = table("id int", [(i,) for i in range(1, 8)])
    assert rows(filter_ids(df, "id", "1, 2,x, ,5")) == [(1,), (2,), (5,)]
    page = table("page int, n int, t string", [(1, 2, " 20 "), (1, 1, "10"), (1, 3, "abc"), (2, 1, "")])
    texts = id_list(page, "t", ["page"], ["n"])
    assert rows(texts) == [(1, 1, "10, 20", 2)]
    assert rows(filter_ids(table("id int", [(10,), (11,)]), "id", texts.select("id_text"))) == [(10,)]


def test_buyer_and_card_features(table):
    orders = table(
        "id int, buyer_email string, order_created_at timestamp, order_status string, card_token string",
        [
            (1, "A@x", "2026-01-01 01:00:00", "completed", "c"), (2, "a@x ", "2026-01-01 23:00:00", "Refunded", "c"),
            (3, "a@x", "2026-01-02 00:00:00", "cancelled", "c"), (4, None, "2026-01-01 00:00:00", "cancelled", None),
        ],
    )
    assert rows(buyer_velocity(orders), "id", "no_order_customer_email_per_day") == [(1, 2), (2, 2), (3, 1), (4, 0)]
    names = ("id", "count_order_of_customer", "count_order_cancel_refund_by_buyer_email")
    assert rows(buyer_history(orders, spread=3), *names) == [(1, 3, 2), (2, 3, 2), (3, 3, 2), (4, 0, 0)]
    assert rows(card_features(orders)) == [("c", 3, 1.5)]


def test_tracking_reuse(table):
    df = table("id int, tracking_number string, customer_id int", [(1, "T", 1), (2, "T", 2), (3, "T", 2), (4, None, 5)])
    assert rows(tracking_reuse(df), "id", "distinct_customers_same_tracking") == [(1, 2), (2, 2), (3, 2), (4, None)]


def test_email_quality_and_multi_store(table):
    orders = table(
        "shop_id int, buyer_email string",
        [(1, "a@tmp.example"), (1, "A@Tmp.example"), (1, "b@ok.example"), (1, "broken"), (1, None), (2, "b@ok.example"), (2, None)],
    )
    listed = table("d string", [(" TMP.example",)])
    assert rows(email_quality(orders, listed)) == [(1, 0.5, 0.25), (2, 0.0, 0.0)]
    assert rows(multi_store_rate(orders)) == [(1, 3, 1, 1 / 3), (2, 1, 1, 1.0)]


def test_session_ip_mismatch(table):
    orders = table("order_id int, u int, at timestamp, order_ip string", [
        (1, 1, "2026-01-01 10:00:00", "a"), (2, 1, "2026-01-03 10:00:00", "a"), (3, 2, "2026-01-01 00:00:00", "a")])
    sessions = table("session_id int, u int, ts timestamp, ip_address string", [(1, 1, "2026-01-01 09:00:00", "b")])
    got = session_ip_mismatch(orders, sessions, "u", "at", "ts", "24 hours")
    assert rows(got, "order_id", "session_ip", "sig_order_session_ip_mismatch") == [(1, "b", 1), (2, None, 0), (3, None, 0)]


def test_linkage_signal_is_linear(table):
    df = table("e int, a string, v string", [(i, "card", "hot") for i in range(30)] + [(50, "card", "own"), (51, "ip", None)])
    assert link_entities(df, "e", "a", "v").count() == 30
    got = {r.e: (r.shared_values, r.largest_group, r.sig_cross_account_linkage) for r in linkage_signal(df, "e", "a", "v").collect()}
    assert got[3] == (1, 30, 1) and got[50] == (0, 0, 0) and got[51] == (0, 0, 0)


def test_account_groups_against_union_find(spark):
    rnd = random.Random(6)
    members = [(rnd.randrange(200), "card", f"v{rnd.randrange(140)}") for _ in range(260)]
    members += [(300 + i, "chain", f"c{j}") for i in range(40) for j in (i, i + 1)]
    df = spark.createDataFrame(members, "e int, a string, v string")
    got = {r.e: r.group_id for r in account_groups(link_entities(df, "e", "a", "v"), "e").collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    by_value = {}
    for e, a, v in members:
        by_value.setdefault((a, v), set()).add(e)
    linked = [g for g in by_value.values() if len(g) > 1]
    for group in linked:
        for e in group:
            a, b = find(e), find(min(group))
            parent[max(a, b)] = min(a, b)
    assert got == {e: find(e) for g in linked for e in g}


def test_buyer_cancel_rate_matches_the_joined_form(table):
    profile = table("shop_id int, total_order int", [(1, 10), (1, 30), (2, 5), (3, 0)])
    tickets = table("order_id int, shop_id int, ticket_type string", [
        (1, 1, "CANCEL ORDER please"), (1, 1, "cancel order"), (2, 1, "cancel order"), (3, 2, "other"), (None, 2, "cancel order")])
    cancelled = tickets.filter(F.lower("ticket_type").like("%cancel order%")).select("order_id", "shop_id").distinct()
    literal = profile.join(cancelled, "shop_id", "left").groupBy("shop_id").agg(
        (F.count_distinct("order_id") / F.nullif(F.sum("total_order"), F.lit(0))).alias("r"))
    assert rows(metrics.buyer_cancel_rate(profile, tickets)) == rows(literal)
    plain = metrics.buyer_cancel_rate(profile, tickets, repeat_denominator=False)
    assert rows(plain) == [(1, 2 / 40), (2, 0.0), (3, None)]


def test_max_line_gmv_anchor_and_bound(table):
    orders = table("shop_id int, order_created_at timestamp, account_tier_updated_at timestamp, max_raw_price_lineitem int", [
        (1, "2026-01-01 00:00:00", "2026-01-05 00:00:00", 7), (1, "2026-01-01 00:00:00", "2026-01-05 00:00:01", 99),
        (1, "2026-01-08 00:00:00", None, 5), (1, "2026-01-20 00:00:00", None, 50)])
    assert rows(metrics.max_line_gmv_anchored(orders, "2026-01-10")) == [(1, 50)]
    assert rows(metrics.max_line_gmv_anchored(orders, "2026-01-10", bounded=True)) == [(1, 7)]


def test_run_statistics(table):
    runs = table("form string, ms double, n int", [("a", 10.0, 100), ("a", 30.0, 100), ("b", 10.0, 100)])
    stats = metrics.run_statistics(runs, "form", "ms", "n")
    assert rows(stats) == [("a", 2, 20.0, 10.0, 5000.0), ("b", 1, 10.0, 0.0, 10000.0)]
    assert rows(metrics.speed_up(stats, "form", "a", "b")) == [(20.0, 10.0, 2.0, 50.0)]


def test_buyer_velocity_at_order(table):
    from martwright.operators.features import buyer_velocity_at_order

    g = random.Random(12)
    rows = [
        (i, g.choice([" Agent@x ", "agent@X", "agent@x", "b@x", None]), g.choice([None, *(f"2026-03-0{d} {h:02}:00:00" for d in (1, 2) for h in (0, 5, 23))]))
        for i in range(400)
    ]
    got = {r.order_id: r.n for r in buyer_velocity_at_order(table("order_id int, buyer_email string, order_created_at timestamp", rows), name="n").collect()}
    key = lambda r: (r[1].strip().lower(), r[2][:10])
    for i, mail, at in rows:
        earlier = [r for r in rows if None not in (mail, at, r[1], r[2]) and key(r) == key((i, mail, at)) and (r[2], r[0]) <= (at, i)]
        assert got[i] == len(earlier)
