"""Interval joins, versions of a change log, and what is built on them, against plain loops."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from martwright.catalog import queries
from martwright.operators.ranges import HOUR, interval_join, session_ip_any_mismatch, validity_intervals
from martwright.operators.registry import restricted_destinations_as_of

START = dt.datetime(2026, 3, 1)


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def spans(spark, rows, names):
    body = [(i, k, at(a), at(b)) for i, (k, a, b) in enumerate(rows)]
    return spark.createDataFrame(body, f"{names}_id long, k string, {names}_from timestamp, {names}_to timestamp")


@pytest.mark.parametrize("seconds, clip", [(60, False), (HOUR, False), (HOUR, True), (30 * HOUR, True)])
def test_interval_join_equals_brute_force(spark, seconds, clip):
    g = random.Random(seconds)

    def some(n, open_ends):
        rows = []
        for _ in range(n):
            a = g.choice([-100_000_000, *[g.randrange(0, 3000)] * 9]) if open_ends else g.randrange(0, 3000)
            rows.append((g.choice(["hot", "hot", "a", "b", None]), a, a + g.choice([0, 1, 59, 60, 400]) if a > 0 else a))
        return [*rows, ("a", 5, 4), ("a", None, 9), ("a", 60, 60), ("a", 119, 120)]

    left, right = some(120, False), some(120, clip)
    if clip:
        right += [("hot", 1000, None), ("b", -50_000_000, None), ("a", -50_000_000, 50_000_000)]
    else:
        right.append(("hot", 1000, None))
    got = interval_join(
        spans(spark, left, "l"), spans(spark, right, "r"), "k", ("l_from", "l_to"), ("r_from", "r_to"), seconds, clip
    ).select("l_id", "r_id").collect()
    ends = lambda b: 10**12 if b is None and clip else b
    expected = sorted(
        (i, j)
        for i, (k, a, b) in enumerate(left) for j, (m, c, d) in enumerate(right)
        if k is not None and k == m and None not in (a, b, c, ends(d)) and a <= b and c <= ends(d) and c <= b and a <= ends(d)
    )
    assert sorted(map(tuple, got)) == expected and len(expected) > 100


def test_interval_join_of_nothing_and_of_equal_names(spark):
    left, right = spans(spark, [("a", 0, 9)], "l"), spans(spark, [("a", 3, 4)], "r")
    args = ("k", ("l_from", "l_to"), ("r_from", "r_to"))
    for clip in (False, True):
        assert interval_join(left.limit(0), right, *args, clip=clip).count() == 0
        assert interval_join(left, right.limit(0), *args, clip=clip).count() == 0
    with pytest.raises(ValueError, match="l_id"):
        interval_join(left, left, "k", ("l_from", "l_to"), ("l_from", "l_to"))


def test_interval_join_deals_a_hot_key_by_bin(spark):
    rows = [("hot", 10 * i, 10 * i + 5) for i in range(2000)]
    joined = interval_join(spans(spark, rows, "l"), spans(spark, rows, "r"), "k", ("l_from", "l_to"), ("r_from", "r_to"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_bin" in plan
    assert joined.count() == 2000


def test_versions_of_a_change_log(spark):
    g = random.Random(4)
    log = [(g.choice(["a", "b", None]), g.choice([None, *range(0, 200_000, 4001)]), n, g.choice("xyz")) for n in range(300)]
    df = spark.createDataFrame([(k, at(t), n, v) for k, t, n, v in log], "k string, at timestamp, n int, v string")
    got = {(r.k, r.valid_from): (r.valid_to, r.v) for r in validity_intervals(df, ["k"], "at", "n").collect()}
    last = {}
    for k, t, _, v in sorted((x for x in log if x[1] is not None), key=lambda x: x[2]):
        last[k, at(t)] = v
    times = {k: sorted(t for m, t in last if m == k) for k in {k for k, _ in last}}
    following = {(k, t): next((u for u in times[k] if u > t), None) for k, t in last}
    assert got == {key: (following[key], v) for key, v in last.items()}


@pytest.mark.parametrize("hours, seconds", [(24, HOUR), (1, HOUR), (2, 7 * 60)])
def test_any_session_equals_brute_force(spark, hours, seconds):
    g = random.Random(hours)
    ips = ["10.0.0.1", "10.0.0.2", "10.0.0.3", None]
    orders = [(i, g.choice([1, 1, 1, 2, 3, None]), g.choice([None, *[g.randrange(0, 9000)] * 20]), g.choice(ips)) for i in range(150)]
    sessions = [(g.choice([1, 1, 2, None]), g.choice([None, *[g.randrange(0, 9000)] * 20]), g.choice(ips)) for _ in range(200)]
    sessions += [(1, t, "10.0.0.1") for _, k, t, _ in orders[:20] if k == 1]  # at the very time of an order
    sessions += [(1, t - 60 * hours, "10.0.0.2") for _, k, t, _ in orders[20:40] if k == 1 and t]  # at the window's edge
    o = spark.createDataFrame([(i, u, at(t), ip) for i, u, t, ip in orders], "order_id long, u long, ts timestamp, order_ip string")
    s = spark.createDataFrame([(u, at(t), ip) for u, t, ip in sessions], "u long, seen timestamp, ip_address string")
    got = {
        r.order_id: (r.same_ip_seen, r.other_ip_seen, r.sig_order_session_ip_any_mismatch, r.sig_order_session_ip_never_matched)
        for r in session_ip_any_mismatch(o, s, "order_id", "u", "ts", "seen", hours, bin_seconds=seconds).collect()
    }
    for i, u, t, ip in orders:
        inside = [x for k, m, x in sessions if None not in (u, t, m, x) and k == u and t - 60 * hours <= m <= t]
        same, other = int(any(x == ip for x in inside)), int(ip is not None and any(x != ip for x in inside))
        assert got[i] == (same, other, other, int(other and not same))
    with pytest.raises(ValueError):
        session_ip_any_mismatch(o, s, "order_id", "u", "ts", "seen", 1, bin_seconds=2 * HOUR)


def test_setting_and_registry_as_of_the_request(spark):
    day = lambda d: dt.datetime(2026, 1, 1) + dt.timedelta(days=d)
    pay = spark.createDataFrame(
        [(1, 1, 1, " Bad@x.example", day(0)), (1, 1, 2, "good@x.example", day(50)), (1, 2, 3, "worse@x.example", day(80)), (1, 2, 4, None, day(90)),
         (2, 1, 5, "bad@X.example", day(10)), (3, 1, 6, "good@x.example", day(0))],
        "merchant_id long, setting_id int, change_id int, payout_destination_email string, changed_at timestamp",
    )
    listing = spark.createDataFrame(
        [("bad@x.example", 1, True, day(20)), ("bad@x.example", 2, False, day(60)), ("BAD@x.example", 3, True, day(100)), ("Worse@x.example ", 4, True, day(0))],
        "restricted_email string, change_id int, is_listed boolean, changed_at timestamp",
    )
    asked = {(1, 10): None, (1, 20): "bad@x.example", (1, 49): "bad@x.example", (1, 50): None, (1, 80): "Worse@x.example ", (1, 90): None, (2, 30): "bad@x.example",
             (2, 60): None, (2, 99): None, (2, 100): "BAD@x.example", (2, 900): "BAD@x.example", (3, 30): None, (9, 30): None, (None, 30): None}
    requests = spark.createDataFrame([(i, m, day(d)) for i, (m, d) in enumerate(asked)], "settlement_id long, merchant_id long, created_at timestamp")
    got = {r.settlement_id: r for r in restricted_destinations_as_of(requests, pay, listing, bin_days=7).collect()}
    for i, mail in enumerate(asked.values()):
        assert (got[i].flagged_destination_emails, got[i].is_destination_restricted) == (mail, int(mail is not None))


def test_both_outcomes_in_the_sample(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("sample data not present")
    flags = queries()["session_ip_any_mismatch"](spark, folder)
    names = ["same_ip_seen", "other_ip_seen", "sig_order_session_ip_never_matched"]
    assert flags.agg(*(F.count_distinct(n) for n in names)).first() == (2, 2, 2)
    changed = queries()["restricted_destination_as_of"](spark, folder).groupBy("flagged_destination_emails").count().count()
    assert changed >= 4
