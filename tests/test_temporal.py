"""Ordered operators against brute force, with hot keys, ties and NULLs."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martwright.functions import as_of_day
from martwright.operators.temporal import Rolling, as_of_join, rolling_as_of, rolling_per_event, time_bounds, with_neighbors

START = dt.datetime(2026, 1, 1)


def moments(seed, n, hot=0.4):
    """Rows (id, key, ts): one key holds a large share, times repeat, some keys and times are NULL."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 1 if rnd.random() < hot else rnd.choice([2, 3, None])
        ts = None if rnd.random() < 0.05 else START + dt.timedelta(hours=rnd.randrange(0, 24 * 12))
        rows.append((i, key, ts))
    return rows


@pytest.mark.parametrize("piece", ["hour", "day", "month", "instant"])
def test_with_neighbors_equals_lag_and_lead(spark, piece):
    rows = [(i, k, t, None if i % 11 == 0 else f"p{i % 7}") for i, k, t in moments(1, 300)]
    df = spark.createDataFrame(rows, "id int, k int, ts timestamp, v string")
    if piece == "instant":
        piece = F.struct(F.col("ts").isNull(), F.col("ts"), F.floor(F.col("id") / 40))
    got = {r.id: (r.previous_v, r.subsequent_v) for r in with_neighbors(df, ["k"], "ts", "id", "v", piece=piece).collect()}
    want = {}
    for key in {r[1] for r in rows}:
        line = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is None, r[2] or START, r[0]))
        for i, row in enumerate(line):
            want[row[0]] = (line[i - 1][3] if i else None, line[i + 1][3] if i + 1 < len(line) else None)
    assert got == want


@pytest.mark.parametrize("piece", ["hour", "month"])
def test_as_of_join(spark, piece):
    left = moments(2, 200)
    right = [(i, k, t, None if i % 5 == 0 else i * 10) for i, k, t in moments(3, 150)]
    got = as_of_join(
        spark.createDataFrame(left, "id int, k int, at timestamp"),
        spark.createDataFrame(right, "version int, k int, rts timestamp, v int"),
        "k", "at", "rts", ["version", "v"], tie="version", piece=piece,
    )
    assert got.columns == ["id", "k", "at", "version", "v"]
    want = {}
    for i, key, at in left:
        seen = [r for r in right if key is not None and at is not None and r[1] == key and r[2] is not None and r[2] <= at]
        best = max(seen, key=lambda r: (r[2], r[0]), default=None)
        want[i] = (best[0], best[3]) if best else (None, None)
    assert {r.id: (r.version, r.v) for r in got.collect()} == want


@pytest.mark.parametrize("piece", ["hour", "week"])
def test_rolling_per_event(spark, piece):
    anchors = moments(4, 120)
    facts = [(i, k, t, Decimal(i) / 4) for i, k, t in moments(5, 400)]
    got = rolling_per_event(
        spark.createDataFrame(anchors, "id int, k int, at timestamp"),
        spark.createDataFrame(facts, "fid int, k int, ts timestamp, v decimal(18,2)"),
        "id", "k", "at", "ts", 3, {"total": F.col("v"), "n": F.lit(1)}, piece=piece,
    ).collect()
    want = {}
    for i, key, at in anchors:
        hits = [
            v for _, k, t, v in facts
            if None not in (key, at, t) and k == key and at - dt.timedelta(days=3) <= t < at
        ]
        want[i] = (sum(hits, Decimal(0)), len(hits))
    assert {r.id: (r.total, r.n) for r in got} == want


def test_rolling_window_bounds(table):
    """'Last 3 days' starts four days before the anchor day and leaves the anchor day out."""
    df = table(
        "k int, ts timestamp, v int",
        [
            (1, "2026-01-05 23:59:59", 1), (1, "2026-01-06 00:00:00", 2), (1, "2026-01-09 23:59:59", 4),
            (1, "2026-01-10 00:00:00", 8), (2, "2025-01-01 00:00:00", 1),
        ],
    )
    day = as_of_day("2026-01-10")
    specs = [Rolling("s", "sum", F.col("v"), 3), Rolling("o", "sum", F.col("v"), 3, bounded=False)]
    assert {tuple(r) for r in rolling_as_of(df, ["k"], "ts", day, specs).collect()} == {(1, 6, 14)}
    closed = rolling_as_of(df, ["k"], "ts", day, specs[:1], prune=False)
    assert {tuple(r) for r in closed.collect()} == {(1, 6), (2, None)}


def test_hot_instant(spark):
    """40 % of all rows on one key at one instant are answered once, and reach no window one by one."""
    at = START + dt.timedelta(days=40)
    left = [(i, 1 if i % 5 < 2 else i, at if i % 5 < 2 else START) for i in range(1000)]
    facts = [(i, 1 if i % 5 < 2 else i, at - dt.timedelta(hours=1) if i % 5 < 2 else START, 1) for i in range(1000)]
    anchors = spark.createDataFrame(left, "id int, k int, at timestamp")
    table = spark.createDataFrame(facts, "fid int, k int, ts timestamp, v int")
    got = rolling_per_event(anchors, table, "id", "k", "at", "ts", 3, {"n": F.col("v")}, bounds=time_bounds(anchors, "at"))
    assert {(r.id, r.n) for r in got.collect()} == {(i, 400 if i % 5 < 2 else 0) for i in range(1000)}
    seen = as_of_join(anchors, table, "k", "at", "ts", ["fid"], within="24 hours")
    assert all(r.fid == r.id if r.k != 1 else r.fid % 5 < 2 for r in seen.collect())


def test_binary_fractions_are_refused(spark):
    anchors = spark.createDataFrame([(1, 1, START)], "id int, k int, at timestamp")
    facts = spark.createDataFrame([(1, START, 0.1)], "k int, ts timestamp, v double")
    with pytest.raises(ValueError, match="decimal"):
        rolling_per_event(anchors, facts, "id", "k", "at", "ts", 3, {"v": F.col("v")})


def test_windows_over_the_turn_of_years(spark):
    """Neighbours and states are carried over years without a row."""
    days = [dt.datetime(2020, 12, 31), dt.datetime(2021, 1, 1), dt.datetime(2024, 6, 1), dt.datetime(2027, 1, 1)]
    df = spark.createDataFrame([(i, 1, t, i) for i, t in enumerate(days)], "id int, k int, ts timestamp, v int")
    got = {r.id: (r.previous_v, r.subsequent_v) for r in with_neighbors(df, ["k"], "ts", "id", "v").collect()}
    assert got == {0: (None, 1), 1: (0, 2), 2: (1, 3), 3: (2, None)}
    asked = spark.createDataFrame([(9, 1, dt.datetime(2026, 5, 5)), (8, 1, days[0]), (7, 2, days[0])], "a int, k int, at timestamp")
    found = as_of_join(asked, df, "k", "at", "ts", ["v"]).collect()
    assert {r.a: r.v for r in found} == {9: 2, 8: 0, 7: None}
