import random

import pytest

from martwright.sources import write_mart
from martwright.streaming import log_versions, rising_versions, state_of, thinned

DDL = "id int, amount int, at timestamp, gone boolean"
BASE = "id int, amount int, at timestamp"


def at(minute):
    return f"2026-01-01 {minute // 60:02d}:{minute % 60:02d}:00"


def drain(spark, folder, keep="7 days", ddl=DDL):
    updates = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1000).parquet(f"{folder}/in")
    query = log_versions(updates, f"{folder}/log", f"{folder}/state", "id", "at", tie="amount", keep=keep)
    assert query.awaitTermination(60)
    assert query.exception() is None


def rows(df):
    return sorted(map(str, df.collect()))


def test_late_versions_stop_and_withdrawals_stay(spark, table, tmp_path):
    folder = str(tmp_path)
    base = table(BASE, [(1, 10, at(0)), (2, 20, at(0)), (3, 30, at(50)), (None, 90, at(0))])
    batches = [
        [(1, 11, at(10), False), (1, 12, at(20), None), (2, 0, at(30), True), (None, 5, at(99), False)],
        [(1, 99, at(15), False), (2, 21, at(25), False), (3, 31, at(40), True), (4, 40, at(5), False)],  # late: 1, 2
        [(2, 22, at(31), False), (4, 0, at(6), True), (4, 41, at(5), False), (1, 12, at(20), None)],  # 1 is a replay
    ]
    for batch in batches:
        write_mart(table(DDL, batch), f"{folder}/in", mode="append")
        drain(spark, folder)
    log = spark.read.parquet(f"{folder}/log")
    passed = [(r.id, r.amount) for r in log.orderBy("batch_id", "id").collect()]
    assert passed == [(1, 12), (2, 0), (3, 31), (4, 40), (2, 22), (4, 0)]
    want = table(BASE, [(1, 12, at(20)), (2, 22, at(31)), (3, 30, at(50)), (None, 90, at(0))])
    assert rows(state_of(base, log, "id", "at", withdrawn="gone")) == rows(want)
    assert thinned(log, "id", "at").count() == 4
    without = state_of(base, log.drop("gone"), "id", "at")
    assert sorted((r.id or 0) for r in without.collect()) == [0, 1, 2, 3, 4]


def test_any_order_and_dropped_state_give_the_same_table(spark, table, tmp_path):
    rng = random.Random(5)
    base = table(BASE, [(k, 0, at(rng.randrange(60))) for k in range(8)])
    updates = [(rng.randrange(12), rng.randrange(100), at(rng.randrange(120)), rng.random() < 0.3) for _ in range(90)]
    seen, everything = {}, table(DDL, updates)
    want = rows(state_of(base, everything, "id", "at", tie="amount", withdrawn="gone"))
    for keep in ("7 days", "1 ms"):  # the second forgets each key before the next batch
        rng.shuffle(updates)
        folder = f"{tmp_path}/{keep.replace(' ', '')}"
        for first in range(0, 90, 30):
            write_mart(table(DDL, updates[first:first + 30]), f"{folder}/in", mode="append")
            drain(spark, folder, keep)
        log = spark.read.parquet(f"{folder}/log")
        seen[keep] = log.count()
        assert rows(state_of(base, log, "id", "at", tie="amount", withdrawn="gone")) == want
    assert seen["7 days"] <= 36 and seen["1 ms"] <= 36


def test_values_pass_unchanged(spark, table, tmp_path):
    ddl = "id bigint, at timestamp, amount int, big bigint, price decimal(18,2), name string, day date, ratio double"
    given = table(ddl, [
        (2**60 + 1, "2026-01-01 00:00:00.123457", 1, 2**62 + 1, "0.10", 'say "hi",\n\u00e4', "2026-02-03", 0.1),
        (2**60 + 2, "2026-01-01 00:00:00.123456", None, None, None, None, None, None),
        (2**60 + 3, None, 2, 2**53 + 1, "9999999999999999.99", "", "1900-01-01", -1e300),
    ])
    write_mart(given, f"{tmp_path}/in")
    drain(spark, str(tmp_path), ddl=ddl)
    assert rows(spark.read.parquet(f"{tmp_path}/log").drop("batch_id")) == rows(given)


def test_types_of_versions(spark, table, tmp_path):
    write_mart(table("id int, at double, amount int", [(1, 1.5, 1)]), f"{tmp_path}/in")
    stream = spark.readStream.schema("id int, at double, amount int").parquet(f"{tmp_path}/in")
    with pytest.raises(ValueError, match="at is double"):
        rising_versions(stream, "id", "at")
    with pytest.raises(ValueError, match="keep"):
        rising_versions(stream.selectExpr("id", "amount"), "id", "amount", keep="0 days")
