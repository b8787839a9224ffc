"""Longest-prefix match and linkage over several attributes."""

import ipaddress
import os
import random

import pytest
from pyspark.sql import functions as F

from martwright.catalog import queries
from martwright.functions import address_key
from martwright.operators.linkage import account_groups, link_entities, linkage_attributes
from martwright.operators.networks import ip_number, longest_prefix

ODD = [None, "", "1.2.3", "1.2.3.4.5", "256.1.1.1", "1.2.3.x", "::1", " 10.0.0.1 ", "010.0.0.1", "99999999999.1.1.1", "255.255.255.255", "0.0.0.0"]


def test_ip_number(spark):
    rows = spark.createDataFrame([(t,) for t in ODD], "ip string").select("ip", ip_number("ip").alias("n")).collect()
    got = {r.ip: r.n for r in rows}
    ten = int(ipaddress.ip_address("10.0.0.1"))
    known = {" 10.0.0.1 ": ten, "010.0.0.1": ten, "255.255.255.255": 2**32 - 1, "0.0.0.0": 0}
    assert got == {t: known.get(t) for t in ODD}


def test_longest_prefix_equals_brute_force(spark):
    g = random.Random(3)
    nets = {f"10.{g.randrange(4)}.{g.randrange(4)}.{g.randrange(256)}/{g.choice([8, 15, 16, 22, 24, 30, 32])}" for _ in range(60)}
    nets |= {"0.0.0.0/1", "10.1.0.0/16", "10.1.2.3/16", "192.168.0.0/16"}
    texts = [f"{g.choice([10, 10, 192, 77])}.{g.randrange(5)}.{g.randrange(5)}.{g.randrange(256)}" for _ in range(200)] + ["200.1.1.1"]
    texts += ["10.1.2.3"] * 300 + ODD  # one address, and so one network, holds more than a third of all rows
    table = spark.createDataFrame([(n,) for n in [*nets, None, "x/8", "10.0.0.0", "10.0.0.0/33", "10.0.0.0/", "10.0.0.0/-1"]], "net string")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, ip string").withColumn("length", F.lit("kept"))
    got = {r.i: r for r in longest_prefix(df, "ip", table, "net").collect()}
    parsed = sorted(((n, ipaddress.ip_network(n, strict=False)) for n in nets), key=lambda p: p[0])
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        try:
            address = ipaddress.ip_address(text.strip().replace("010.", "10."))
        except (ValueError, AttributeError):
            address = None
        fits = [(p.prefixlen, n) for n, p in parsed if address is not None and address.version == 4 and address in p]
        longest = max((n for n, _ in fits), default=None)
        name = min((n for size, n in fits if size == longest), default=None)
        assert (got[i].matched_length, got[i].matched_prefix, got[i]["length"]) == (longest, name, "kept"), text
    assert longest_prefix(df, "ip", table.limit(0), "net").filter("matched_prefix is not null").count() == 0
    assert longest_prefix(df.limit(0), "ip", table, "net").count() == 0


def test_plan_has_one_equi_join_per_lookup(spark):
    df = spark.range(10).select(F.concat(F.lit("10.0.0."), "id").alias("ip"))
    table = spark.createDataFrame([("10.0.0.0/24",), ("10.0.0.0/8",)], "prefix string")
    found = longest_prefix(df, "ip", table)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Subquery" in plan


def test_address_key(spark):
    texts = ["12 Main St., Über-Straße", "  12  MAIN st über straße", "12 Main St. Über-Straße #", ".,", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "a string").select(address_key("a").alias("k")).collect()
    assert [r.k for r in rows] == ["12 main st über straße"] * 3 + [None] * 3


def test_groups_over_several_attributes(spark):
    paid = spark.createDataFrame([(1, " Card "), (2, "card"), (3, None), (4, "")], "account_id long, instrument string")
    lives = spark.createDataFrame([(2, "1 A St."), (3, "1, a st"), (5, "elsewhere")], "account_id long, address string")
    used = spark.createDataFrame([(3, "10.0.1.7"), (6, "10.0.1.99"), (7, "10.0.2.1"), (8, "10.0.3.1"), (9, "bad"), (10, "bad")], "account_id long, ip_address string")
    nets = spark.createDataFrame([("10.0.0.0/16",), ("10.0.1.0/24",)], "prefix string")
    stars = link_entities(linkage_attributes(paid, lives, used, nets), "account_id", "attribute", "value")
    assert {(r.attribute, r.account_id) for r in stars.collect()} == {("instrument", 1), ("instrument", 2), ("address", 2), ("address", 3), ("subnet", 3), ("subnet", 6)}
    assert {r.account_id: r.group_id for r in account_groups(stars, "account_id").collect()} == {1: 1, 2: 1, 3: 1, 6: 1}


def test_sample_has_large_groups_of_each_kind(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("sample data not present")
    largest = {r.attribute: r.n for r in queries()["account_links"](spark, folder).groupBy("attribute").agg(F.max("group_size").alias("n")).collect()}
    assert set(largest) == {"instrument", "address", "subnet"} and largest["subnet"] >= 4
    groups = queries()["account_groups"](spark, folder).groupBy("group_id").count()
    assert groups.filter("count >= 4").count() > 5
    assert queries()["network_prefixes"](spark, folder).groupBy("matched_length").count().count() == 3
