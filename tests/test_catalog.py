"""Registered queries against their oracle SQL, on the smallest data set."""

import datetime as dt
import importlib
import os
import re

import pytest
from oracle_check import compare, open_oracle
from pyspark.sql import functions as F

from martwright.catalog import oracle_sql, queries
from martwright.operators import apply_adjustments


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return open_oracle(sf_dir)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_oracle(spark, sf_dir, oracle, name):
    assert compare(queries()[name](spark, sf_dir), oracle, oracle_sql()[name]) is None


def test_every_signal_has_both_outcomes(spark):
    """Green rows say little about a signal that never or always fires in the sample."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("sample data not present")
    for name in ("routing_signals", "routing_rules", "merchant_health_codes"):
        df = queries()[name](spark, folder)
        flags = [c for c in df.columns if c.startswith(("sig_", "rule_"))]
        seen = df.agg(*(F.count_distinct(c).alias(c) for c in flags)).first().asDict()
        assert flags and {c: n for c, n in seen.items() if n != 2} == {}


def test_plans_stay_small(spark, sf_dir):
    """Scans of the plans that derive their inputs from the same few files; no plan multiplies rows to count."""
    most = {
        "routing_signals": 9, "checkout_routing_history": 8, "checkout_routing_mart": 10, "consolidated_mart_stored": 8,
        "consolidated_merchant_mart": 6, "merged_adjustments": 7,
    }
    for name, scans in most.items():
        assert plan_of(queries()[name](spark, sf_dir)).count("FileScan") <= scans, name
    for name in ("card_features", "order_card_features", "direct_order_ratio"):
        assert "Expand" not in plan_of(queries()[name](spark, sf_dir)), name


def test_anchors_bound_the_scan_of_facts(spark, sf_dir):
    for name, column in (("settlement_anchored_gmv", "o_orderdate"), ("rolling_per_event_value", "ts")):
        filters = re.findall(r"PushedFilters: \[[^\]]*\]", plan_of(queries()[name](spark, sf_dir)))
        assert any(f"GreaterThanOrEqual({column}" in f and f"LessThan({column}" in f for f in filters), (name, filters)


def test_a_few_adjustments_do_not_shuffle_the_base(spark):
    base = spark.range(1000).selectExpr("id as k", "1 as v", "date'2026-01-01' as at")
    updates = spark.createDataFrame([(5, 2, dt.date(2026, 1, 2))], "k long, v int, at date")
    plan = plan_of(apply_adjustments(base, F.broadcast(updates), "k", "at"))
    assert "SortMergeJoin" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_module(spark, sf_dir):
    entry = importlib.import_module("__spark_entry__")
    assert set(queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
