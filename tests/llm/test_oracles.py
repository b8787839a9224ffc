"""Registered queries against their oracle SQL, on the smallest data set."""

import importlib
import os

import pytest
from oracle_check import compare, open_oracle

from martwright.llm.queries import queries
from martwright.llm.sql import oracle_sql


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return open_oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, sf_dir, oracle, name):
    assert compare(queries()[name](spark, sf_dir), oracle, oracle_sql()[name]) is None


def test_outliers_equal_oracle_where_groups_have_some(spark, sf_dir):
    """The ten times larger set: groups of 10 texts and more, documents rejected by their distance alone."""
    folder = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if not os.path.isdir(folder):
        pytest.skip("sample data not present")
    name = "op10_quality_rules"
    assert compare(queries()[name](spark, folder), open_oracle(folder), oracle_sql()[name]) is None


def test_one_query_for_each_operator_and_the_pipeline():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
    assert set(queries()) <= names
