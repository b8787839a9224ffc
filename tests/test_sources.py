import json

import pytest
from pyspark.sql import functions as F

from martwright.plans import checkout_routing, consolidated_merchant
from martwright.session import build_session, shared_dir
from martwright.sources import (
    CatalogTables, DDL, ParquetTables, SampleStar, read_csv, schema_of, write_bucketed, write_csv, write_mart,
    write_run_metrics,
)


def test_every_declared_schema_parses():
    assert all(schema_of(name).names for name in DDL)


def test_csv_keeps_quoted_commas(spark, role, tmp_path):
    rows = role(
        "settlement_signals",
        {"settlement_id": "SET_1", "requested_amount": 613.12, "dispute_rate": 0.1, "reconciliation_rule_summary": "Large Disbursement Request (>= $10,000)"},
        {"settlement_id": "SET_2", "merchant_country": 'say "hi", ok'},
    )
    path = str(tmp_path / "csv")
    write_csv(rows, path)
    back = read_csv(spark, path, "settlement_signals")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(Exception, match="exists"):
        write_csv(rows, path)


def test_marts_run_from_parquet_tables(spark, role, tmp_path):
    for name in ("merchants", "orders", "web_sessions", "disputes"):
        write_mart(role(name, {"shop_id": 1}), f"{tmp_path}/star/{name}")
    tables = ParquetTables(spark, f"{tmp_path}/star")
    assert consolidated_merchant(tables).count() == 1
    assert len(tables) == len(list(tables)) and "orders" in tables
    with pytest.raises(KeyError):
        tables["nothing"]


def test_catalog_tables_and_bucketed_fact(spark, role, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop LOCATION '{tmp_path}/shop'")
    write_bucketed(role("orders", {"shop_id": 1, "order_id": 1}, {"shop_id": 2, "order_id": 2}), "shop.orders", "shop_id", 4)
    tables = CatalogTables(spark, {"orders": "shop.orders"})
    grouped = tables["orders"].groupBy("shop_id").agg(F.count("order_id").alias("n"))
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    assert len(tables) == 1 and list(tables) == ["orders"] and grouped.count() == 2


def test_partitioned_mart_and_json_metrics(spark, table, tmp_path):
    write_mart(table("d date, v int", [("2026-01-01", 1), ("2026-01-02", 2)]), f"{tmp_path}/m", partition_by=["d"])
    assert spark.read.parquet(f"{tmp_path}/m").filter("d = date '2026-01-02'").first().v == 2
    write_run_metrics(table("form string, mean_ms double", [("a", 1.5)]), f"{tmp_path}/j")
    lines = spark.read.text(f"{tmp_path}/j").collect()
    assert [json.loads(r.value) for r in lines] == [{"form": "a", "mean_ms": 1.5}]


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(build_session()) == spark.conf.get("spark.checkpoint.dir")


def test_default_day_is_the_current_date(spark, sf_dir):
    assert checkout_routing(SampleStar(spark, sf_dir)).count() == 0
