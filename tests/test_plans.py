"""Physical plans: what reaches the scan, what is shuffled, and how hot keys are handled."""

import contextlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from martwright.catalog import queries
from martwright.catalog.queries import BILLING, CONSOLIDATED
from martwright.operators.features import buyer_history
from martwright.operators.gateways import Gateway, normalize_gateways
from martwright.plans import billing, consolidated, settlement
from martwright.sources.sample_star import EVENTS_AS_OF, ORDERS_AS_OF, SampleStar


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    if name == "account_groups":  # runs its rounds while the plan is built; covered by its own test
        return
    plan = plan_of(queries()[name](spark, sf_dir))
    assert not re.search(r"Python|ArrowEval|BatchEval|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_single_pass_reads_each_fact_once(spark, sf_dir):
    star = SampleStar(spark, sf_dir)
    single = plan_of(consolidated.order_measures(star.orders, CONSOLIDATED))
    assert single.count("FileScan") == 1 and single.count("Exchange") == 1
    merged = plan_of(queries()["five_visual_merge"](spark, sf_dir))
    assert merged.count("orders.parquet") > plan_of(queries()["consolidated_merchant_mart"](spark, sf_dir)).count("orders.parquet")


def test_date_window_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(queries()["checkout_routing_mart"](spark, sf_dir), "formatted")
    orders = next(part for part in plan.split("Scan parquet") if "orders.parquet" in part)
    assert "GreaterThanOrEqual(o_orderdate,2001-07-25" in orders
    exposure = plan_of(settlement.merchant_exposure(SampleStar(spark, sf_dir), as_of=ORDERS_AS_OF), "formatted")
    assert "GreaterThanOrEqual(o_orderdate,2001-04-04" in exposure
    profile = plan_of(queries()["visual_5_disputes"](spark, sf_dir), "formatted")
    lines = next(part for part in profile.split("Scan parquet") if "lineitem.parquet" in part)
    assert "EqualTo(l_returnflag,R)" in lines and "l_quantity" not in lines


def test_top_one_is_cut_before_the_shuffle(spark, sf_dir):
    plan = plan_of(billing.first_charges(SampleStar(spark, sf_dir).fact_billing_charge_event))
    partial, final = plan.index("Final"), plan.index("Partial")
    assert partial < plan.index("Exchange") < final and plan.count("WindowGroupLimit") == 2


def test_pending_status_is_pushed(spark, sf_dir):
    plan = plan_of(queries()["pending_invoices"](spark, sf_dir), "formatted")
    assert "EqualTo(o_orderstatus,P)" in plan


def test_mart_leaves_out_unused_plan_sequence(spark, sf_dir):
    plan = plan_of(queries()["billing_activation_mart"](spark, sf_dir))
    assert "lag(" not in plan and EVENTS_AS_OF and BILLING.pending_status == "P"


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def test_hot_buyer_is_split_over_tasks(spark, tmp_path):
    """A third of the rows share one buyer; the join back to the totals splits that buyer's rows."""
    rnd = random.Random(8)
    data = [(i, "hot@x" if rnd.random() < 0.34 else f"b{rnd.randrange(4000)}@x", "completed", "p" * 40) for i in range(24000)]
    spark.createDataFrame(data, "id int, buyer_email string, order_status string, pad string").repartition(8).write.parquet(str(tmp_path / "o"))
    orders = spark.read.parquet(str(tmp_path / "o"))
    want = {r[0]: r[1] for r in orders.groupBy("buyer_email").count().collect()}
    with settings(spark, **SKEW):
        got = buyer_history(orders)
        rows = got.collect()
        assert "skew=true" in plan_of(got)
    assert len(rows) == 24000 and all(r.count_order_of_customer == want[r.buyer_email] for r in rows)
    spread = buyer_history(orders, spread=8).select("id", "count_order_of_customer")
    assert spread.exceptAll(got.select("id", "count_order_of_customer")).count() == 0


def test_hot_response_text_is_split_over_tasks(spark, tmp_path):
    data = [(i, " Do not honor" if i % 3 else f"text {i % 50}") for i in range(30000)]
    spark.createDataFrame(data, "checkout_id int, response_reason string").repartition(8).write.parquet(str(tmp_path / "t"))
    codes = [("do not honor", "DECLINE"), *((f"text {i}", f"C{i}") for i in range(50))]
    mapping = spark.createDataFrame(codes, "description string, signal_code string")
    gateway = Gateway(spark.read.parquet(str(tmp_path / "t")), "response_reason", mapping, "description")
    with settings(spark, **SKEW):
        long = normalize_gateways({"a": gateway})
        assert long.filter("signal_code = 'DECLINE'").count() == 20000
        long.collect()
        assert "skew=true" in plan_of(long)


def test_hot_merchant_of_requests_is_split(spark, tmp_path):
    """Joining per-merchant results to the requests splits a hot merchant."""
    rnd = random.Random(9)
    requests = [(i, 1 if rnd.random() < 0.4 else rnd.randrange(3000), "seg" * 12, float(i), 1.0, None, "pending_reconciliation") for i in range(20000)]
    ddl = "settlement_id int, merchant_id int, store_segment string, requested_amount double, reserve_hold_amount double, created_at timestamp, status string"
    spark.createDataFrame(requests, ddl).repartition(8).write.parquet(str(tmp_path / "r"))
    balances = spark.range(3000).select(F.col("id").cast("int").alias("merchant_id"), F.lit(9e9).alias("available_balance"), F.lit(0.0).alias("rolling_reserve_balance"))
    with settings(spark, **SKEW):
        got = settlement.ledger_balance({"fact_settlement_request": spark.read.parquet(str(tmp_path / "r")), "fact_merchant_account_balance": balances})
        assert got.count() == 20000
        got.collect()
        assert "skew=true" in plan_of(got)
