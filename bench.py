"""Time the headline queries on one data folder and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_ROUNDS (default 5),
BENCH_CONF (extra settings as key=value;key=value).
Each query is planned and fully executed into a no-op sink. One round over all queries warms the JVM
up; of the rounds after it the median per query counts.

The single-pass speed-up compares the mart with its five-query form: five queries, one after the other,
without the merge that a client would still have to do. ``five_visual_merge`` is the same five queries
merged inside one Spark job.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from martwright.catalog import queries
from martwright.session import build_session

HEADLINE = (
    "consolidated_merchant_mart", "five_visual_merge", "checkout_routing_mart", "checkout_routing_history",
    "merchant_360_mart", "settlement_mart", "billing_activation_mart", "gateway_normalized", "plan_neighbors",
    "first_instrument_attempt", "ledger_as_of_request", "settlement_anchored_gmv", "buyer_history", "tracking_reuse",
    "session_ip_mismatch", "merged_adjustments",
)


def run_once(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def plan_size(spark, query, folder: str) -> dict[str, int]:
    """File scans and shuffles of the plan before adaptive changes."""
    plan = query(spark, folder)._jdf.queryExecution().executedPlan().toString()
    return {"scans": plan.count("FileScan"), "shuffles": plan.count("Exchange hashpartitioning")}


VISUALS = ("visual_1_profile", "visual_2_recent", "visual_3_sessions", "visual_4_velocity", "visual_5_disputes")


def shuffled_mb(spark, query, folder: str) -> float:
    """MB written by the shuffles of one run, from the metrics of the plan that ran."""
    execution = query(spark, folder)._jdf.queryExecution()
    execution.toRdd().count()

    def total(node) -> int:
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return total(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return total(node.plan())
        found = node.metrics().get("shuffleBytesWritten")
        children = node.children()
        below = sum(total(children.apply(i)) for i in range(children.size()))
        return below + (found.get().value() if found.isDefined() else 0)

    return round(total(execution.executedPlan()) / 1e6, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "5"))
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="martwright-bench-"),
        **dict(pair.split("=", 1) for pair in os.environ.get("BENCH_CONF", "").split(";") if pair),
    }
    spark = build_session("martwright-bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    runs = [{name: run_once(spark, registered[name], folder) for name in HEADLINE + VISUALS} for _ in range(rounds + 1)]
    seconds = {name: round(statistics.median(run[name] for run in runs[1:]), 4) for name in HEADLINE}
    five = round(sum(statistics.median(run[name] for run in runs[1:]) for name in VISUALS), 4)
    shops = spark.read.parquet(f"{folder}/customer.parquet").count()
    mart = seconds["consolidated_merchant_mart"]
    forms = ("consolidated_merchant_mart", "five_visual_merge")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "merchants_per_sec": round(shops / mart, 1),
        "five_queries_sec": five,
        "single_pass_speedup": round(five / mart, 2),
        "merged_form_ratio": round(seconds["five_visual_merge"] / mart, 2),
        "plans": {n: plan_size(spark, registered[n], folder) for n in forms},
        "shuffle_mb": {n: shuffled_mb(spark, registered[n], folder) for n in forms},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
