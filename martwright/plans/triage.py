"""Settlement triage: status and reason from amount, dispute rate and direct-traffic ratio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TriageConfig
from ..operators.signals import first_match

# Fixed values: (status, summary).
HOLD = ("HOLD_ELEVATED_DISPUTE_RESERVE", "Elevated Dispute Ratio / Traffic Anomaly")
ESCALATE = ("ESCALATE_TIER2_FINANCE_SIGNOFF", "Large Disbursement Request (>= $10,000)")
APPROVE = ("AUTO_DISBURSE_APPROVED", "Passed Standard Financial Reconciliation")


def settlement_triage(requests: DataFrame, cfg: TriageConfig = TriageConfig()) -> DataFrame:
    dispute, direct = F.col("dispute_rate"), F.col("direct_traffic_ratio")
    hold = (dispute > cfg.hold_dispute_rate) | (direct > cfg.hold_direct_ratio)
    escalate = (F.col("requested_amount") >= cfg.escalate_amount) | (dispute > cfg.escalate_dispute_rate)
    return requests.withColumns({
        "automated_reconciliation_status": first_match([(hold, HOLD[0]), (escalate, ESCALATE[0])], APPROVE[0]),
        "reconciliation_rule_summary": first_match([(hold, HOLD[1]), (escalate, ESCALATE[1])], APPROVE[1]),
    })
