"""martwright: decision-ready e-commerce marts as PySpark DataFrame plans."""

from .config import (
    BillingConfig,
    CheckoutConfig,
    ConsolidatedConfig,
    MerchantHealthConfig,
    SettlementConfig,
    TriageConfig,
)
from .plans import (
    billing_activation,
    checkout_routing,
    consolidated_merchant,
    five_visual_merge,
    merchant_360,
    settlement_reconciliation,
    settlement_triage,
)
from .session import build_session

__all__ = [
    "BillingConfig", "CheckoutConfig", "ConsolidatedConfig", "MerchantHealthConfig", "SettlementConfig",
    "TriageConfig", "billing_activation", "build_session", "checkout_routing", "consolidated_merchant",
    "five_visual_merge", "merchant_360", "settlement_reconciliation", "settlement_triage",
]
