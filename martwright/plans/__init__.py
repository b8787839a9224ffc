"""The marts."""

from .billing import billing_activation
from .checkout import checkout_routing
from .consolidated import consolidated_merchant, five_visual_merge
from .merchant360 import merchant_360
from .settlement import settlement_reconciliation
from .triage import settlement_triage

__all__ = [
    "billing_activation", "checkout_routing", "consolidated_merchant", "five_visual_merge", "merchant_360",
    "settlement_reconciliation", "settlement_triage",
]
