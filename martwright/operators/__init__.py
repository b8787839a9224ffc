"""DataFrame-level operators."""

from .adjustments import apply_adjustments
from .features import (
    buyer_history,
    buyer_velocity,
    card_features,
    email_quality,
    geo_features,
    ip_footprint,
    merchant_daily_metrics,
    multi_store_rate, order_card_features,
    session_ip_mismatch,
    tracking_reuse,
)
from .gateways import Gateway, checkouts_with_code, code_list_of, gateway_code_lists, normalize_gateways
from .joins import attach, enrich, filter_ids, first_per_key, id_list, literal_rows, lookup_text, merge_on, with_config
from .linkage import account_groups, link_entities, linkage_attributes, linkage_signal
from .networks import ip_number, longest_prefix
from .ranges import interval_join, session_ip_any_mismatch, validity_intervals
from .registry import restricted_destinations, restricted_destinations_as_of, restricted_merchants, restricted_periods
from .signals import Signal, add_codes, add_flags, code_string, first_match
from .temporal import Rolling, as_of_join, rolling_as_of, rolling_per_event, time_bounds, with_neighbors

__all__ = [
    "Gateway", "Rolling", "Signal", "account_groups", "add_codes", "add_flags", "apply_adjustments",
    "as_of_join", "attach", "buyer_history", "buyer_velocity", "card_features", "checkouts_with_code",
    "code_list_of", "code_string", "email_quality", "enrich", "filter_ids", "first_match", "first_per_key",
    "gateway_code_lists", "geo_features", "id_list", "interval_join", "ip_footprint", "ip_number", "link_entities",
    "linkage_attributes", "linkage_signal", "longest_prefix", "restricted_destinations_as_of", "restricted_periods",
    "session_ip_any_mismatch", "validity_intervals",
    "literal_rows", "lookup_text", "merchant_daily_metrics", "merge_on", "multi_store_rate", "order_card_features",
    "normalize_gateways", "restricted_destinations", "restricted_merchants", "rolling_as_of",
    "rolling_per_event", "time_bounds", "session_ip_mismatch", "tracking_reuse", "with_config", "with_neighbors",
]
