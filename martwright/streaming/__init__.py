"""Structured Streaming side of the adjustments feed."""

from .adjustments import compact, current_state, log_adjustments, trim
from .versions import log_versions, rising_versions, state_of, thinned

__all__ = [
    "compact", "current_state", "log_adjustments", "log_versions", "rising_versions", "state_of", "thinned", "trim",
]
