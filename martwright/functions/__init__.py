"""Column-level building blocks."""

from .aggregates import (
    any_flag,
    cond_avg,
    cond_count,
    cond_count_distinct,
    cond_max,
    cond_sum,
    ratio_of_sums,
)
from .numeric import as_of_day, days_between, haversine_miles, ratio_or_zero, safe_div, zero_if_null
from .text import (
    address_key,
    as_col,
    blank_to_null,
    code_list,
    contains_flag,
    delimiter_tier,
    email_domain,
    is_valid_email,
    map_code,
    norm_key,
    pair,
    pct_text,
    regex_flag,
    repeated,
)

__all__ = [
    "address_key", "any_flag", "as_col", "as_of_day", "blank_to_null", "code_list", "cond_avg", "cond_count",
    "cond_count_distinct", "cond_max", "cond_sum", "contains_flag", "days_between", "delimiter_tier",
    "email_domain", "haversine_miles", "is_valid_email", "map_code", "norm_key", "pair", "pct_text",
    "ratio_of_sums", "ratio_or_zero", "regex_flag", "repeated", "safe_div", "zero_if_null",
]
