"""Aggregate expressions that carry their own condition.

All of them merge partial results map-side, so a hot group is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import safe_div
from .text import as_col


def _only(condition: Column | None, value: Column) -> Column:
    return value if condition is None else F.when(condition, value)


def cond_count(condition: Column | None, value: Column | str) -> Column:
    return F.count(_only(condition, as_col(value)))


def cond_count_distinct(condition: Column | None, value: Column | str) -> Column:
    return F.count_distinct(_only(condition, as_col(value)))


def cond_sum(condition: Column | None, value: Column | str) -> Column:
    return F.sum(_only(condition, as_col(value)))


def cond_max(condition: Column | None, value: Column | str) -> Column:
    return F.max(_only(condition, as_col(value)))


def cond_avg(condition: Column | None, value: Column | str) -> Column:
    """Mean as double, NULL when nothing matches.

    Written as sum / count: with decimal input the sum is exact and does not depend on row order.
    """
    picked = _only(condition, as_col(value))
    return safe_div(F.sum(picked), F.count(picked))


def any_flag(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


def ratio_of_sums(numerator: Column | str, denominator: Column | str) -> Column:
    return safe_div(F.sum(as_col(numerator)), F.sum(as_col(denominator)))
