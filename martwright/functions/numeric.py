"""Numeric helpers as Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col

EARTH_RADIUS_MILES = 3958.8


def safe_div(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division that gives NULL on a zero denominator (ANSI mode would raise)."""
    return as_col(numerator).cast("double") / F.nullif(as_col(denominator).cast("double"), F.lit(0.0))


def ratio_or_zero(numerator: Column | str, denominator: Column | str) -> Column:
    """Like :func:`safe_div` but 0 unless the denominator is positive."""
    den = as_col(denominator)
    return F.when(den > 0, safe_div(numerator, den)).otherwise(F.lit(0.0))


def zero_if_null(value: Column | str) -> Column:
    return F.coalesce(as_col(value), F.lit(0))


def as_of_day(as_of: dt.date | str | None) -> Column:
    """The anchor day of a mart: a given date, or the session's current date."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def days_between(later: Column, earlier: Column) -> Column:
    """Calendar days, counted by day boundaries and not by elapsed 24 hours."""
    return F.datediff(later.cast("date"), earlier.cast("date"))


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in miles."""
    rise = F.sin(F.radians(lat2 - lat1) / 2)
    run = F.sin(F.radians(lon2 - lon1) / 2)
    chord = rise * rise + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * run * run
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
