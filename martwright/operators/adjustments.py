"""Merge off-cycle adjustments into a base table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import attach, first_per_key


def latest_updates(updates: DataFrame, key: str, version: str, tie: str | None = None) -> DataFrame:
    """The update of largest version per key, then of largest ``tie``. An update without a key names no row and is left out."""
    order = [F.col(version).desc_nulls_last()]
    if tie:
        order.append(F.col(tie).desc_nulls_last())
    return first_per_key(updates.filter(F.col(key).isNotNull()), [key], order)


def apply_adjustments(
    base: DataFrame, updates: DataFrame, key: str, version: str, tie: str | None = None
) -> DataFrame:
    """Latest version wins per base row; base rows lose against an update of the same version.

    ``tie`` orders updates that share a version (largest wins). Updates may bring new keys. Base
    rows never meet each other: a NULL key matches nothing, and each row of a repeated key is
    merged for itself. An update without a key names no row and is left out.

    The updates are reduced first and joined to the base, so a few updates to a large base are
    broadcast and the base is not shuffled. Columns that the updates lack become NULL.
    """
    latest = latest_updates(updates, key, version, tie)
    columns = [c for c in base.columns if c != key]
    given = set(latest.columns)
    new_values = F.struct(
        *((F.col(c) if c in given else F.lit(None).cast(base.schema[c].dataType)).alias(c) for c in columns)
    )
    named = latest.select(key, new_values.alias("_new"))
    joined = attach(base, named, key)
    newer = F.col(version).isNull() | (F.col(f"_new.{version}") >= F.col(version))
    wins = F.col("_new").isNotNull() & F.coalesce(newer, F.lit(False))
    merged = joined.select(
        *(
            F.col(c) if c == key else F.when(wins, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            for c in base.columns
        )
    )
    known = attach(base.select(key), named.select(key), key, "left_semi").distinct()
    fresh = latest.join(known, key, "left_anti").select(
        *((F.col(c) if c in given else F.lit(None).cast(base.schema[c].dataType)).alias(c) for c in base.columns)
    )
    return merged.unionByName(fresh)
