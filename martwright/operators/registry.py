"""Match payout destinations against a registry of restricted accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import any_flag, code_list, norm_key
from .joins import attach, lookup_text
from .ranges import DAY, interval_join, validity_intervals


def restricted_merchants(payout_settings: DataFrame, registry: DataFrame) -> DataFrame:
    """Merchants with a restricted payout e-mail: flag and the matching registry spellings."""
    matched = lookup_text(
        payout_settings.select("merchant_id", "payout_destination_email"),
        "payout_destination_email",
        registry.withColumn("_entry", F.col("restricted_email")),
        "_entry",
        "restricted_email",
        how="inner",
    )
    return matched.groupBy("merchant_id").agg(
        any_flag(F.col("restricted_email").isNotNull()).alias("is_matched"),
        code_list("restricted_email").alias("flagged_destination_emails"),
    )


def restricted_destinations(requests: DataFrame, payout_settings: DataFrame, registry: DataFrame) -> DataFrame:
    """The same per settlement request; requests without a match are absent."""
    merchants = restricted_merchants(payout_settings, registry)
    return attach(requests.select("settlement_id", "merchant_id"), merchants, "merchant_id", "inner").select(
        "settlement_id", F.col("is_matched").alias("is_destination_restricted"), "flagged_destination_emails"
    )


def restricted_periods(payout_changes: DataFrame, registry_changes: DataFrame) -> DataFrame:
    """(merchant_id, restricted_email, restricted_from, restricted_to): when a merchant paid out to a listed account.

    ``payout_changes`` logs the destination of each payout setting (a null destination removes it), ``registry_changes``
    when an account was listed or taken off. An open end is null.
    """
    settings = validity_intervals(payout_changes, ["merchant_id", "setting_id"], "changed_at", "change_id")
    listed = validity_intervals(
        registry_changes.withColumn("_key", norm_key("restricted_email")), ["_key"], "changed_at", "change_id"
    ).filter("is_listed")
    pay = settings.select("merchant_id", norm_key("payout_destination_email").alias("_key"), F.col("valid_from").alias("_a"), F.col("valid_to").alias("_b"))
    both = pay.filter("_key is not null").join(listed.select("_key", "restricted_email", "valid_from", "valid_to"), "_key")
    return both.select(
        "merchant_id",
        "restricted_email",
        F.greatest("_a", "valid_from").alias("restricted_from"),
        F.least("_b", "valid_to").alias("restricted_to"),
    ).filter("restricted_to is null or restricted_from < restricted_to")


def restricted_destinations_as_of(
    requests: DataFrame, payout_changes: DataFrame, registry_changes: DataFrame, bin_days: int = 30
) -> DataFrame:
    """Per settlement request, whether a payout destination of the merchant was listed when the request was made.

    Later changes of setting or registry say nothing about it. Requests (and periods) of one merchant are dealt by time.
    """
    asked = requests.select("settlement_id", "merchant_id", F.col("created_at").cast("timestamp").alias("_at"))
    met = interval_join(
        asked, restricted_periods(payout_changes, registry_changes), "merchant_id", ("_at", "_at"),
        ("restricted_from", "restricted_to"), bin_days * DAY, clip=True,
    ).filter("restricted_to is null or _at < restricted_to")
    found = met.groupBy("settlement_id").agg(code_list("restricted_email").alias("flagged_destination_emails"))
    return attach(requests.select("settlement_id"), found, "settlement_id").select(
        "settlement_id",
        F.when(F.col("flagged_destination_emails").isNotNull(), 1).otherwise(0).alias("is_destination_restricted"),
        "flagged_destination_emails",
    )
