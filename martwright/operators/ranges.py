"""Joins on overlapping stretches of time, and dimensions that hold for a stretch.

Time is cut into bins of a fixed size. Each interval goes into the bins it touches, bins are joined on equality together with
the key, and the exact condition is checked after that. So no join here compares every row of a key with every other, and the
rows of a hot key are dealt by bin; adaptive execution splits a bin that is still too large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import attach
from .temporal import with_neighbors

HOUR, DAY = 3600, 86_400


def time_bin(ts: str, seconds: int) -> Column:
    """Number of the bin of a time. It never falls as time goes on."""
    return F.expr(f"unix_micros(cast(`{ts}` as timestamp)) div {seconds * 1_000_000}L")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    bin_seconds: int = HOUR,
    clip: bool = False,
) -> DataFrame:
    """All pairs of rows with equal keys whose spans (start, end; both ends included) overlap.

    A pair is found in every bin that both spans touch and kept in the first of them, so it comes out once. ``bin_seconds``
    should be near the usual length of a span: smaller bins repeat rows more often, larger ones meet more pairs in vain.
    With ``clip``, right spans are put into bins only where there are left spans at all, and a null end stands for
    one that is still open. A null key or start (or end, without ``clip``) overlaps nothing, nor does a span that ends before it
    starts.
    """
    keys = [on] if isinstance(on, str) else list(on)
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {k.lower() for k in keys}
    if shared:
        raise ValueError(f"columns on both sides: {', '.join(sorted(shared))}")
    first, last = (time_bin(c, bin_seconds) for c in right_span)
    if clip:
        span = left.agg(F.min(time_bin(left_span[0], bin_seconds)).alias("a"), F.max(time_bin(left_span[1], bin_seconds)).alias("b"))
        first = F.greatest(first, span.select("a").scalar())
        last = F.least(last, span.select("b").scalar())  # least() skips a null

    def binned(df: DataFrame, span: tuple[str, str], low: Column, high: Column, name: str) -> DataFrame:
        start, end = F.col(span[0]), F.col(span[1])
        known = start.isNotNull() & (end.isNull() | (start <= end))
        for k in keys:
            known = known & F.col(k).isNotNull()
        rows = df.filter(known).withColumns({name: low, "_high": high}).filter(F.col(name) <= F.col("_high"))
        return rows.withColumn("_bin", F.explode(F.sequence(name, "_high"))).drop("_high")

    a = binned(left, left_span, time_bin(left_span[0], bin_seconds), time_bin(left_span[1], bin_seconds), "_low_a")
    b = binned(right, right_span, first, last, "_low_b")
    end = F.col(right_span[1])
    overlaps = (F.col(right_span[0]) <= F.col(left_span[1])) & (F.coalesce(end >= F.col(left_span[0]), F.lit(clip) & end.isNull()))
    return a.join(b, [*keys, "_bin"]).filter((F.col("_bin") == F.greatest("_low_a", "_low_b")) & overlaps).drop("_bin", "_low_a", "_low_b")


def validity_intervals(log: DataFrame, keys: Sequence[str], at: str, tie: str, piece: str = "month") -> DataFrame:
    """Turn a change log into versions: each change with ``valid_from`` and ``valid_to``, when the key's next one came.

    A version holds from its time (included) to the next (excluded); a null ``valid_to`` is still open. Of several changes of
    a key at one time the one with the largest ``tie`` counts. Changes without a time are left out. The next change is
    looked up by pieces of time, so a key that changes all the time is not sorted in one task.
    """
    others = [c for c in log.columns if c not in (*keys, at)]
    row = F.max(F.struct(F.col(tie).alias("_tie"), F.struct(*others).alias("_row"))).alias("_last")
    changes = log.filter(F.col(at).isNotNull()).groupBy(*keys, at).agg(row).select(*keys, at, "_last._row.*")
    ordered = with_neighbors(changes, list(keys), at, at, at, previous="_previous", subsequent="valid_to", piece=piece)
    return ordered.drop("_previous").withColumnRenamed(at, "valid_from")


def session_ip_any_mismatch(
    orders: DataFrame, sessions: DataFrame, order_id: str, key: str, order_ts: str, session_ts: str, hours: int = 24,
    order_ip: str = "order_ip", session_ip: str = "ip_address", bin_seconds: int = HOUR,
) -> DataFrame:
    """Compare each order's address with all sessions of its key in the ``hours`` up to the order.

    Adds ``same_ip_seen`` and ``other_ip_seen`` (0/1), ``sig_order_session_ip_any_mismatch`` (some session used another
    address) and ``sig_order_session_ip_never_matched`` (there were sessions, and none used the order's).

    Sessions are first reduced to one row per key, address and bin, with their first and last time. A bin is no longer than
    the window, so the window covers it whole or from one side, and first and last decide exactly whether one of its
    sessions is inside. ``order_id`` must be unique. Sessions without an address say nothing; an order without one
    matches nothing and differs from nothing.
    """
    if bin_seconds > hours * HOUR:
        raise ValueError("bins must not be longer than the window")
    seen = (
        sessions.filter(F.col(session_ip).isNotNull())
        .groupBy(key, F.col(session_ip).alias("_ip"), time_bin(session_ts, bin_seconds).alias("_in"))
        .agg(F.min(session_ts).alias("_first"), F.max(session_ts).alias("_last"))
        .drop("_in")
    )
    asked = orders.select(
        F.col(order_id).alias("_order"), key, F.col(order_ip).alias("_order_ip"),
        (F.col(order_ts) - F.expr(f"interval {hours} hours")).alias("_from"), F.col(order_ts).alias("_to"),
    )
    met = interval_join(asked, seen, key, ("_from", "_to"), ("_first", "_last"), bin_seconds)
    found = met.groupBy("_order").agg(
        F.max((F.col("_ip") == F.col("_order_ip")).cast("int")).alias("_same"),
        F.max((F.col("_ip") != F.col("_order_ip")).cast("int")).alias("_other"),
    )
    rows = attach(orders.withColumn("_order", F.col(order_id)), found, "_order").drop("_order")
    same, other = F.coalesce("_same", F.lit(0)), F.coalesce("_other", F.lit(0))
    return rows.withColumns(
        {
            "same_ip_seen": same,
            "other_ip_seen": other,
            "sig_order_session_ip_any_mismatch": other,
            "sig_order_session_ip_never_matched": F.when((other == 1) & (same == 0), 1).otherwise(0),
        }
    ).drop("_same", "_other")
