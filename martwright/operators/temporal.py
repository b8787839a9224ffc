"""Ordered and time-windowed operators that survive a hot key.

A window partitioned by key alone sorts all rows of a hot key in one task. Here a key's time line
is cut into pieces (a calendar unit), windows run per (key, piece), and what a piece needs from
its neighbours is put into it as extra rows. Those rows come from a per-piece summary that is
aggregated map-side and holds one row per (key, piece); the summary itself is cut into years.
Rows of one key and instant are reduced to one before any window.

The piece is a fixed unit that the caller may choose; it doesn't depend on the data. Finer pieces
than needed cost a larger summary, coarser ones a longer task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cond_avg, cond_count, cond_max, cond_sum
from .joins import attach

#: Pieces of a summary are carried on within an era, and eras within a key.
ERA = "year"


def _last_first(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def time_bounds(df: DataFrame, ts: str) -> tuple[dt.datetime, dt.datetime] | None:
    """Smallest and largest time of a table, in one small job; None if it has none."""
    low, high = df.agg(F.min(F.col(ts).cast("timestamp")), F.max(F.col(ts).cast("timestamp"))).first()
    return None if low is None else (low, high)


def _with_same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys that may be NULL; ``right`` has one row per key."""
    named = right.withColumnsRenamed({k: f"_same_{i}" for i, k in enumerate(keys)})
    equal = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_same_{i}")) for i, k in enumerate(keys)))
    return left.join(named, equal, "left").drop(*(f"_same_{i}" for i in range(len(keys))))


def with_neighbors(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    value: str,
    previous: str | None = None,
    subsequent: str | None = None,
    piece: str | Column = "day",
) -> DataFrame:
    """Add the value of the previous and of the next row per key, ordered by (ts, tie).

    Same result as ``lag`` and ``lead`` over the whole key, NULLs last. ``piece`` is a calendar
    unit, or a column that never falls along (ts, tie) within a key: where very many rows of a
    key share an instant, ``F.struct(ts, F.floor(tie / 1000000))`` cuts that instant as well.
    """
    previous, subsequent = previous or f"previous_{value}", subsequent or f"subsequent_{value}"
    era = F.date_trunc(ERA, F.col(ts)).alias("_era")
    cut = (F.date_trunc(piece, F.col(ts)) if isinstance(piece, str) else piece).alias("_piece")
    order = F.struct(F.col(ts).isNull(), F.col(ts), F.col(tie).isNull(), F.col(tie))
    per_piece = df.groupBy(*keys, era, cut).agg(
        F.min_by(F.struct(value), order).alias("_first"),
        F.max_by(F.struct(value), order).alias("_last"),
    )
    place = F.struct(F.col("_piece").isNull(), F.col("_piece"))
    eras = per_piece.groupBy(*keys, "_era").agg(
        F.min_by("_first", place).alias("_first"), F.max_by("_last", place).alias("_last")
    )
    years = Window.partitionBy(*keys).orderBy(_last_first("_era"))
    eras = eras.select(
        *keys, "_era", F.lag("_last").over(years).alias("_era_before"), F.lead("_first").over(years).alias("_era_after")
    )
    line = Window.partitionBy(*keys, "_era").orderBy(_last_first("_piece"))
    within = per_piece.select(
        *keys, "_era", "_piece", F.lag("_last").over(line).alias("_before"), F.lead("_first").over(line).alias("_after")
    )
    around = _with_same(within, eras, [*keys, "_era"]).withColumns(
        {"_before": F.coalesce("_before", "_era_before"), "_after": F.coalesce("_after", "_era_after")}
    )
    guests = around.select(
        *keys,
        "_era",
        "_piece",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("place"), F.col("_before").alias("row")),
                F.struct(F.lit(2).alias("place"), F.col("_after").alias("row")),
            )
        ).alias("_guest"),
    ).filter("_guest.row is not null")
    rows = df.select("*", era, cut, F.lit(1).alias("_place")).unionByName(
        guests.select(
            *keys, "_era", "_piece", F.col("_guest.place").alias("_place"), F.col(f"_guest.row.{value}").alias(value)
        ),
        allowMissingColumns=True,
    )
    window = Window.partitionBy(*keys, "_era", "_piece").orderBy("_place", _last_first(ts), _last_first(tie))
    return (
        rows.withColumns({previous: F.lag(value).over(window), subsequent: F.lead(value).over(window)})
        .filter("_place = 1")
        .drop("_era", "_piece", "_place")
    )


def _pieces_between(low: Column, high: Column, piece: str) -> Column:
    """All pieces from the one of ``low`` to the one of ``high``."""
    return F.sequence(F.date_trunc(piece, low), F.date_trunc(piece, high), F.expr(f"interval 1 {piece}"))


def _touched(asked: DataFrame, key: str, low: Column, piece: str) -> DataFrame:
    """The (key, piece) pairs that a window from ``low`` to ``_at`` reaches."""
    return asked.select(key, F.explode(_pieces_between(low, F.col("_at"), piece)).alias("_piece")).distinct()


def _carried(pieces: DataFrame, key: str) -> DataFrame:
    """(key, _piece, _state): the last ``_end`` before each piece, carried over pieces and eras without one."""
    pieces = pieces.withColumn("_era", F.date_trunc(ERA, "_piece"))
    eras = pieces.groupBy(key, "_era").agg(
        F.max_by("_end", F.when(F.col("_end").isNotNull(), F.col("_piece"))).alias("_era_end")
    )
    before = Window.partitionBy(key).orderBy("_era").rowsBetween(Window.unboundedPreceding, -1)
    eras = eras.select(key, "_era", F.last("_era_end", ignorenulls=True).over(before).alias("_era_state"))
    earlier = Window.partitionBy(key, "_era").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    within = pieces.select(key, "_era", "_piece", F.last("_end", ignorenulls=True).over(earlier).alias("_state"))
    return within.join(eras, [key, "_era"]).select(key, "_piece", F.coalesce("_state", "_era_state").alias("_state"))


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    tie: str | None = None,
    piece: str = "day",
    within: str | None = None,
) -> DataFrame:
    """Add to every left row the ``values`` of the latest right row at or before its time.

    Right rows of the same key and time are reduced to the one with the largest ``tie`` first, and
    left rows of the same key and time are answered once. With ``within``, an interval such as
    ``24 hours``, right rows are read only in the pieces that reach back so far; older ones may
    still be found in the first of these pieces, and are for the caller to leave out.
    """
    version = F.struct(F.col(tie or right_ts).alias("_tie"), F.struct(*values).alias("_values"))
    at = F.col(left_ts)
    asked = (
        left.filter(F.col(key).isNotNull() & at.isNotNull())
        .select(key, at.alias("_at"))
        .distinct()
        .withColumn("_piece", F.date_trunc(piece, "_at"))
    )
    known = right.filter(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).withColumn(
        "_piece", F.date_trunc(piece, right_ts)
    )
    if within:
        reach = _touched(asked, key, F.col("_at") - F.expr(f"interval {within}"), piece)
        known = attach(known, reach, [key, "_piece"], "left_semi")
    state = (
        known.groupBy(key, F.col(right_ts).alias("_at"), "_piece")
        .agg(F.max(version).alias("_version"))
        .select(key, "_at", "_piece", F.col("_version._values").alias("_state"))
    )
    pieces = (
        asked.select(key, "_piece")
        .unionByName(state.select(key, "_piece", "_at", "_state"), allowMissingColumns=True)
        .groupBy(key, "_piece")
        .agg(F.max_by("_state", "_at").alias("_end"))
    )
    rows = (
        _carried(pieces, key)
        .filter("_state is not null")
        .withColumn("_place", F.lit(0))
        .unionByName(state.withColumn("_place", F.lit(1)), allowMissingColumns=True)
        .unionByName(asked.withColumn("_place", F.lit(2)), allowMissingColumns=True)
    )
    so_far = (
        Window.partitionBy(key, "_piece")
        .orderBy(F.col("_at").asc_nulls_first(), "_place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = rows.withColumn("_now", F.last("_state", ignorenulls=True).over(so_far)).filter("_place = 2")
    return attach(left.withColumn("_at", at), found.select(key, "_at", "_now"), [key, "_at"]).select(
        *left.columns, *(F.col(f"_now.{v}").alias(v) for v in values)
    )


def rolling_per_event(
    anchors: DataFrame,
    facts: DataFrame,
    anchor_id: str,
    key: str,
    anchor_ts: str,
    ts: str,
    days: int,
    sums: Mapping[str, Column],
    piece: str = "day",
    bounds: tuple[dt.datetime, dt.datetime] | None = None,
) -> DataFrame:
    """Sums of facts in ``[anchor − days, anchor)`` of the same key, one row per anchor row.

    A window is the whole pieces it begins in and passes, less what its first piece has before
    it, plus what its last piece has before its end. Running sums therefore never leave a piece,
    no anchor meets a fact row by row, and only facts in pieces that a window touches are read
    past the join with these. Anchors of one key and time are answered once, and facts of one key
    and time are added up before the shuffle. ``bounds``, the smallest and largest anchor time
    (:func:`time_bounds`), becomes a filter that reaches the scan of the facts.

    Sums must be of exact types (decimal, integer): differences of binary fractions don't cancel.
    """
    inexact = [f.name for f in facts.select(*(c.alias(n) for n, c in sums.items())).schema.fields
               if f.dataType.typeName() in ("double", "float")]
    if inexact:
        raise ValueError(f"cast to decimal before summing: {', '.join(inexact)}")
    names = list(sums)
    back = F.expr(f"interval {days} days")
    if bounds:
        facts = facts.filter((F.col(ts) >= F.lit(bounds[0] - dt.timedelta(days=days))) & (F.col(ts) < F.lit(bounds[1])))
    asked = (
        anchors.filter(F.col(key).isNotNull() & F.col(anchor_ts).isNotNull())
        .select(key, F.col(anchor_ts).cast("timestamp").alias("_at"))
        .distinct()
    )
    known = facts.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("_piece", F.date_trunc(piece, ts))
    known = attach(known, _touched(asked, key, F.col("_at") - back, piece), [key, "_piece"], "left_semi")
    instants = (
        known.groupBy(key, "_piece", F.col(ts).cast("timestamp").alias("_when"))
        .agg(*(F.sum(F.coalesce(col, F.lit(0))).alias(name) for name, col in sums.items()))
        .withColumns({"_late": F.lit(0), "_place": F.lit(1)})
    )
    first, last = F.date_trunc(piece, F.col("_at") - back), F.date_trunc(piece, "_at")

    def probe(at: Column, of: Column, sign: int, late: int) -> Column:
        return F.struct(
            of.alias("_piece"), at.alias("_when"), F.lit(sign).alias("_sign"), F.lit(late).alias("_late")
        )

    nowhen = F.lit(None).cast("timestamp")
    whole = F.filter(_pieces_between(F.col("_at") - back, F.col("_at"), piece), lambda p: p < last)
    ends = F.array(probe(F.col("_at"), last, 1, 0), probe(F.col("_at") - back, first, -1, 0))
    probes = asked.select(
        key, "_at", F.explode(F.concat(ends, F.transform(whole, lambda p: probe(nowhen, p, 1, 1)))).alias("_p")
    ).select(key, "_at", "_p.*", F.lit(0).alias("_place"))
    so_far = (
        Window.partitionBy(key, "_piece")
        .orderBy("_late", F.col("_when").asc_nulls_first(), "_place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = instants.unionByName(probes, allowMissingColumns=True).withColumns(
        {n: F.coalesce(F.sum(n).over(so_far), F.lit(0)) for n in names}
    )
    found = (
        running.filter("_sign is not null")
        .groupBy(key, "_at")
        .agg(*(F.sum(F.col(n) * F.col("_sign")).alias(n) for n in names))
    )
    rows = anchors.select(anchor_id, key, F.col(anchor_ts).cast("timestamp").alias("_at"))
    return attach(rows, found, [key, "_at"]).select(anchor_id, *(F.coalesce(n, F.lit(0)).alias(n) for n in names))


@dataclass(frozen=True)
class Rolling:
    """One windowed measure: ``kind`` of ``value`` over the last ``days`` days.

    "Last N days" starts N + ``extra_days`` days before the anchor day and, by default, excludes
    the anchor day itself.
    """

    name: str
    kind: str
    value: Column
    days: int
    extra_days: int = 1
    bounded: bool = True

    def condition(self, ts: Column, as_of: Column) -> Column:
        inside = ts >= F.date_sub(as_of, self.days + self.extra_days)
        return inside & (ts < as_of) if self.bounded else inside

    def expression(self, ts: Column, as_of: Column) -> Column:
        build = {"avg": cond_avg, "max": cond_max, "sum": cond_sum, "count": cond_count}[self.kind]
        return build(self.condition(ts, as_of), self.value).alias(self.name)


def rolling_as_of(
    df: DataFrame, keys: Sequence[str], ts: str, as_of: Column, specs: Sequence[Rolling], prune: bool = True
) -> DataFrame:
    """All windowed measures of a fact in one pass.

    With ``prune`` the widest window is also a filter, which reaches the file scan; keys without
    a row in it are then absent.
    """
    at = F.col(ts)
    if prune:
        df = df.filter(at >= F.date_sub(as_of, max(s.days + s.extra_days for s in specs)))
        if all(s.bounded for s in specs):
            df = df.filter(at < as_of)
    return df.groupBy(*keys).agg(*(s.expression(at, as_of) for s in specs))
