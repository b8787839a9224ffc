"""Windowed measures from mergeable state per key and day.

A mart over the last 30 days that is run every day reads every row 30 times. Here each (key, day) is reduced once to partials
that merge (sums, counts, extremes, distinct-count sketches) and kept as a table of days. A run merges the days of its
windows, and a late row makes only its own day be computed again, from a scan that is limited to the changed days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import as_col, safe_div
from ..session import list_folder
from ..snapshots import SnapshotTable

#: Sketches hold 2**SKETCH_BITS registers: a relative standard error of about 1.04 / sqrt(4096), 1.6 %, whatever the number of
#: values; small counts are exact.
SKETCH_BITS = 12
DAY = "day"


@dataclass(frozen=True)
class Measure:
    """``kind`` (avg, sum, count, max, min, distinct) of ``value``. A distinct count is a sketch, and an estimate."""

    name: str
    kind: str
    value: Column | str

    def partials(self) -> dict[str, Column]:
        build = {
            "sum": {"sum": F.sum}, "count": {"n": F.count}, "avg": {"sum": F.sum, "n": F.count}, "max": {"max": F.max},
            "min": {"min": F.min}, "distinct": {"sketch": lambda v: F.hll_sketch_agg(v, SKETCH_BITS)},
        }[self.kind]
        return {f"{self.name}_{part}": f(as_col(self.value)) for part, f in build.items()}

    def merged(self, inside: Column) -> Column:
        """The measure over the days where ``inside`` holds."""
        part = lambda p: F.when(inside, F.col(f"{self.name}_{p}"))
        if self.kind == "avg":
            return safe_div(F.sum(part("sum")), F.sum(part("n")))
        if self.kind == "count":
            return F.coalesce(F.sum(part("n")), F.lit(0))
        if self.kind == "distinct":
            return F.hll_sketch_estimate(F.hll_union_agg(part("sketch")))
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.kind](part(self.kind))


@dataclass(frozen=True)
class LastDays:
    """A result column: a measure over the last ``days`` days, as in :class:`~martwright.operators.temporal.Rolling`."""

    name: str
    measure: str
    days: int


def day_partials(df: DataFrame, keys: Sequence[str], ts: str, measures: Sequence[Measure]) -> DataFrame:
    """One row per (keys, day). Rows without a time belong to no day."""
    columns = {n: c for m in measures for n, c in m.partials().items()}
    rows = df.filter(F.col(ts).isNotNull()).groupBy(*keys, F.col(ts).cast("date").alias(DAY))
    return rows.agg(*(c.alias(n) for n, c in columns.items()))


def days_of(df: DataFrame, ts: str) -> list[dt.date]:
    """The different days of a table (of a late batch, say): no more than the calendar has."""
    rows = df.select(F.col(ts).cast("date").alias(DAY)).filter(f"{DAY} is not null").distinct().collect()
    return sorted(r[0] for r in rows)


class DayStore:
    """Partials of a fact, kept as a snapshot table with a part for each day."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], ts: str, measures: Sequence[Measure]):
        self.table, self.keys, self.ts = SnapshotTable(spark, root), list(keys), ts
        self.measures = {m.name: m for m in measures}

    def schema(self, facts: DataFrame) -> StructType:
        return day_partials(facts, self.keys, self.ts, list(self.measures.values())).schema

    def changed(self, facts: DataFrame, days: Iterable[dt.date]) -> DataFrame:
        """New partials of some days. Their bounds and the days themselves reach the scan of the facts."""
        days = sorted(set(days))
        at = F.col(self.ts)
        inside = (at >= F.lit(days[0])) & (at < F.lit(days[-1] + dt.timedelta(days=1))) & at.cast("date").isin(days)
        return day_partials(facts.filter(inside), self.keys, self.ts, list(self.measures.values()))

    def refresh(self, facts: DataFrame, days: Iterable[dt.date]) -> None:
        """Compute the given days anew from ``facts``, which has all rows of these days, and publish them at once.

        A day that has no rows any more loses its part. If the write fails, readers keep the days as they were.
        """
        days = sorted(set(days))
        if not days:
            return
        since, folder = max(self.table.versions(), default=0), self.table.new_folder()
        dealt = self.changed(facts, days).withColumn("part", F.col(DAY).cast("string"))
        dealt.write.partitionBy("part").parquet(f"{self.table.root}/{folder}")
        found = set(list_folder(self.table.spark, f"{self.table.root}/{folder}"))
        self.table.publish({str(d): f"{folder}/part={d}" if f"part={d}" in found else None for d in days}, since)

    def windows(self, schema: StructType, as_of: dt.date, wanted: Sequence[LastDays], extra_days: int = 1) -> DataFrame:
        """All measures per key, from the stored days of the widest window alone; ``as_of`` itself is excluded.

        "Last N days" starts N + ``extra_days`` days before ``as_of``. Keys without a row in the widest window are absent.
        """
        reach = max(w.days for w in wanted) + extra_days
        days = [as_of - dt.timedelta(days=k) for k in range(reach, 0, -1)]
        rows = self.table.read(schema, [str(d) for d in days])
        since = lambda w: F.col(DAY) >= F.lit(as_of - dt.timedelta(days=w.days + extra_days))
        return rows.groupBy(*self.keys).agg(*(self.measures[w.measure].merged(since(w)).alias(w.name) for w in wanted))
