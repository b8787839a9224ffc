"""Row numbers and running totals over a sort that no single task sees as a whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

_INDEX = (1 << 33) - 1  # the bits of monotonically_increasing_id() below the partition's number


def numbered(df: DataFrame, order: Sequence[str], within: Sequence[str] = (), name: str = "row_number") -> DataFrame:
    """Add each row's number, from 1, among the rows with its ``within`` columns, sorted by ``order``.

    Same result as ``row_number`` over a window, but a group is spread over tasks: rows are dealt into ranges of (within,
    order) and sorted in each; counts per group and range, a table as small as the number of ranges, give every range its
    offset. The sorted rows are written once to the shared folder, as both steps must see the same ranges. ``order``
    should be unique in a group: equal rows share a range. NULLs come first, and are a group of their own.
    """
    groups = [f"_g{k}" for k in range(len(within))]
    keyed = df.withColumns(dict(zip(groups, map(F.col, within), strict=True)))
    ranged = keyed.repartitionByRange(*within, *order).sortWithinPartitions(*within, *order)
    place = F.monotonically_increasing_id()
    rows, _ = written(
        ranged.withColumns({"_range": F.shiftright(place, 33), "_at": place.bitwiseAND(F.lit(_INDEX))}), "numbered"
    )
    counts = rows.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *(F.col(g).alias(f"{g}_") for g in groups), F.col("_range").alias("_range_"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
    )
    same = reduce(lambda a, b: a & b, (F.col(g).eqNullSafe(F.col(f"{g}_")) for g in groups), F.col("_range") == F.col("_range_"))
    return rows.join(offsets, same).select(*df.columns, (F.col("_at") + F.col("_offset") + 1).alias(name))


def running_totals(df: DataFrame, keys: Sequence[str], ts: str, sums: Mapping[str, Column]) -> DataFrame:
    """(keys, ts, sums): the totals of each key over all rows up to and at each of its times.

    Rows of one key and time are added up first. Times are then dealt into ranges of (key, time); totals run within a range,
    and the totals of a key's earlier ranges are added, so a hot key is spread over tasks. The dealt rows are
    written once to the shared folder. Rows with a null key or time are left out, null values count as 0; sums should be of
    exact types.
    """
    names = list(sums)
    known = df.select(*keys, ts, *(F.coalesce(c, F.lit(0)).alias(n) for n, c in sums.items())).dropna(subset=[*keys, ts])
    instants = known.groupBy(*keys, ts).agg(*(F.sum(n).alias(n) for n in names))
    ranged = instants.repartitionByRange(*keys, ts)
    rows, _ = written(ranged.withColumn("_range", F.spark_partition_id()), "running")
    ranges = rows.groupBy(*keys, "_range").agg(*(F.sum(n).alias(n) for n in names))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(*keys, "_range", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in names))
    so_far = Window.partitionBy(*keys, "_range").orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.withColumns({n: F.sum(n).over(so_far) for n in names})
    return inside.join(offsets, [*keys, "_range"]).select(*keys, ts, *((F.col(n) + F.col(f"{n}_before")).alias(n) for n in names))
